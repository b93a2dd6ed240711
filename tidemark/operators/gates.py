"""Quality gates: each is one aggregate that gives (check, violations); enforce raises in the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tickers import BASKET
from tidemark.operators.events import OFFSETS

NEWS_COLUMNS = ["event_id", "title", "url", "source", "published_timestamp", "collected_timestamp", "content_length", "has_full_text", "content_hash", "merged_tickers", "published_date", "published_year_month", "data_quality_errors", "is_valid"]
MARKET_COLUMNS = ["event_id", "ticker", "session_date", "interval", "open", "high", "low", "close", "volume", "source", "daily_return", "data_quality_errors", "is_valid"]


def _long(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    one = df.agg(*[c.cast("long").alias(n) for n, c in checks.items()])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in checks]), F.array(*checks)))).toDF("check", "violations")


#: Types of columns that are no strings.
TYPES = {"is_valid": "boolean", "merged_tickers": "array<string>", "session_date": "date", "daily_return": "double"}


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns that it lacks, as nulls, so that the other checks can be made."""
    return df.select("*", *[F.lit(None).cast(TYPES.get(c, "string")).alias(c) for c in columns if c not in df.columns])


def _missing(df: DataFrame, columns: list[str]) -> Column:
    return F.lit(len(set(columns) - set(df.columns)))


def _short(least: int, count: Column | None = None) -> Column:
    return F.greatest(F.lit(0), F.lit(least) - (F.count("*") if count is None else count))


def gate_news(df: DataFrame, min_rows: int = 1, universe: list[str] | None = None, columns: list[str] = NEWS_COLUMNS) -> DataFrame:
    allowed = F.array(*[F.lit(t) for t in universe or BASKET])
    return _long(
        _complete(df, columns),
        {
            "missing_columns": _missing(df, columns), "too_few_rows": _short(min_rows),
            "duplicate_event_ids": F.count("*") - F.count_distinct(F.coalesce("event_id", F.lit(""))),
            "invalid_rows": F.count_if(~F.coalesce("is_valid", F.lit(False))), "blank_titles": F.count_if(F.trim(F.coalesce("title", F.lit(""))) == ""),
            "unknown_tickers": F.count_if(F.size(F.array_except("merged_tickers", allowed)) > 0),
        },
    )


def gate_market(df: DataFrame, min_rows: int = 1, min_tickers: int = 1, jump: float = 0.5, columns: list[str] = MARKET_COLUMNS) -> DataFrame:
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("ticker", "session_date", "interval", "source")])
    return _long(
        _complete(df, columns),
        {
            "missing_columns": _missing(df, columns), "too_few_rows": _short(min_rows), "too_few_tickers": _short(min_tickers, F.count_distinct("ticker")),
            "duplicate_keys": F.count("*") - F.count_distinct(key), "invalid_rows": F.count_if(~F.coalesce("is_valid", F.lit(False))),
            "weekend_rows": F.count_if(F.dayofweek("session_date").isin(1, 7)), "jumps": F.count_if(F.abs("daily_return") > jump),
        },
    )


def gate_gold(df: DataFrame, min_pairs: int = 1, offsets: tuple[int, ...] = OFFSETS) -> DataFrame:
    pair = F.count_distinct(F.struct("event_id", "ticker"))
    looks_ahead = (F.col("t0_date") < F.col("event_date")) | (F.col("after_close") & (F.col("t0_date") == F.col("event_date")))
    return _long(
        df,
        {
            "too_few_pairs": _short(min_pairs, pair), "duplicate_keys": F.count("*") - F.count_distinct(F.struct("event_id", "ticker", "relative_session")),
            "wrong_offsets": F.when(F.array_sort(F.collect_set("relative_session")) == F.array(*[F.lit(o) for o in sorted(offsets)]), 0).otherwise(1),
            "wrong_row_count": F.abs(F.count("*") - pair * len(offsets)), "look_ahead": F.count_if(looks_ahead),
            "close_without_data": F.count_if(~F.col("has_market_data") & F.col("close").isNotNull()),
        },
    )


def enforce(gate: DataFrame) -> None:
    """Raise with all broken checks; the gate has a handful of rows."""
    broken = [f"{r['check']}={r['violations']}" for r in gate.filter("violations > 0").orderBy("check").collect()]
    if broken:
        raise ValueError("FAILED " + ", ".join(broken))


TRAINING_COLUMNS = ["event_id", "ticker", "training_year", "mask_t1", "mask_t3", "mask_t5"]


def gate_partitions(df: DataFrame, n: int, columns: list[str] = TRAINING_COLUMNS) -> DataFrame:
    """Checks of a table dealt to n partitions: missing columns, rows that are lost or added, partitions more or less than n."""
    dealt = df.repartition(n).withColumn("partition_id", F.spark_partition_id()).groupBy("partition_id").agg(F.count("*").alias("n"))
    both = dealt.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dealt"), F.count("*").alias("used")).crossJoin(F.broadcast(df.agg(F.count("*").alias("rows"))))  # one row each
    checks = {"missing_columns": _missing(df, columns), "wrong_row_sum": F.abs(F.col("dealt") - F.col("rows")), "wrong_partitions": F.abs(F.col("used") - F.least(F.lit(n), F.col("rows")))}
    return both.select(F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in checks]), F.array(*[c.cast("long") for c in checks.values()])))).toDF("check", "violations")


def partition_profile(df: DataFrame, n: int, id_col: str, ticker_col: str, flags: dict[str, Column]) -> DataFrame:
    """Rows, distinct ids and tickers and flagged rows per partition after repartition(n)."""
    out = df.repartition(n).withColumn("partition_id", F.spark_partition_id())
    return out.groupBy("partition_id").agg(F.count("*").alias("n"), F.count_distinct(id_col).alias("ids"), F.count_distinct(ticker_col).alias("tickers"), *[F.count_if(c).alias(k) for k, c in flags.items()]).orderBy("partition_id")

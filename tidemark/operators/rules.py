"""What validated tables share: error codes by rules, and the choice of one row among versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def broken(rules: dict[str, Column]) -> Column:
    """Codes of the rules that a row breaks, in their order; rules: code and the condition of a fault. A null condition is none."""
    codes = F.transform(F.array(*[F.struct(fault.alias("fault"), F.lit(code).alias("code")) for code, fault in rules.items()]), lambda r: F.when(r["fault"], r["code"]))
    return F.array_compact(codes)


def checked(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with data_quality_errors and is_valid."""
    return df.withColumn("data_quality_errors", broken(rules)).withColumn("is_valid", F.size("data_quality_errors") == 0)


def chosen(df: DataFrame, keys: list[str], order: list[Column], tie: list[str] | None = None) -> DataFrame:
    """The first row of each key; of rows that the order leaves equal the first by tie columns, else by a hash of the content.

    The hash is computed for rows that lead their key only.
    """
    versions = Window.partitionBy(*keys)
    leading = df.withColumn("_rank", F.rank().over(versions.orderBy(*order))).filter("_rank = 1")
    last = [F.col(c) for c in tie] if tie else [F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])]
    return leading.withColumn("_rank", F.row_number().over(versions.orderBy(*last))).filter("_rank = 1").drop("_rank")

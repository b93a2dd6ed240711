"""State of the collectors as tables: upserts, attempts, ledgers, routing. Each is a pure function of old state and new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rules import chosen

MIN_CHARS, MAX_ATTEMPTS = 200, 5


def upserted(news: DataFrame, order: tuple[str, ...] = ("observed_at",), arrays: tuple[str, ...] = ("tickers", "rulebased_tickers", "ner_tickers"), plain: str = "rulebased") -> DataFrame:
    """One row per identity (URL, else text hash): the first row's fields, each ticker array merged over all rows in the order in
    which tickers first occur, and the strategy of the last row that has another one than plain, else the first row's.

    A ticker is kept with its first place only, so an identity of very many rows takes as much room as its different tickers.
    """
    key = F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.sha2(F.concat_ws("|", "title", F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("summary"))), 256))
    arrays = tuple(c for c in arrays if c in news.columns)
    rest = [c for c in news.columns if c not in (*arrays, "strategy")]
    at = F.struct(*order, F.xxhash64(*[F.col(f"`{c}`") for c in rest]).alias("_hash"))
    rows = news.withColumns({"identity": key, "_at": at})
    richer = F.when(F.col("strategy") != plain, F.col("_at"))
    out = rows.groupBy("identity").agg(F.min_by(F.struct(*rest), "_at").alias("f"), F.coalesce(F.max_by("strategy", richer), F.min_by("strategy", "_at")).alias("strategy"), F.count("*").alias("versions"))
    placed = lambda kind: F.transform(F.coalesce(F.col(kind), F.array().cast("array<string>")), lambda t, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), t.alias("t")))
    places = F.flatten(F.array(*[placed(c) for c in arrays]))
    each = rows.select("identity", "_at", F.explode(places).alias("p")).groupBy("identity", "p.kind", "p.t").agg(F.min(F.struct("_at", "p.i")).alias("first"))
    lists = each.groupBy("identity").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.struct("first", "t")))), lambda x: x["t"]).alias(c) for c in arrays])
    empty = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in arrays}
    return out.join(lists, "identity", "left").withColumns(empty).select("identity", "f.*", *arrays, "strategy", "versions")


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace by key: rows of new win; of several new rows the last by arrival column `arrival` if there is one."""
    if "arrival" in new.columns:
        new = new.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in new.columns if c not in keys]), "arrival").alias("r")).select(*keys, "r.*")
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def inserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Insert or ignore: old rows, and new keys once each."""
    return old.select(key).unionByName(unseen(new.select(key).distinct(), [old], key))


def unseen(items: DataFrame, states: list[DataFrame], key: str) -> DataFrame:
    """Items whose key is in none of the state tables."""
    for s in states:
        items = items.join(s.select(key), key, "left_anti")
    return items


def attempts(log: DataFrame, key: str = "id") -> DataFrame:
    """Attempts per key from a log of key, at, status, error: a rate limit and a missing address use none up; the last status and
    error stay."""
    counted = F.count_if(~F.col("status").isin("rate_limited", "skipped"))
    return log.groupBy(key).agg(counted.alias("attempts"), F.max_by("status", "at").alias("status"), F.substring(F.max_by("error", "at"), 1, 500).alias("last_error"))


def retryable(state: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    return state.filter(F.col("attempts") < limit)


def crawl_status(code: Column, chars: Column, url: Column | None = None) -> Column:
    """Outcome of a fetch: without an address it is skipped for good; 429 is a rate limit; other errors and short texts fail and may be tried again."""
    fetched = F.when(code == 429, "rate_limited").when(code.between(200, 299) & (F.coalesce(chars, F.lit(0)) >= MIN_CHARS), "success").otherwise("failed")
    return fetched if url is None else F.when(F.coalesce(F.trim(url), F.lit("")) == "", "skipped").otherwise(fetched)


def crawl_candidates(news: DataFrame, state: DataFrame, limit: int, key: str = "id", max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Items to fetch, by their key: tickers, short or no content, not done or skipped, attempts left."""
    out = news.join(state.select(key, "attempts", "status"), key, "left")
    short = F.length(F.coalesce("content", F.lit(""))) < MIN_CHARS
    over = F.coalesce(F.col("status").isin("success", "skipped"), F.lit(False))
    return out.filter((F.size("tickers") > 0) & short & ~over & (F.coalesce("attempts", F.lit(0)) < max_attempts)).orderBy(key).limit(limit)


def routed(items: DataFrame, limit: int, key: str = "id", max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """route (ready, rejected, deferred, failed) of each item of a run.

    Without a ticker in its metadata an item is rejected; with no attempts left it is deferred; of the others the first limit (0:
    all) by time get their fetch, the rest is deferred. A fetch without an address or with a short text failed. A text that came
    back is looked into again: without a ticker there the item is rejected after all. items: tickers, content, observed_at and, if
    they are known, url, attempts and text_tickers (of the fetched text). The turn is counted over keys alone.
    """
    has = lambda c, otherwise: F.col(c) if c in items.columns else F.lit(otherwise)
    open_ = (F.size("tickers") > 0) & (F.coalesce(has("attempts", 0), F.lit(0)) < max_attempts)
    turn = items.filter(open_).orderBy("observed_at", key)
    todo = (turn.limit(limit) if limit else turn).select(key, F.lit(True).alias("fetched"))
    text = F.length(F.trim(F.coalesce("content", F.lit("")))) >= MIN_CHARS
    address = F.coalesce(F.trim(has("url", "x")), F.lit("")) != ""
    again = F.size(F.coalesce(F.col("text_tickers"), F.array().cast("array<string>"))) > 0 if "text_tickers" in items.columns else F.lit(True)
    status = F.when(F.size("tickers") == 0, "rejected").when(F.col("fetched").isNull(), "deferred").when(~(text & address), "failed").when(again, "ready").otherwise("rejected")
    return items.join(todo, key, "left").withColumn("route", status).drop("fetched")


def month_windows(start: Column, end: Column) -> Column:
    """Half-open windows of calendar months, clipped at both ends."""
    first = F.sequence(F.trunc(start, "MM"), F.date_sub(end, 1), F.expr("interval 1 month"))
    return F.transform(first, lambda m: F.struct(F.greatest(m, start).alias("from"), F.least(F.add_months(m, 1), end).alias("until")))


def pending_jobs(tickers: DataFrame, start: str, end: str, ledger: DataFrame, retry_failed: bool = False, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Ticker and month jobs that the ledger (ticker, from, status) has not done; failed ones count as done unless retried.

    The first offset jobs of all, in the order of tickers (their turn if there is such a column) and months, are passed over
    before the ledger is looked at; limit counts what is left.
    """
    turn = ["turn"] if "turn" in tickers.columns else []
    jobs = tickers.select(*turn, "ticker", F.explode(month_windows(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("w")).select(*turn, "ticker", "w.*")
    if offset:
        jobs = jobs.orderBy(*turn, "ticker", "from").offset(offset)
    done = ledger.filter(F.col("status").isin(["success"] if retry_failed else ["success", "failed"]))
    jobs = jobs.join(done.select("ticker", "from"), ["ticker", "from"], "left_anti")
    return (jobs if limit is None else jobs.orderBy(*turn, "ticker", "from").limit(limit)).select("ticker", "from", "until")


def annotation_set(news: DataFrame, limit: int | None = None) -> DataFrame:
    """First row of each identity (content hash, else URL, else text hash) by time and id, with a short id; limit: of the earliest
    so many rows with a title only."""
    if limit is not None:
        news = news.filter(F.trim("title") != "").orderBy("published", "id").limit(limit)
    identity = F.coalesce(F.nullif(F.col("content_hash"), F.lit("")), F.nullif(F.col("url"), F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256))
    return chosen(news.withColumn("identity", identity), ["identity"], [F.asc("published"), F.asc("id")]).withColumn("annotation_id", F.substring(F.sha1("identity"), 1, 16))

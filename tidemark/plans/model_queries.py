"""Registered queries over targets, indicators, history and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators import metrics as mt
from tidemark.operators import targets as tg
from tidemark.plans.fixtures import BARS_EV, BARS_LI, NEWS_EV, bars_ev, bars_li, news_ev, returns, returns_sql, sql, table
from tidemark.sources import lake

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
W = "WINDOW w AS (PARTITION BY ticker ORDER BY session_date)"


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


FLAGGED = "fl AS (SELECT *, row_number() OVER w AS ix, coalesce(abs(daily_return) > 0.1, false) AS jump, sum(CASE WHEN abs(daily_return) > 0.1 THEN 1 ELSE 0 END) OVER w AS jumps FROM bars_ev_r WINDOW w AS (PARTITION BY ticker ORDER BY session_date))"
TARGETS = """base AS (SELECT *, published_precision = 'timestamp' AS exact FROM news_ev), kn AS (SELECT b.event_id, b.ticker, f.ix AS known_ix FROM (SELECT *, event_date - CASE WHEN exact AND after_close THEN 0 ELSE 1 END AS eff FROM base) b ASOF JOIN fl f ON b.ticker = f.ticker AND b.eff >= f.session_date),
nx AS (SELECT b.event_id, b.ticker, f.ix AS next_ix FROM base b ASOF JOIN fl f ON b.ticker = f.ticker AND b.event_date < f.session_date),
tr AS (SELECT b.event_id, b.ticker, b.event_date, h.horizon, h.threshold, k.known_ix, CASE WHEN h.ahead IS NULL THEN CASE WHEN b.exact AND NOT b.after_close THEN o.ix END ELSE n.next_ix + h.ahead END AS target_ix
  FROM base b CROSS JOIN (VALUES ('t0', NULL, 0.010), ('t1', 0, 0.010), ('t3', 2, 0.015), ('t5', 4, 0.020)) h(horizon, ahead, threshold) LEFT JOIN kn k ON k.event_id = b.event_id AND k.ticker = b.ticker LEFT JOIN nx n ON n.event_id = b.event_id AND n.ticker = b.ticker LEFT JOIN fl o ON o.ticker = b.ticker AND o.session_date = b.event_date),
tl AS (SELECT tr.*, coalesce(a.close IS NOT NULL AND t.close IS NOT NULL AND NOT a.jump AND t.jumps = a.jumps, false) AS mask, t.close / nullif(a.close, 0) - 1 AS r FROM tr LEFT JOIN fl a ON a.ticker = tr.ticker AND a.ix = tr.known_ix LEFT JOIN fl t ON t.ticker = tr.ticker AND t.ix = tr.target_ix),
lab AS (SELECT event_id, ticker, event_date, horizon, mask, CASE WHEN mask THEN r END AS r, CASE WHEN NOT mask THEN -100 WHEN r <= -threshold THEN 0 WHEN r >= threshold THEN 2 ELSE 1 END AS label FROM tl)"""
TARGET_PARTS = [BARS_EV, returns_sql("bars_ev"), NEWS_EV, FLAGGED, TARGETS]


def long_targets(spark, sf_dir):
    return tg.targets_long(news_ev(spark, sf_dir), returns(bars_ev(spark, sf_dir)))


PART = "CASE WHEN event_date <= DATE '2024-01-10' THEN 'train' WHEN event_date <= DATE '2024-01-20' THEN 'validation' ELSE 'test' END"


@query(sql(*TARGET_PARTS, f"SELECT horizon, {PART} AS split, count(*) AS n, round(avg(r), 6) AS mean_return FROM (SELECT l.*, n.event_date FROM lab l JOIN news_ev n USING (event_id, ticker)) WHERE mask AND r IS NOT NULL AND r <> 0 GROUP BY ALL"))
def eligible_targets(spark, sf_dir):
    """Rows that enter the measures of each split: not masked, with a return other than 0."""
    rows = long_targets(spark, sf_dir).withColumn("split", tg.temporal_split(F.col("event_date"), "2024-01-10", "2024-01-20"))
    own = F.col("split")
    entering = [tg.eligible(own, s, F.col("mask"), F.col("stock_return")) for s in ("train", "validation", "test")]
    return rows.filter(entering[0] | entering[1] | entering[2]).groupBy("horizon", "split").agg(F.count("*").alias("n"), F.round(F.avg("stock_return"), 6).alias("mean_return"))


@query(sql(*TARGET_PARTS, "SELECT event_id, ticker, horizon, round(r, 6) AS stock_return, label, mask FROM lab"))
def training_targets(spark, sf_dir):
    return long_targets(spark, sf_dir).select("event_id", "ticker", "horizon", F.round("stock_return", 6).alias("stock_return"), "label", "mask")


@query(sql(*TARGET_PARTS, "SELECT event_id, ticker, " + ", ".join(f"max(CASE WHEN horizon = '{h}' THEN label END) AS label_{h}, round(max(CASE WHEN horizon = '{h}' THEN r END), 6) AS stock_return_{h}" for h in ("t0", "t1", "t3", "t5")) + " FROM lab GROUP BY event_id, ticker"))
def training_targets_wide(spark, sf_dir):
    wide = tg.targets_wide(long_targets(spark, sf_dir))
    return wide.select("event_id", "ticker", *[c for h in tg.HORIZONS for c in (F.col(f"label_{h}"), F.round(f"stock_return_{h}", 6).alias(f"stock_return_{h}"))])


@query(sql(*TARGET_PARTS, "SELECT horizon, count(*) FILTER (mask AND r > 0) AS up, count(*) FILTER (mask AND r < 0) AS down, count(*) FILTER (NOT (mask AND r <> 0) OR r IS NULL) AS left_out FROM lab GROUP BY horizon"))
def binary_labels(spark, sf_dir):
    d = long_targets(spark, sf_dir).withColumn("d", tg.direction(F.col("stock_return"), F.col("mask")))
    return d.groupBy("horizon").agg(F.count_if(F.col("d") == 1).alias("up"), F.count_if(F.col("d") == 0).alias("down"), F.count_if(F.col("d").isNull()).alias("left_out"))


@query(sql(*TARGET_PARTS, "c AS (SELECT label, count(*) AS n FROM lab WHERE horizon = 't1' AND mask GROUP BY label)", "SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c"))
def class_weights(spark, sf_dir):
    return tg.class_weights(long_targets(spark, sf_dir).filter("horizon = 't1' and mask"), "label").withColumn("weight", F.round("weight", 6))


SPLIT = "CASE WHEN o_orderdate <= TIMESTAMP '1999-12-31' THEN 'train' WHEN o_orderdate <= TIMESTAMP '2000-12-31' THEN 'validation' ELSE 'test' END"


def split_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("split", tg.temporal_split(F.to_date("o_orderdate"), "1999-12-31", "2000-12-31"))


@query(f"SELECT {SPLIT} AS split, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY split")
def temporal_split(spark, sf_dir):
    return split_orders(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"))


@query("SELECT fold, part, count(*) AS n FROM (SELECT f.fold, CASE WHEN CAST(o_orderdate AS DATE) <= f.cut - 30 THEN 'train' WHEN CAST(o_orderdate AS DATE) > f.cut AND CAST(o_orderdate AS DATE) <= f.e THEN 'test' END AS part FROM orders, (VALUES (0, DATE '1997-12-31', DATE '1998-12-31'), (1, DATE '1998-12-31', DATE '1999-12-31')) f(fold, cut, e)) WHERE part IS NOT NULL GROUP BY ALL")
def walk_forward_folds(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return tg.walk_forward(o, "d", ["1997-12-31", "1998-12-31", "1999-12-31"], 30).groupBy("fold", "part").agg(F.count("*").alias("n"))


@query(f"SELECT key, count(*) FILTER (s > 1) AS shared_values, CAST(sum(CASE WHEN s > 1 THEN n ELSE 0 END) AS BIGINT) AS shared_rows FROM (SELECT key, value, count(DISTINCT split) AS s, count(*) AS n FROM (SELECT {SPLIT} AS split, unnest(['o_orderkey', 'o_custkey']) AS key, unnest([o_orderkey, o_custkey]) AS value FROM orders) GROUP BY key, value) GROUP BY key")
def leakage_audit(spark, sf_dir):
    return tg.leaks(split_orders(spark, sf_dir), "split", ["o_orderkey", "o_custkey"])


@query(f"SELECT split, count(*) AS n FROM (SELECT *, min(r) OVER (PARTITION BY o_custkey) AS f FROM (SELECT o_custkey, {SPLIT} AS split, CASE {SPLIT} WHEN 'train' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END AS r FROM orders)) WHERE r = f GROUP BY split")
def group_aware_split(spark, sf_dir):
    return tg.grouped_split(split_orders(spark, sf_dir), "split", "o_custkey").groupBy("split").agg(F.count("*").alias("n"))


VECTORS = "v AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS ticker, CAST(vec_id AS INTEGER) AS day, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"
HIST = "h AS (SELECT n.ticker, n.id, n.day, p.id AS past_id, p.day AS past_day, list_cosine_similarity(n.vector, p.vector) AS similarity FROM v n JOIN v p ON n.ticker = p.ticker AND p.day < n.day AND p.day >= n.day - 14), hk AS (SELECT *, row_number() OVER (PARTITION BY id, ticker ORDER BY similarity DESC, past_id) AS rank FROM h WHERE similarity BETWEEN 0.0 AND 0.85 QUALIFY row_number() OVER (PARTITION BY id, ticker ORDER BY similarity DESC, past_id) <= 5)"


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("ticker"), F.col("vec_id").cast("int").alias("day"), F.col("embedding").alias("vector"))


@query(sql(VECTORS, HIST, "SELECT id, past_id, CAST(rank AS INTEGER) AS rank, round(similarity, 6) AS similarity FROM hk"))
def history_topk(spark, sf_dir):
    return tg.history(vectors(spark, sf_dir), low=0.0).select("id", "past_id", "rank", F.round("similarity", 6).alias("similarity"))


@query(sql(VECTORS, HIST, "SELECT v.id, CAST(count(hk.id) AS BIGINT) AS history_count, CAST(count(hk.id) > 0 AS INTEGER) AS history_available, min(hk.day - hk.past_day) AS days_since_last_history, round(avg(similarity), 6) AS mean_similarity, round(max(similarity), 6) AS max_similarity FROM v LEFT JOIN hk ON hk.id = v.id GROUP BY v.id"))
def history_features(spark, sf_dir):
    out = tg.history_features(vectors(spark, sf_dir), low=0.0)
    return out.select("id", "history_count", "history_available", "days_since_last_history", F.round("history_mean_similarity", 6).alias("mean_similarity"), F.round("history_max_similarity", 6).alias("max_similarity"))


@query(sql(VECTORS, HIST, "SELECT count(*) AS pairs, count(*) FILTER (similarity BETWEEN 0.0 AND 0.85) AS in_range FROM h"))
def history_pairs(spark, sf_dir):
    """Pairs within 14 days, and those in range, none of which the pivots may lose."""
    return tg.history_pairs(vectors(spark, sf_dir), low=0.0).select("pairs", "in_range")


@query()
def history_pooled(spark, sf_dir):
    return tg.history_pooled(vectors(spark, sf_dir), low=0.0)


def roll(f, c, n, skip=0):
    frame = f"(PARTITION BY ticker ORDER BY session_date ROWS BETWEEN {n - 1 + skip} PRECEDING AND {skip} PRECEDING)" if skip else f"(PARTITION BY ticker ORDER BY session_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) OVER {frame} = {n} THEN {f}({c}) OVER {frame} END"


def lg(c, n=1):
    return f"nullif(lag({c}, {n}) OVER w, 0)"


#: Bars of which every other ticker has a second source on some days, and sessions in the order of dates and sources.
BARS_BOTH = """bars_li AS (SELECT *, 'a' AS source FROM one_li UNION ALL SELECT ticker, session_date, open, high + 1, low, close + 1, volume + 1, 'b' FROM one_li WHERE CAST(ticker AS BIGINT) % 2 = 0 AND day(session_date) % 3 > 0)"""


def bars_both(spark, sf_dir):
    """Each bar, and the other source's beside it: bars are made once."""
    own = [F.struct(F.lit(n).alias("source"), *[(F.col(c) + more).alias(c) for c in ("high", "close", "volume")]) for n, more in (("a", 0), ("b", 1))]
    two = (F.col("ticker").cast("long") % 2 == 0) & (F.dayofmonth("session_date") % 3 > 0)
    bars = bars_li(spark, sf_dir).withColumn("bar", F.explode(F.when(two, F.array(*own)).otherwise(F.array(own[0]))))
    return bars.select("ticker", "session_date", "open", "bar.high", "low", "bar.close", "bar.volume", "bar.source")


def both_sql(*parts: str) -> str:
    return sql(BARS_LI.replace("bars_li AS", "one_li AS"), BARS_BOTH, *parts).replace("PARTITION BY ticker ORDER BY session_date", "PARTITION BY ticker ORDER BY session_date, source")


def group(name, make, source, columns: dict[str, str]):
    """An indicator group over bars of two sources: its columns as SQL over `bars_li` (or the given FROM clause)."""
    body = ", ".join(f"round({e}, 6) AS {c}" for c, e in columns.items())

    def run(spark, sf_dir):
        return make(spark, sf_dir).select("ticker", "session_date", "source", *[F.round(c, 6).alias(c) for c in columns])

    run.__name__ = name
    query(both_sql(returns_sql("bars_li"), f"SELECT ticker, session_date, source, {body} FROM {source} {W}"))(run)


def li(f):
    return lambda spark, sf_dir: f(bars_both(spark, sf_dir))


group("indicators_returns", li(ind.returns), "bars_li", {
    "price_change": "close - lag(close) OVER w", "log_return_1d": f"ln(close / {lg('close')})", "overnight_return": f"open / {lg('close')} - 1", "intraday_return": "close / nullif(open, 0) - 1",
    "high_low_range": f"(high - low) / {lg('close')}", "gap_pct": f"(open - lag(close) OVER w) / {lg('close')}", "close_position": "(close - low) / nullif(high - low, 0)", **{f"return_{n}d": f"close / {lg('close', n)} - 1" for n in (1, 2, 3, 5, 10, 20, 60)}})
group("indicators_trend", li(ind.trend), "bars_li", {
    **{f"sma_{n}": roll("avg", "close", n) for n in (5, 10, 20, 50, 100, 200)}, **{f"price_to_sma_{n}": f"close / ({roll('avg', 'close', n)}) - 1" for n in (5, 20, 50)}, "sma_5_to_20": f"({roll('avg', 'close', 5)}) / ({roll('avg', 'close', 20)}) - 1"})
group("indicators_volatility", li(ind.volatility), "(SELECT *, CASE WHEN previous_close IS NULL THEN high - low ELSE greatest(high - low, abs(high - previous_close), abs(low - previous_close)) END AS tr FROM bars_li_r)", {
    **{f"volatility_{n}d": roll("stddev_samp", "daily_return", n) for n in (5, 10, 20, 60)}, "volatility_ratio_5_20": f"({roll('stddev_samp', 'daily_return', 5)}) / nullif({roll('stddev_samp', 'daily_return', 20)}, 0)", "atr_14": roll("avg", "tr", 14), "atr_14_pct": f"({roll('avg', 'tr', 14)}) / nullif(close, 0)"})
G, LO, MD, SD = (f"({roll(f, c, n)})" for f, c, n in (("avg", "g", 14), ("avg", "l", 14), ("avg", "close", 20), ("stddev_samp", "close", 20)))
RSI = f"(100 - 100 * {LO} / nullif({G} + {LO}, 0))"
group("indicators_oscillators", li(ind.oscillators), "(SELECT *, CASE WHEN previous_close IS NOT NULL THEN greatest(close - previous_close, 0) END AS g, CASE WHEN previous_close IS NOT NULL THEN greatest(previous_close - close, 0) END AS l FROM bars_li_r)", {
    "rsi_14": RSI, "rsi_overbought": f"CAST(coalesce({RSI} > 70, false) AS INTEGER)", "rsi_oversold": f"CAST(coalesce({RSI} < 30, false) AS INTEGER)", "bollinger_width": f"4 * {SD} / nullif({MD}, 0)", "bollinger_position": f"(close - {MD} + 2 * {SD}) / nullif(4 * {SD}, 0)"})
group("indicators_volume", li(ind.volume), "(SELECT *, close * volume AS tv FROM bars_li_r)", {
    "amihud_illiquidity": "abs(daily_return) / nullif(tv, 0)", "volume_change_1d": f"volume / {lg('volume')} - 1", "volume_ma_5": roll("avg", "volume", 5), "volume_ratio_5": f"volume / nullif({roll('avg', 'volume', 5)}, 0)", "volume_ratio_20": f"volume / nullif({roll('avg', 'volume', 20)}, 0)",
    "volume_zscore_20": f"(volume - ({roll('avg', 'volume', 20)})) / nullif({roll('stddev_samp', 'volume', 20)}, 0)", "trading_value": "tv", "trading_value_ratio_20": f"tv / nullif({roll('avg', 'tv', 20)}, 0)"})
group("indicators_candles", li(ind.candles), "bars_li", {
    "body_size_pct": "abs(close - open) / nullif(open, 0)", "upper_shadow_pct": "(high - greatest(open, close)) / nullif(open, 0)", "lower_shadow_pct": "(least(open, close) - low) / nullif(open, 0)", "body_to_range": "abs(close - open) / nullif(high - low, 0)",
    "is_bullish": "CAST(close > open AS INTEGER)", "is_bearish": "CAST(close < open AS INTEGER)", "is_doji": "CAST(coalesce(abs(close - open) / nullif(high - low, 0) < 0.1, false) AS INTEGER)"})
group("indicators_extremes", li(ind.extremes), "bars_li", {
    **{f"distance_to_high_{n}d": f"close / nullif({roll('max', 'high', n)}, 0) - 1" for n in (5, 20, 60, 252)}, **{f"distance_to_low_{n}d": f"close / nullif({roll('min', 'low', n)}, 0) - 1" for n in (5, 20, 60, 252)}, "drawdown_60d": f"close / nullif({roll('max', 'close', 60)}, 0) - 1"})
group("indicators_obv", li(ind.on_balance), "(SELECT *, sum(coalesce(sign(close - previous_close), 0) * volume) OVER (PARTITION BY ticker ORDER BY session_date) AS obv FROM bars_li_r)", {
    "obv": "obv", "obv_change_5d": "obv - lag(obv, 5) OVER w", "obv_slope_20d": "(obv - lag(obv, 20) OVER w) / 20"})
group("indicators_calendar", li(ind.calendar), "bars_li", {
    "day_of_week": "isodow(session_date) - 1", "month": "month(session_date)", "quarter": "quarter(session_date)", "is_monday": "CAST(isodow(session_date) = 1 AS INTEGER)", "is_friday": "CAST(isodow(session_date) = 5 AS INTEGER)",
    "is_month_start": "CAST(day(session_date) = 1 AS INTEGER)", "is_month_end": "CAST(session_date = last_day(session_date) AS INTEGER)"})
group("indicators_forward", li(ind.forward), "bars_li", {
    **{f"forward_return_{n}d": f"lead(close, {n}) OVER w / nullif(close, 0) - 1" for n in (1, 3, 5)}, **{f"direction_t_plus_{n}": f"CAST(sign(lead(close, {n}) OVER w / nullif(close, 0) - 1) AS INTEGER)" for n in (1, 3, 5)}})
group("market_features", li(ind.model_features), "bars_li_r", {
    "market_return_1d": "daily_return", "market_intraday_range": "(high - low) / nullif(open, 0)", "market_open_gap": f"open / {lg('close')} - 1", "market_log1p_volume": "ln(1 + volume)", "market_volume_ratio_20": f"volume / nullif({roll('avg', 'volume', 20, 1)}, 0)",
    "market_momentum_5": f"close / {lg('close', 5)} - 1", "market_momentum_20": f"close / {lg('close', 20)} - 1", "market_volatility_20": roll("stddev_samp", "daily_return", 20, 1)})


AHEAD5 = "(PARTITION BY ticker ORDER BY session_date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"
group("indicators_spikes", li(ind.spikes), "bars_li_r", {
    "volume_spike_t_plus_1": f"CAST(lead(volume) OVER w >= 2 * ({roll('avg', 'volume', 20)}) AS INTEGER)",
    "volatility_spike_t_plus_5": f"CAST(CASE WHEN count(daily_return) OVER {AHEAD5} = 5 THEN stddev_samp(daily_return) OVER {AHEAD5} END >= 2 * ({roll('stddev_samp', 'daily_return', 20)}) AS INTEGER)"})


def with_actions(bars):
    day = F.dayofmonth("session_date")
    return bars.withColumns({"dividends": F.when(day == 7, F.col("open") / 100).when(day != 8, 0.0), "stock_splits": F.when(day == 20, 2.0).otherwise(0.0)})


group("indicators_corporate", li(lambda bars: ind.corporate_actions(with_actions(bars))), "(SELECT *, CASE WHEN day(session_date) = 7 THEN open / 100 WHEN day(session_date) <> 8 THEN 0.0::DOUBLE END AS d, CASE WHEN day(session_date) = 20 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS s FROM bars_li)", {
    "has_dividend": "CAST(coalesce(d, 0) > 0 AS INTEGER)", "dividend_amount": "d", "dividend_yield_proxy": f"d / {lg('close')}", "has_stock_split": "CAST(s > 0 AS INTEGER)", "stock_split_ratio": "s"})


def market_average(bars):
    return bars.groupBy("session_date").agg(F.avg("close").alias("market_close"))


group("indicators_forward_excess", lambda spark, sf_dir: ind.forward(bars_both(spark, sf_dir), market_average(bars_both(spark, sf_dir))),
  "(SELECT b.*, f1, f3, f5 FROM bars_li b LEFT JOIN (SELECT session_date, " + ", ".join(f"lead(mc, {n}) OVER (ORDER BY session_date) / nullif(mc, 0) - 1 AS f{n}" for n in (1, 3, 5)) + " FROM (SELECT session_date, avg(close) AS mc FROM bars_li GROUP BY session_date)) USING (session_date))", {
    f"forward_excess_return_{n}d": f"lead(close, {n}) OVER w / nullif(close, 0) - 1 - f{n}" for n in (1, 3, 5)})


FR = "(PARTITION BY ticker ORDER BY session_date ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
PAIR = "CASE WHEN daily_return IS NOT NULL AND m1 IS NOT NULL THEN {c} END"


def over(n, expr):
    f = FR.format(k=n - 1)
    return f"CASE WHEN count({PAIR.format(c='1')}) OVER {f} = {n} THEN {expr.format(f=f, r=PAIR.format(c='daily_return'), m=PAIR.format(c='m1'))} END"


group("indicators_benchmark", lambda spark, sf_dir: ind.against_market(bars_both(spark, sf_dir), market_average(bars_both(spark, sf_dir))),
  "(SELECT r.*, m1, m5 FROM bars_li_r r LEFT JOIN (SELECT session_date, mc / nullif(lag(mc) OVER (ORDER BY session_date), 0) - 1 AS m1, mc / nullif(lag(mc, 5) OVER (ORDER BY session_date), 0) - 1 AS m5 FROM (SELECT session_date, avg(close) AS mc FROM bars_li GROUP BY session_date)) USING (session_date))", {
    "market_return_1d": "m1", "market_return_5d": "m5", "excess_return_1d": "daily_return - m1", "excess_return_5d": f"close / {lg('close', 5)} - 1 - m5",
    **{f"rolling_beta_{n}d": over(n, "covar_samp({r}, {m}) OVER {f} / nullif(var_samp({m}) OVER {f}, 0)") for n in (20, 60)}, "correlation_with_market_20d": over(20, "corr({r}, {m}) OVER {f}"), "cumulative_abnormal_return": "sum(daily_return - m1) OVER w"})


@query(both_sql("nb AS (SELECT ticker, session_date, source, close, row_number() OVER (PARTITION BY ticker ORDER BY session_date) AS i FROM bars_li)",
  "rec AS (SELECT ticker, session_date, source, close, i, close AS f, close AS s, CAST(0 AS DOUBLE) AS g FROM nb WHERE i = 1 UNION ALL SELECT nb.ticker, nb.session_date, nb.source, nb.close, nb.i, nb.close * 2 / 13.0 + rec.f * 11 / 13.0, nb.close * 2 / 27.0 + rec.s * 25 / 27.0, ((nb.close * 2 / 13.0 + rec.f * 11 / 13.0) - (nb.close * 2 / 27.0 + rec.s * 25 / 27.0)) * 0.2 + rec.g * 0.8 FROM rec JOIN nb ON nb.ticker = rec.ticker AND nb.i = rec.i + 1)",
  "SELECT ticker, session_date, source, round(f - s, 4) AS macd, round(g, 4) AS macd_signal, round(f - s - g, 4) AS macd_histogram, round((f - s) / nullif(close, 0), 6) AS macd_pct FROM rec").replace('WITH one_li', 'WITH RECURSIVE one_li', 1))
def indicators_macd(spark, sf_dir):
    return ind.macd(bars_both(spark, sf_dir)).select("ticker", "session_date", "source", *[F.round(c, 4).alias(c) for c in ("macd", "macd_signal", "macd_histogram")], F.round("macd_pct", 6).alias("macd_pct"))


M = """m AS (SELECT count(*) AS n, count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS tn, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic = 0) AS fn FROM labels),
f AS (SELECT *, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(2.0 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0 FROM m)"""


@query(sql(M, "SELECT n, round((tp + tn) / n, 6) AS accuracy, round((f1 + f0) / 2, 6) AS macro_f1, round((f1 * (tp + fn) + f0 * (tn + fp)) / n, 6) AS weighted_f1, round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy, round(greatest(tp + fn, tn + fp) / n, 6) AS majority_accuracy FROM f"))
def classification_metrics(spark, sf_dir):
    out = mt.scores(table(spark, sf_dir, "labels"), "quality", "toxic")
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1", "balanced_accuracy", "majority_accuracy")])


@query("SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return mt.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


RANK = "s AS (SELECT CASE WHEN value > 55 THEN 1 ELSE 0 END AS y, round((user_id % 10) / 10.0, 1) AS s FROM events)"


@query(sql(RANK, "g AS (SELECT s, sum(y)::DOUBLE AS p, count(*)::DOUBLE AS n FROM s GROUP BY s)", "c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS seen, sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM g)",
  "SELECT round((SELECT avg((s - y) ** 2) FROM s), 6) AS brier, round(sum((n - p) * (tp - p / 2)) / max(pp * (nn - pp)), 6) AS roc_auc, round(sum(p / pp * tp / seen), 6) AS pr_auc FROM c"))
def ranking_metrics(spark, sf_dir):
    s = table(spark, sf_dir, "events").select((F.col("value") > 55).cast("int").alias("y"), F.round((F.col("user_id") % 10) / 10.0, 1).alias("s"))
    return mt.ranking_scores(s, "y", "s").select(*[F.round(c, 6).alias(c) for c in ("brier", "roc_auc", "pr_auc")])


@query("SELECT event_id, CASE WHEN value * 0.5 + user_id * -0.25 + 1 >= value * -0.5 + user_id * 0.25 THEN 0 ELSE 1 END AS prediction FROM events")
def linear_predictions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    x = F.array(F.col("value"), F.col("user_id").cast("double"))
    return e.select("event_id", mt.linear_prediction(x, [[0.5, -0.25], [-0.5, 0.25]], [1.0, 0.0]).alias("prediction"))


@query()
def permutation_importance(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1e5).alias("price"), (F.col("o_custkey") % 10).cast("double").alias("cust"), (F.col("o_totalprice") > 2e5).cast("int").alias("y"))
    predict = lambda c: mt.linear_prediction(F.array(c("price"), c("cust")), [[-1.0, 0.0], [1.0, 0.01]], [2.0, -2.0])
    return mt.permutation_importance(o, {"price": ["price"], "customer": ["cust"], "both": ["price", "cust"]}, predict, "y", repeats=5)


@query()
def baseline_model(spark, sf_dir):
    o = split_orders(spark, sf_dir).select("split", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice")).alias("price"), (F.col("o_custkey") % 10).cast("double").alias("cust"), (F.col("o_totalprice") > 2e5).cast("int").alias("y"))
    w = tg.class_weights(o.filter("split = 'train'"), "y").select("y", "weight")
    model = mt.baseline(o.filter("split = 'train'").join(F.broadcast(w), "y"), ["price", "cust"], "y", weight="weight")
    model = mt.saved(model, lake.scratch(spark, "model"))
    return model.transform(o.filter("split = 'test'")).groupBy("y", "prediction").agg(F.count("*").alias("n"))

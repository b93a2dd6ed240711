"""Technical indicators. Each group maps bars (ticker, session_date, open, high, low, close, volume) to columns by frames of
sessions; a frame that is not full gives null, as does a zero base. Bars of one ticker and date are in the order of their source,
where there is one, and each is a session."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_turn(f):
    """f over bars with the column _turn, which orders several bars of one date, and which goes again afterwards."""

    @functools.wraps(f)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        turn = F.col("source").cast("string") if "source" in df.columns else F.lit(None).cast("string")
        return f(df.withColumn("_turn", turn), *args, **options).drop("_turn")

    return run


def by_session():
    return Window.partitionBy("ticker").orderBy("session_date", "_turn")


def prices() -> list[Column]:
    return [F.col(c) for c in ("close", "open", "high", "low", "volume")]


def lag(c: Column, n: int = 1) -> Column:
    return F.lag(c, n).over(by_session())


def change(c: Column, n: int = 1) -> Column:
    return F.try_divide(c, lag(c, n)) - 1


def rolled(df: DataFrame, frames: dict[str, tuple[str, str, int, int]]) -> DataFrame:
    """df, as in_turn gives it, with columns of name: (avg, stddev, max or min, column, n, skip): over the last n sessions (before
    the last skip ones), null unless all n have a value.

    Frames are composed of frames of 1, 2, 4, ... sessions, each made of two of half its length, so a row costs a few lags and not
    its frame.
    """
    sums = {(kind, c): [c] for kind, c, _, _ in frames.values() if kind in ("avg", "max", "min")}
    merge = {"avg": lambda a, b: a + b, **{k: lambda a, b, f=f: F.when(a.isNotNull() & b.isNotNull(), f(a, b)) for k, f in (("max", F.greatest), ("min", F.least))}}
    longest = {key: max(n for kind, c, n, _ in frames.values() if (kind, c) == key) for key in sums}
    out, names = df, list(df.columns)
    for k in range(1, max(longest.values(), default=1).bit_length()):
        made = {}
        for (kind, c), levels in sums.items():
            if 1 << k <= longest[kind, c]:
                made[f"_{kind}_{c}_{k}"] = merge[kind](F.col(levels[-1]), lag(F.col(levels[-1]), 1 << k - 1))
                levels.append(f"_{kind}_{c}_{k}")
        out = out.withColumns(made)
    done = {}
    for name, (kind, c, n, skip) in frames.items():
        if kind == "stddev":
            continue
        top = n.bit_length() - 1
        parts = [(top, 0), (top, n - (1 << top))][: 1 + (n > 1 << top)] if kind != "avg" else pieces(n)
        whole = functools.reduce(merge[kind], [lag(F.col(sums[kind, c][k]), at + skip) if at + skip else F.col(sums[kind, c][k]) for k, at in parts])
        done[name] = whole / n if kind == "avg" else whole
    out = out.withColumns(done) if done else out
    for c in dict.fromkeys(c for kind, c, _, _ in frames.values() if kind == "stddev"):
        own = {name: (n, skip) for name, (kind, x, n, skip) in frames.items() if kind == "stddev" and x == c}
        out = moments(out, [c], [(c, c)], {n for n, _ in own.values()})
        shown = {name: F.sqrt(F.col(f"_c_{c}_{c}_{n}") / (n - 1)) for name, (n, _) in own.items()}
        out = out.withColumns(shown).withColumns({name: lag(F.col(name), skip) for name, (_, skip) in own.items() if skip})
        out = out.select(*[x for x in out.columns if not x.startswith(("_c_", "_mean_"))])
    return out.select(*names, *frames)


def pieces(n: int) -> list[tuple[int, int]]:
    """A frame of n sessions as frames of powers of two: (exponent, sessions back)."""
    out, at = [], 0
    for k in reversed(range(n.bit_length())):
        if n >> k & 1:
            out.append((k, at))
            at += 1 << k
    return out


def moments(df: DataFrame, columns: list[str], pairs: list[tuple[str, str]], lengths: set[int]) -> DataFrame:
    """df, as in_turn gives it, with _mean_column_n and _c_column_column_n (the sum of products of deviations from the means) over
    the last n sessions, null unless all n have all columns; composed like the frames of rolled."""
    known, names = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in columns], F.lit(False)), list(df.columns)
    mean, product = (lambda c, k: f"_mean_{c}_2^{k}"), (lambda c, d, k: f"_c_{c}_{d}_2^{k}")
    out = df.withColumns({**{mean(c, 0): F.when(~known, F.col(c).cast("double")) for c in columns}, **{product(c, d, 0): F.when(~known, F.lit(0.0)) for c, d in pairs}})
    for k in range(1, max(lengths).bit_length()):
        h = 1 << k - 1
        back = {f"{x}_back": lag(F.col(f"`{x}`"), h) for x in [*[mean(c, k - 1) for c in columns], *[product(c, d, k - 1) for c, d in pairs]]}
        col = lambda x: F.col(f"`{x}`")
        away = lambda c: col(mean(c, k - 1)) - col(mean(c, k - 1) + "_back")  # noqa: B023, E731
        made = {mean(c, k): col(mean(c, k - 1) + "_back") + away(c) / 2 for c in columns}
        made |= {product(c, d, k): col(product(c, d, k - 1)) + col(product(c, d, k - 1) + "_back") + away(c) * away(d) * (h / 2) for c, d in pairs}
        out = out.withColumns(back).withColumns(made).drop(*back)
    part = lambda x, at: f"{x}_at{at}"
    wanted = {(k, at) for n in lengths for k, at in pieces(n)}
    out = out.withColumns({part(x, at): lag(F.col(f"`{x}`"), at) if at else F.col(f"`{x}`") for k, at in wanted for x in [*[mean(c, k) for c in columns], *[product(c, d, k) for c, d in pairs]]})
    at_mean = lambda c, k, at: F.col(f"`{part(mean(c, k), at)}`")
    means, products = {}, {}
    for n in sorted(lengths):
        first, *others = pieces(n)
        for c in columns:
            means[f"_mean_{c}_{n}"] = sum(((at_mean(c, *p) - at_mean(c, *first)) * ((1 << p[0]) / n) for p in others), at_mean(c, *first))
        for c, d in pairs:
            apart = [(at_mean(c, *p) - F.col(f"_mean_{c}_{n}")) * (at_mean(d, *p) - F.col(f"_mean_{d}_{n}")) * float(1 << p[0]) for p in [first, *others]]
            products[f"_c_{c}_{d}_{n}"] = functools.reduce(lambda a, b: a + b, [F.col(f"`{part(product(c, d, k), at)}`") for k, at in [first, *others]] + apart)
    return out.withColumns(means).withColumns(products).select(*names, *means, *products)


@in_turn
def returns(df: DataFrame) -> DataFrame:
    C, O, H, L, _ = prices()
    prev = lag(C)
    return df.withColumns(
        {
            "price_change": C - prev, "log_return_1d": F.log(F.try_divide(C, prev)), "overnight_return": F.try_divide(O, prev) - 1,
            "intraday_return": F.try_divide(C, O) - 1, "high_low_range": F.try_divide(H - L, prev), "gap_pct": F.try_divide(O - prev, prev),
            "close_position": F.try_divide(C - L, H - L), **{f"return_{n}d": change(C, n) for n in (1, 2, 3, 5, 10, 20, 60)},
        }
    )


@in_turn
def trend(df: DataFrame) -> DataFrame:
    C, _, _, _, _ = prices()
    out = rolled(df, {f"sma_{n}": ("avg", "close", n, 0) for n in (5, 10, 20, 50, 100, 200)})
    ratio = lambda a, b: F.try_divide(a, b) - 1
    return out.withColumns({**{f"price_to_sma_{n}": ratio(C, F.col(f"sma_{n}")) for n in (5, 20, 50)}, "sma_5_to_20": ratio(F.col("sma_5"), F.col("sma_20"))})


#: Sessions, then blocks of them, that are composed in one step of an exponential average.
BLOCK = 4


def ema(df: DataFrame, value: str, span: int, out: str) -> DataFrame:
    """df, as in_turn gives it, with the exponential average of a column: the first value, then kept parts of the average and parts
    of the new value. A null value leaves the average as it is.

    The average is a sum of values weighted by powers of keep. Sums over the last BLOCK values are made of single ones, those over
    BLOCK ** 2 of these, and so on for as many values as can still be seen in a double (what lies before weighs less than
    2 ** -100). All steps are lags in one order, so rows are sorted once and a task holds no lists.
    """
    keep = 1 - 2 / (span + 1)
    if keep <= 0:
        return df.withColumn(out, F.last(value, ignorenulls=True).over(by_session()))
    seen, size = math.ceil(100 * math.log(2) / -math.log(keep)), 1
    first = F.count(value).over(by_session()) == 1
    rows = df.withColumn("_y", F.when(first, F.col(value)).otherwise(F.col(value) * (1 - keep)).cast("double"))
    while size < seen:
        back = [F.coalesce(F.expr(f"lag(_y, {j * size}) IGNORE NULLS").over(by_session()), F.lit(0.0)) * keep ** (j * size) for j in range(1, BLOCK)]
        rows = rows.withColumn("_y", functools.reduce(lambda a, b: a + b, back, F.col("_y")))
        size *= BLOCK
    return rows.withColumn(out, F.last("_y", ignorenulls=True).over(by_session())).drop("_y")


@in_turn
def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    out = ema(ema(df, "close", fast, "ema_fast"), "close", slow, "ema_slow")
    out = out.withColumn("macd", F.col("ema_fast") - F.col("ema_slow")).withColumn("_m", F.when(F.col("close").isNotNull(), F.col("macd")))
    out = ema(out, "_m", signal, "macd_signal").drop("_m")
    return out.withColumns({"macd_histogram": F.col("macd") - F.col("macd_signal"), "macd_pct": F.try_divide("macd", "close")})


@in_turn
def volatility(df: DataFrame) -> DataFrame:
    C, _, H, L, _ = prices()
    prev = lag(C)
    out = df.withColumns({"_r": change(C), "_tr": F.when(prev.isNull(), H - L).otherwise(F.greatest(H - L, F.abs(H - prev), F.abs(L - prev)))})
    out = rolled(out, {**{f"volatility_{n}d": ("stddev", "_r", n, 0) for n in (5, 10, 20, 60)}, "atr_14": ("avg", "_tr", 14, 0)})
    return out.withColumns({"volatility_ratio_5_20": F.try_divide("volatility_5d", "volatility_20d"), "atr_14_pct": F.try_divide(F.col("atr_14"), C)}).drop("_r", "_tr")


@in_turn
def oscillators(df: DataFrame) -> DataFrame:
    """RSI of plain rolling means, and Bollinger bands of two deviations."""
    C, _, _, _, _ = prices()
    delta = C - lag(C)
    out = df.withColumns({"_g": F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0))), "_l": F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))})
    out = rolled(out, {"_gain": ("avg", "_g", 14, 0), "_loss": ("avg", "_l", 14, 0), "_m": ("avg", "close", 20, 0), "_s": ("stddev", "close", 20, 0)})
    rsi = 100 - 100 * F.try_divide(F.col("_loss"), F.col("_gain") + F.col("_loss"))
    out = out.withColumn("rsi_14", rsi)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return out.withColumns(
        {
            "rsi_overbought": flag(F.col("rsi_14") > 70), "rsi_oversold": flag(F.col("rsi_14") < 30),
            "bollinger_width": F.try_divide(4 * F.col("_s"), F.col("_m")), "bollinger_position": F.try_divide(C - F.col("_m") + 2 * F.col("_s"), 4 * F.col("_s")),
        }
    ).drop("_g", "_l", "_gain", "_loss", "_m", "_s")


@in_turn
def volume(df: DataFrame) -> DataFrame:
    C, _, _, _, V = prices()
    out = df.withColumns({"volume_change_1d": change(V), "trading_value": C * V, "_r": change(C)})
    out = rolled(out, {"volume_ma_5": ("avg", "volume", 5, 0), "volume_ma_20": ("avg", "volume", 20, 0), "_sd": ("stddev", "volume", 20, 0), "_tv": ("avg", "trading_value", 20, 0)})
    return out.withColumns(
        {
            "volume_ratio_5": F.try_divide(V, F.col("volume_ma_5")), "volume_ratio_20": F.try_divide(V, F.col("volume_ma_20")),
            "volume_zscore_20": F.try_divide(V - F.col("volume_ma_20"), F.col("_sd")), "trading_value_ratio_20": F.try_divide(F.col("trading_value"), F.col("_tv")),
            "amihud_illiquidity": F.try_divide(F.abs("_r"), F.col("trading_value")),
        }
    ).drop("_sd", "_tv", "_r")


def candles(df: DataFrame) -> DataFrame:
    C, O, H, L, _ = prices()
    body = F.abs(C - O)
    part = F.try_divide(body, H - L)
    return df.withColumns(
        {
            "body_size_pct": F.try_divide(body, O), "upper_shadow_pct": F.try_divide(H - F.greatest(O, C), O), "lower_shadow_pct": F.try_divide(F.least(O, C) - L, O),
            "body_to_range": part, "is_bullish": (C > O).cast("int"), "is_bearish": (C < O).cast("int"), "is_doji": F.coalesce(part < 0.1, F.lit(False)).cast("int"),
        }
    )


@in_turn
def extremes(df: DataFrame) -> DataFrame:
    C, _, _, _, _ = prices()
    spans = (5, 20, 60, 252)
    out = rolled(df, {**{f"_high_{n}": ("max", "high", n, 0) for n in spans}, **{f"_low_{n}": ("min", "low", n, 0) for n in spans}, "_top": ("max", "close", 60, 0)})
    over = {f"distance_to_{side}_{n}d": F.try_divide(C, F.col(f"_{side}_{n}")) - 1 for n in spans for side in ("high", "low")}
    return out.withColumns(over | {"drawdown_60d": F.try_divide(C, F.col("_top")) - 1}).drop("_top", *[f"_{side}_{n}" for n in spans for side in ("high", "low")])


@in_turn
def on_balance(df: DataFrame) -> DataFrame:
    C, _, _, _, V = prices()
    out = df.withColumn("_d", F.coalesce(F.signum(C - lag(C)), F.lit(0.0)) * V)
    out = out.withColumn("obv", F.sum("_d").over(by_session().rowsBetween(Window.unboundedPreceding, 0))).drop("_d")
    return out.withColumns({"obv_change_5d": F.col("obv") - lag(F.col("obv"), 5), "obv_slope_20d": (F.col("obv") - lag(F.col("obv"), 20)) / 20})


@in_turn
def corporate_actions(df: DataFrame) -> DataFrame:
    """Flags and sizes of dividends and splits; df has dividends and stock_splits."""
    C, _, _, _, _ = prices()
    flag = lambda c: (F.coalesce(F.col(c), F.lit(0.0)) > 0).cast("int")
    sizes = {"dividend_amount": F.col("dividends"), "stock_split_ratio": F.col("stock_splits")}
    return df.withColumns({**sizes, "has_dividend": flag("dividends"), "dividend_yield_proxy": F.try_divide(F.col("dividends"), lag(C)), "has_stock_split": flag("stock_splits")})


def calendar(df: DataFrame) -> DataFrame:
    d, day = F.col("session_date"), F.weekday("session_date")
    return df.withColumns(
        {
            "day_of_week": day, "month": F.month(d), "quarter": F.quarter(d), "is_monday": (day == 0).cast("int"), "is_friday": (day == 4).cast("int"),
            "is_month_start": (F.dayofmonth(d) == 1).cast("int"), "is_month_end": (F.last_day(d) == d).cast("int"),
        }
    )


@in_turn
def against_market(df: DataFrame, market: DataFrame) -> DataFrame:
    """Excess returns, rolling beta (covariance over variance) and correlation; market: session_date, market_close."""
    C, _, _, _, _ = prices()
    order = Window.orderBy("session_date")  # one row per date
    back = lambda n: F.try_divide(F.col("market_close"), F.lag("market_close", n).over(order)) - 1
    m = market.select("session_date", back(1).alias("market_return_1d"), back(5).alias("market_return_5d"))
    out = df.withColumns({"_r1": change(C), "_r5": change(C, 5)}).join(m, "session_date", "left")
    r, x = F.col("_r1"), F.col("market_return_1d")
    out = out.withColumns({"excess_return_1d": r - x, "excess_return_5d": F.col("_r5") - F.col("market_return_5d")})
    out = moments(out.withColumn("_x1", x), ["_r1", "_x1"], [("_r1", "_r1"), ("_r1", "_x1"), ("_x1", "_x1")], {20, 60})
    c = lambda a, b, n: F.col(f"_c_{a}_{b}_{n}")
    betas = {f"rolling_beta_{n}d": F.try_divide(c("_r1", "_x1", n) / (n - 1), c("_x1", "_x1", n) / (n - 1)) for n in (20, 60)}
    alike = F.try_divide(c("_r1", "_x1", 20), F.sqrt(c("_r1", "_r1", 20)) * F.sqrt(c("_x1", "_x1", 20)))
    out = out.withColumns(betas | {"correlation_with_market_20d": alike, "abnormal_return": r - x})
    out = out.select(*[k for k in out.columns if not k.startswith(("_c_", "_mean_", "_x1"))])
    return out.withColumn("cumulative_abnormal_return", F.sum("abnormal_return").over(by_session().rowsBetween(Window.unboundedPreceding, 0))).drop("_r1", "_r5")


@in_turn
def forward(df: DataFrame, market: DataFrame | None = None) -> DataFrame:
    """Returns of the next 1, 3, 5 sessions, less the market's if given, and direction: labels only, never features."""
    C, _, _, _, _ = prices()
    out = df.withColumns({f"forward_return_{n}d": F.try_divide(F.lead(C, n).over(by_session()), C) - 1 for n in (1, 3, 5)})
    if market is not None:
        order = Window.orderBy("session_date")
        out = out.join(market.select("session_date", *[(F.try_divide(F.lead("market_close", n).over(order), F.col("market_close")) - 1).alias(f"_m{n}") for n in (1, 3, 5)]), "session_date", "left")
        out = out.withColumns({f"forward_excess_return_{n}d": F.col(f"forward_return_{n}d") - F.col(f"_m{n}") for n in (1, 3, 5)}).drop("_m1", "_m3", "_m5")
    return out.withColumns({f"direction_t_plus_{n}": F.signum(f"forward_return_{n}d").cast("int") for n in (1, 3, 5)})


@in_turn
def spikes(df: DataFrame, factor: float = 2.0) -> DataFrame:
    """Labels, never features: whether the next session's volume, and the deviation of the next five returns, are at least factor
    times that of the 20 sessions up to now; null without a full frame."""
    C, _, _, _, V = prices()
    out = rolled(df.withColumn("_r", change(C)), {"_mv": ("avg", "volume", 20, 0), "_sd": ("stddev", "_r", 20, 0)})
    ahead = by_session().rowsBetween(1, 5)
    coming = F.when(F.count("_r").over(ahead) == 5, F.stddev_samp("_r").over(ahead))
    return out.withColumns(
        {
            "volume_spike_t_plus_1": (F.lead(V).over(by_session()) >= factor * F.col("_mv")).cast("int"),
            "volatility_spike_t_plus_5": (coming >= factor * F.col("_sd")).cast("int"),
        }
    ).drop("_r", "_mv", "_sd")


@in_turn
def model_features(df: DataFrame) -> DataFrame:
    """The eight market features of the training table; frames of means and deviations end before the session itself."""
    C, O, H, L, V = prices()
    out = rolled(df.withColumn("_r", change(C)), {"_mv": ("avg", "volume", 20, 1), "market_volatility_20": ("stddev", "_r", 20, 1)})
    return out.withColumns(
        {
            "market_return_1d": F.col("_r"), "market_intraday_range": F.try_divide(H - L, O), "market_open_gap": F.try_divide(O, lag(C)) - 1, "market_log1p_volume": F.log1p(V),
            "market_volume_ratio_20": F.try_divide(V, F.col("_mv")), "market_momentum_5": change(C, 5), "market_momentum_20": change(C, 20),
        }
    ).drop("_r", "_mv")

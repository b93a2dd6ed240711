"""Frames composed of halves against plain frames, and what they cost."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import indicators as ind

START = dt.date(2020, 1, 1)


def series(spark, values, ticker="x"):
    rows = [(ticker, START + dt.timedelta(days=i // 2), "b" if i % 2 else "a", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, session_date date, source string, close double").repartition(3)


@pytest.mark.parametrize("kind, wanted", [("avg", np.mean), ("stddev", lambda x: np.std(x, ddof=1)), ("max", np.max), ("min", np.min)])
def test_rolled_is_a_plain_frame(spark, kind, wanted):
    draw = np.random.default_rng(3)
    values = [None if i in (7, 40) else float(v) for i, v in enumerate(1e5 + draw.standard_normal(150).cumsum())]
    run = ind.in_turn(lambda d: ind.rolled(d, {f"n{n}_{s}": (kind, "close", n, s) for n in (1, 2, 5, 20, 63) for s in (0, 1) if n > 1 or kind != "stddev"}))
    got = run(series(spark, values)).orderBy("session_date", "source").toPandas()
    for c in got.columns[4:]:
        n, skip = (int(x) for x in c[1:].split("_"))
        own = pd.Series(values, dtype=float).rolling(n).apply(wanted, raw=True).shift(skip)
        np.testing.assert_allclose(got[c].astype(float), own, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("f", [ind.trend, ind.volatility, ind.oscillators, ind.extremes])
def test_no_frame_is_gone_through_for_each_row(spark, f):
    bars = series(spark, [1.0, 2.0]).selectExpr("*", "close AS open", "close AS high", "close AS low", "close AS volume")
    assert "windowspecdefinition" in (plan := f(bars)._jdf.queryExecution().optimizedPlan().toString()) and "specifiedwindowframe(RowFrame, -19, currentrow$())" not in plan


def test_macd_sorts_once_and_keeps_no_lists(spark):
    plan = ind.macd(series(spark, [1.0, 2.0]))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "_block" not in plan

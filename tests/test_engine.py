"""Small cases of rules that driver tables do not reach."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.functions import text as tx
from tidemark.functions.tickers import NAMES, tickers
from tidemark.operators import events as ev
from tidemark.operators import gates, market, news, state
from tidemark.operators import sessions as ss
from tidemark.operators import targets as tg
from tidemark.schemas import MARKET, NEWS
from tidemark.sources import feeds, lake
from tidemark.streaming import bronze


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def found(text):
    import re

    names = {t: [t, *more] for t, more in NAMES.items()}
    place = {}
    for m in re.finditer(r"(?<!\w)([A-Z]{2,4}(?:/[A-Z]{2,4})+):", text):
        for t in m.group(1).split("/"):
            if t in names:
                place.setdefault(t, m.start())
    for t, own in names.items():
        for n in own:
            m = re.search(r"(?<!\w)" + re.escape(n) + r"(?!\w)", text, re.I)
            if m:
                place.setdefault(t, m.start())
                break
    return [t for t, _ in sorted(place.items(), key=lambda x: x[1])]


@pytest.mark.parametrize("text", ["HPG/VCB: Vietcombank và Hòa Phát", "GDP và USD tăng, Hòa Phát giảm", "ăHPG hpg", "", "VNM (Vinamilk), FPT; fpt retail", "Tập đoàn Xăng dầu Việt Nam, NT2 và PC1", "XX/HPG: TP.HCM HDBank ceo bid", "MASAN-msn đất xanh"])
def test_tickers(spark, text):
    assert one(spark, tickers(F.col("t")), t=text) == found(text)


def test_tickers_of_null(spark):
    assert one(spark, tickers(F.lit(None).cast("string"))) == []


def test_text(spark):
    assert one(spark, tx.clean_html("t"), t=" <p>a\n\t b</p> <i>c</i>") == "a b c"
    assert one(spark, tx.html_text("t"), t="<b>A &amp; B</b> #233;t x &lt;") == "A & B ét x <"
    assert one(spark, tx.category(F.col("t")), t="Công ty chia CỔ TỨC và phát hành") == "CỔ TỨC"
    assert one(spark, tx.category(F.col("t")), t="x") == tx.OTHER_CATEGORY
    assert one(spark, tx.mention_key(F.col("t")), t="Đất Xanh – Hòa Phát") == "at xanh hoa phat"
    assert one(spark, tx.utc_text(F.col("t")), t="2024-01-02T09:00:00+07:00") == "2024-01-02T02:00:00+00:00"
    assert one(spark, tx.local_text(F.col("t")), t="2024-01-02T09:00:00+07:00") == "2024-01-02T09:00:00+07:00"
    assert one(spark, tx.utc_text(F.col("t")), t="soon") == ""
    assert one(spark, tx.impact_label(F.lit(0.02))) == "positive"
    assert one(spark, tx.impact_label(F.lit(-0.02))) == "negative"
    assert one(spark, tx.impact_label(F.lit(0.0))) == "neutral"


BARS = "ticker string, session_date date, close double, daily_return double"


def day(n):
    return dt.date(2024, 9, n)


def test_anchor_and_t0(spark):
    bars = spark.createDataFrame([("A", day(20), 10.0, None), ("A", day(21), 11.0, 0.1)], BARS)
    events = spark.createDataFrame([(1, "A", day(21), False), (2, "A", day(21), True), (3, "A", day(1), False)], "event_id int, ticker string, event_date date, after_close boolean")
    t0 = {r.event_id: r.t0_index for r in ss.reaction_session(events, market.indexed(bars)).collect()}
    known = {r.event_id: r.known_index for r in ss.known_session(events, market.indexed(bars)).collect()}
    assert t0 == {1: 2, 3: 1}
    assert known == {1: 1, 2: 2}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 28), min_size=1, max_size=8, unique=True), st.lists(st.tuples(st.integers(1, 28), st.booleans()), min_size=1, max_size=6))
def test_calendar_equals_range_join(spark, sessions, asked):
    bars = spark.createDataFrame([("A", day(d), float(d), None) for d in sorted(sessions)], BARS)
    events = spark.createDataFrame([(i, "A", day(d), a) for i, (d, a) in enumerate(asked)], "event_id int, ticker string, event_date date, after_close boolean")
    t0 = {r.event_id: r.t0_date for r in ss.reaction_session(events, market.indexed(bars)).collect()}
    known = {r.event_id: r.known_date for r in ss.known_session(events, market.indexed(bars)).collect()}
    for i, (d, after) in enumerate(asked):
        later = [s for s in sessions if s > d or s == d and not after]
        before = [s for s in sessions if s < d or s == d and after]
        assert t0.get(i) == (day(min(later)) if later else None)
        assert known.get(i) == (day(max(before)) if before else None)
    assert all(t0[i] >= day(asked[i][0]) for i in t0)
    window = ev.event_window(events, bars)
    assert window.count() == len(t0) * len(ev.OFFSETS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 28), st.sampled_from("abc")), min_size=1, max_size=12, unique=True), st.lists(st.tuples(st.integers(1, 28), st.booleans()), min_size=1, max_size=6))
def test_several_bars_a_day(spark, bars_of, asked):
    bars = spark.createDataFrame([("A", day(d), float(d), None, s) for d, s in bars_of], BARS + ", source string")
    events = spark.createDataFrame([(i, "A", day(d), a) for i, (d, a) in enumerate(asked)], "event_id int, ticker string, event_date date, after_close boolean")
    order = sorted(bars_of)
    t0 = ss.reaction_session(events, market.indexed(bars)).collect()
    known = ss.known_session(events, market.indexed(bars)).collect()
    assert len({r.event_id for r in t0}) == len(t0) and len({r.event_id for r in known}) == len(known)
    t0, known = {r.event_id: r.t0_index for r in t0}, {r.event_id: r.known_index for r in known}
    for i, (d, after) in enumerate(asked):
        assert t0.get(i) == min((n for n, (x, _) in enumerate(order, 1) if x > d or x == d and not after), default=None)
        assert known.get(i) == max((n for n, (x, _) in enumerate(order, 1) if x < d or x == d and after), default=None)


def raw_bar(**kw):
    base = dict(event_id="e", schema_version=1, ticker="abc", session_date="2024-09-20", interval="1d", open=10.0, high=11.0, low=9.0, close=10.0, volume=1.0, source="S", collected_at_utc="2024-09-20T10:00:00Z") | kw
    return tuple(base.get(f.name) for f in MARKET)


def test_market_faults(spark):
    rows = [raw_bar(), raw_bar(session_date="2024-09-23", close=0.0), raw_bar(session_date="2024-09-24", close=12.0, high=12.0 - 1e-7), raw_bar(session_date="bad", ticker=None, interval=None), raw_bar(session_date="2024-09-20", collected_at_utc="2024-09-21T10:00:00Z", close=10.5)]
    out = {str(r.session_date): r for r in market.market_silver(spark.createDataFrame(rows, MARKET)).collect()}
    assert out["2024-09-20"].close == 10.5 and out["2024-09-20"].is_valid
    assert out["2024-09-23"].data_quality_errors == ["invalid_close", "low_above_ohlc"]
    assert out["2024-09-24"].daily_return is None and out["2024-09-24"].is_valid  # the invalid bar before is its base, and zero
    assert out["None"].data_quality_errors == ["invalid_session_date"]


def test_news_faults(spark):
    base = {f.name: None for f in NEWS}
    rows = [base | dict(event_id="1", schema_version=1, title="<b>HPG</b>", url="https://x", published_at_utc="2024-01-01T00:00:00Z", collected_at_utc="2024-01-01T00:00:00Z", content="x" * 300), base | dict(event_id="1", schema_version=1, title="short"), base | dict(title="", published_at_utc="never")]
    df = spark.createDataFrame([tuple(r[f.name] for f in NEWS) for r in rows], NEWS)
    out = {r.event_id: r for r in news.news_silver(df, keep_all=True).collect()}
    assert out["1"].is_valid and out["1"].merged_tickers == ["HPG"] and out["1"].has_full_text
    assert out[None].data_quality_errors == ["missing_event_id", "missing_title", "invalid_url", "invalid_published_at", "invalid_collected_at", "unsupported_schema"]
    gate = {r.check: r.violations for r in gates.gate_news(news.news_silver(df, keep_all=True)).collect()}
    assert gate["invalid_rows"] == 1 and gate["missing_columns"] == 0
    with pytest.raises(ValueError, match="FAILED .*invalid_rows=1"):
        gates.enforce(gates.gate_news(news.news_silver(df, keep_all=True)))


def test_upsert(spark):
    rows = [(1, "u", "t", "s", "", ["A"], "rulebased"), (2, "u", "t", "s", "", ["B", "A"], "hybrid"), (3, "u", "t", "s", "", None, "rulebased")]
    out = state.upserted(spark.createDataFrame(rows, "observed_at int, url string, title string, summary string, content string, tickers array<string>, strategy string")).collect()
    assert len(out) == 1 and out[0].tickers == ["A", "B"] and out[0].strategy == "hybrid" and out[0].versions == 3


def test_routes_and_attempts(spark):
    rows = [(1, ["A"], "x" * 300, 1), (2, [], "", 2), (3, ["B"], "", 3)]
    out = {r.id: r.route for r in state.routed(spark.createDataFrame(rows, "id int, tickers array<string>, content string, observed_at int"), 1).collect()}
    assert out == {1: "ready", 2: "rejected", 3: "deferred"}
    log = [(1, i, "failed", "e") for i in range(4)] + [(1, 9, "success", None), (2, 1, "rate_limited", "x" * 900)]
    a = {r.id: r for r in state.attempts(spark.createDataFrame(log, "id int, at int, status string, error string")).collect()}
    assert a[1].attempts == 5 and a[2].attempts == 0 and len(a[2].last_error) == 500
    assert [r.id for r in state.retryable(state.attempts(spark.createDataFrame(log, "id int, at int, status string, error string"))).collect()] == [2]


def test_months(spark):
    w = one(spark, state.month_windows(F.lit("2024-01-15").cast("date"), F.lit("2024-03-01").cast("date")))
    assert [(str(x["from"]), str(x["until"])) for x in w] == [("2024-01-15", "2024-02-01"), ("2024-02-01", "2024-03-01")]


def test_bio(spark):
    text = "Tập đoàn Hòa Phát tăng"
    df = spark.createDataFrame([(text, [(0, 17)])], f"t string, s {ent.SPAN}")
    labels = df.withColumn("w", ent.tokens(F.col("t"))).select(ent.bio(F.col("w"), F.col("s")).alias("x")).first()["x"]
    assert labels == ["B-ORG", "I-ORG", "I-ORG", "I-ORG", "O"]
    r = spark.createDataFrame([(["I-ORG", "B-ORG", "I-ORG", "O", "B-ORG"],)], "l array<string>").select(ent.ranges(F.col("l")).alias("x")).first()["x"]
    assert [(x.start, x.end) for x in r] == [(0, 1), (1, 3), (4, 5)]
    assert ent.indel("abcd", "abxd") == 75.0


def test_token_features(spark):
    def title(w):
        return w.istitle()

    text = "CTCP Hòa-Phát tăng 12 % A1B 1a x²"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "forms long, t string").withColumn("w", ent.tokens(F.col("t")))
    rows = {r.forms: r for r in ent.token_features(df, "w").select("forms", "w", "features").collect()}
    assert rows[2].features == rows[3].features == []
    words = [w.token for w in rows[1].w]
    for i, (w, f) in enumerate(zip(words, rows[1].features, strict=True)):
        low = w.casefold()
        assert (f.lower, f.last3, f.last2, f.first3) == (low, low[-3:], low[-2:], low[:3])
        assert (f.is_upper, f.is_title, f.is_digit, f.has_digit) == (w.isupper(), title(w), w.isdigit(), any(c.isdigit() for c in w))
        assert f.length == min(len(w), 20) and (f.first, f.last) == (i == 0, i == len(words) - 1)
        back, ahead = words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None
        for side, v in (("back", back), ("ahead", ahead)):
            assert (f[f"{side}_lower"], f[f"{side}_is_upper"], f[f"{side}_is_title"]) == ((v.casefold(), v.isupper(), title(v)) if v else (None, None, None))


def test_linking_is_all_pairs(spark):
    import random

    draw = random.Random(5)
    names = sorted({"".join(draw.choice("abcd ") for _ in range(draw.randint(3, 24))).strip() for _ in range(150)} - {""})
    names = [n for n in {" ".join(n.split()) for n in names} if len(n) > 2]

    def changed(n):
        k = draw.randrange(len(n))
        return draw.choice([n[:k] + n[k + 1 :], n[:k] + draw.choice("abcdz") + n[k:], n[:k] + draw.choice("abcdz") + n[k + 1 :]])

    mentions = sorted({" ".join(changed(changed(n) if draw.random() < 0.4 else n).split()) for n in names} - {""})
    known = spark.createDataFrame([(n, f"T{i}") for i, n in enumerate(names)], "key string, ticker string")
    got = ent.linked(spark.createDataFrame([(m,) for m in mentions], "mention string"), known, known.limit(0)).collect()
    best = {m: max(ent.indel(m, n) for n in names) for m in mentions}
    assert {r.mention: r.link_confidence for r in got} == {m: round(b / 100, 3) if m in names or (b >= 90 and len(m) > 2) else 0.0 for m, b in best.items()}
    assert any(90 <= b < 100 for b in best.values())


def test_links_of_many_alike_names(spark):
    """Names that share nearly all pairs of letters are not compared all with all: that took minutes here."""
    import time

    known = spark.range(6000).selectExpr("concat('supplier ', lpad(id, 9, '0')) AS key", "CAST(id AS STRING) AS ticker")
    asked = known.selectExpr("ticker AS own", "CASE WHEN ticker % 2 = 0 THEN concat(key, 'x') ELSE concat(left(key, 8), right(key, 9)) END AS mention")
    start = time.monotonic()
    got = ent.linked(asked, known, known.limit(0)).filter("ticker <=> own AND link_confidence > 0.97").count()
    assert got == 6000 and time.monotonic() - start < 60


def test_link_ties(spark):
    asked = spark.createDataFrame([("abcdefghijkl",), ("mnopqrstuvwx",)], "mention string")
    known = spark.createDataFrame([("abcdefghijklz", "K2"), ("abcdefghijkla", "K1")], "key string, ticker string")
    aliases = spark.createDataFrame([("aabcdefghijkl", "A1"), ("mnopqrstuvwxy", "A2")], "key string, ticker string")
    got = {r.mention: (r.ticker, r.link_confidence) for r in ent.linked(asked, known, aliases).collect()}
    assert got == {"abcdefghijkl": ("K1", 0.96), "mnopqrstuvwx": ("A2", 0.96)}


def test_feed(spark):
    xml = "<rss><channel><item><title>HPG chia cổ tức</title><link>https://x</link><pubDate>Mon, 20 Jul 2026 09:00:00 +0700</pubDate></item><item><title> </title></item></channel></rss>"
    rows = feeds.feed_items(spark.createDataFrame([(xml,)], "xml string")).collect()
    assert len(rows) == 1 and rows[0].category == "CỔ TỨC" and rows[0].published_precision == "timestamp"
    assert rows[0].published == dt.datetime(2026, 7, 20, 2, 0)


def test_article(spark):
    long = "A paragraph that is long enough to be kept by the scope rule of the article. " * 2
    html = f'<html><head><title>T</title><meta name="author" content="N"></head><body><p>menu menu menu menu menu menu menu menu menu menu menu</p><article><div><p>{long}</p><p>{long}</p><p>short</p><p>{long[5:]}</p></div></article></body></html>'
    r = feeds.article(spark.createDataFrame([(html,), (None,)], "html string")).collect()
    more = '<meta property="og:image" content="/i.png"><div id="article-1"><div><p>Tom &amp; Jerry %s<p>%s</div></div><p>%s</p>' % (long, long[3:], long[7:])
    short = "<article><p>x</p></article><p>Tom &amp; <b>Jerry</b> %s</p>" % long
    m = feeds.article(spark.createDataFrame([(more, "https://h/a/b"), (short, None)], "html string, url string")).collect()
    assert m[0].article_text.split("\n") == ["Tom & Jerry " + long.strip(), long[3:].strip()] and m[0].article_image == "https://h/i.png"
    assert m[1].article_text == "Tom & Jerry " + long.strip() and m[1].article_image is None
    assert r[0].article_title == "T" and r[0].article_author == "N" and r[0].article_text.count("\n") == 1 and "menu" not in r[0].article_text
    assert r[1].article_text == ""


def test_bodies(spark):
    import gzip
    import zlib

    rows = [(gzip.compress(b"a"), "gzip"), (zlib.compress(b"b"), "deflate"), (b"c", "identity"), (b"\x1f\x8bbad", "gzip"), (None, None), (b"d", "br"), (gzip.compress(b"e" * 30_000_000), "gzip"), (gzip.compress(b"f") + gzip.compress(b"g"), "GZIP")]
    assert [r.page for r in feeds.body_text(spark.createDataFrame(rows, "b binary, e string"), "b", "e").collect()] == ["a", "b", "c", None, None, None, None, "fg"]


def test_paths(tmp_path, spark):
    for bad in ("/etc", "../x", "a/../b", "s3://b/x", ""):
        with pytest.raises(ValueError):
            lake.relative(bad)
    assert lake.Lake("/r/").path("bronze", "news/x") == "/r/bronze/news/x"


def test_stream_restart(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("in", "out", "dead", "check")}
    spark.createDataFrame([('{"event_id": "1", "title": "a"}',), ("not json",), ("null",)], "value string").write.text(d["in"])

    def go():
        q = bronze.stream_bronze(bronze.files(spark, d["in"]), d["out"], d["dead"], d["check"])
        q.awaitTermination()

    go()
    go()
    assert [r.event_id for r in lake.read_json(spark, d["out"], NEWS).collect()] == ["1"]
    assert spark.read.json(d["dead"]).count() == 2


def test_targets_mask(spark):
    bars = spark.createDataFrame([("A", day(n), 10.0 + n, 0.2 if n == 12 else 0.01) for n in (9, 10, 11, 12, 13, 16)], BARS)
    events = spark.createDataFrame([(1, "A", day(10), False, "timestamp"), (2, "A", day(10), False, "date")], "event_id int, ticker string, event_date date, after_close boolean, published_precision string")
    out = {(r.event_id, r.horizon): r for r in tg.targets_long(events, bars).collect()}
    assert out[1, "t0"].mask and out[1, "t0"].label == 2
    assert not out[2, "t0"].mask and out[2, "t0"].label == tg.MASKED and out[2, "t0"].stock_return is None
    assert out[1, "t1"].mask and not out[1, "t3"].mask  # a jump lies before the third session


ODD = ["İVNM ıSSI ſsi SSI", "ß VCB-ẞ", "hÒA pHÁT hòa phát", "AAA/HPG: hpg HPG/AAA:", "DIC DIC Corp", "fpt retail FPT Retail_", "VIC1 1VIC _VIC VIC", "Kdh KDH", "vietjet air Vietjet", "nt2 NT2:", "ngân hàng á châu Á Châu ACB"]


@pytest.mark.parametrize("text", ODD)
def test_tickers_by_plain_patterns(spark, text):
    assert one(spark, tickers(F.col("t")), t=text) == found(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aA İıſK_1-/:. ", "HPG", "hpg", "VCB", "DIC", "DIC Corp", "Hòa Phát", "FPT", "FPT Retail", "Vietjet Air", "MASAN", "/", ":"]), max_size=14).map("".join))
def test_places_by_plain_patterns(text):
    from tidemark.functions.tickers import in_order

    assert in_order(text, tuple((t, (t, *more)) for t, more in NAMES.items())) == found(text)

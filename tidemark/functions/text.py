"""Text, time and identity expressions. All are built-in functions but html_text, whose entities need Python."""

from __future__ import annotations

import html
import re
import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ZONE = "Asia/Ho_Chi_Minh"
FULL_TEXT_CHARS = 200


def clean_html(c: Column | str) -> Column:
    """Tags become spaces, white space collapses, ends are trimmed; null becomes ''. White space is Java's ASCII class."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "), r"\s+", " "))


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(html.unescape)


def html_text(c: Column | str) -> Column:
    """clean_html, with numeric references that lost their ampersand repaired and all entities resolved; Unicode white space."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "), r"(?<!&)#(\d+);", "&#$1;")
    plain = F.when(bare.contains("&"), _unescaped(bare)).otherwise(bare)
    return F.regexp_replace(F.regexp_replace(plain, r"(?U)\s+", " "), r"^ | $", "")


@F.pandas_udf(StringType())
def mention_key(s: pd.Series) -> pd.Series:
    """Case-folded letters and digits without marks that take no room (category Mn); anything else is one space."""

    def key(text):
        if text is None:
            return None
        plain = "".join(ch for ch in unicodedata.normalize("NFD", text.casefold()) if unicodedata.category(ch) != "Mn")
        return re.sub(r"[^a-z0-9]+", " ", plain).strip()

    return s.map(key)


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b or "", x) if x else None for b, x in zip(base, link, strict=True)])


def extraction_text(mode: str = "silver") -> Column:
    """Text that tickers are looked for in. silver: title and the full text, or the summary where the text is short;
    gate: title, summary and content; stored: title and the content, else the summary."""
    if mode == "gate":
        return F.trim(F.concat_ws(" ", "title", "summary", "content"))
    if mode == "stored":
        return F.trim(F.concat_ws(" ", "title", F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("summary"))))
    body = F.when(F.length("content") >= FULL_TEXT_CHARS, F.col("content")).otherwise(F.col("summary"))
    return F.trim(F.concat_ws("\n\n", F.col("title"), body))


def event_key(url: Column, source: Column, title: Column) -> Column:
    return F.sha2(F.coalesce(F.nullif(url, F.lit("")), F.concat_ws("|", F.coalesce(source, F.lit("")), F.coalesce(title, F.lit("")))), 256)


def market_key(ticker: Column, date: Column, source: Column) -> Column:
    return F.sha2(F.concat_ws("|", ticker, date.cast("string"), F.lit("1d"), source), 256)


def short_key(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 16)


#: Where texts and sessions come from.
LOCAL_ZONE = "Asia/Ho_Chi_Minh"


def instant(c: Column | str, naive_zone: str = LOCAL_ZONE) -> Column:
    """Timestamp of ISO text; text without an offset is local time; bad text is null."""
    c = F.col(c) if isinstance(c, str) else c
    parsed = F.try_to_timestamp(c)
    has_offset = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_offset, parsed).otherwise(F.to_utc_timestamp(parsed, naive_zone))


def utc_text(c: Column) -> Column:
    """ISO text in UTC; '' where c is not a time."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))


def local_text(c: Column, zone: str = ZONE) -> Column:
    """ISO text in local time; c itself where it is not a time."""
    at = F.from_utc_timestamp(F.try_to_timestamp(c), zone)
    return F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+07:00'"), c, F.lit(""))


# Categories in their order of precedence, and the lower-case phrases of each.
CATEGORIES = {
    "CỔ TỨC": ["cổ tức", "chia cổ tức", "dividend"],
    "MUA BÁN/ PHÁT HÀNH": ["chào bán", "phát hành", "tăng vốn", "mua bán"],
    "CHUYỂN ĐỘNG THỊ TRƯỜNG": ["vn-index", "thị trường", "khối ngoại", "thanh khoản"],
    "CHỨNG KHOÁN/ TÀI CHÍNH": ["ngân hàng", "chứng khoán", "tài chính", "room tín dụng"],
    "VIỆT NAM": ["chính phủ", "thủ tướng", "kinh tế vĩ mô", "xuất khẩu"],
}
OTHER_CATEGORY = "DOANH NGHIỆP"


def category(text: Column, rules: dict[str, list[str]] | None = None, default: str = OTHER_CATEGORY) -> Column:
    """Name of the first rule with a phrase in the lower-cased text."""
    low, out = F.lower(text), None
    for name, phrases in (rules or CATEGORIES).items():
        hit = low.contains(phrases[0])
        for p in phrases[1:]:
            hit = hit | low.contains(p)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def impact_label(value: Column, threshold: float = 0.02) -> Column:
    """positive from +threshold, negative to -threshold, else neutral; null stays null."""
    return F.when(value >= threshold, "positive").when(value <= -threshold, "negative").when(value.isNotNull(), "neutral")


def join_quality(abnormal: Column, precision: Column) -> Column:
    exact = F.when(abnormal.isNotNull(), "exact_abnormal_return").otherwise("raw_return_no_benchmark")
    return F.concat(exact, F.when(precision.eqNullSafe("timestamp"), "").otherwise("|imprecise_event_time"))


def growth(now: Column, then: Column) -> Column:
    """now / then - 1; null for a null or zero base."""
    return F.try_divide(now, then) - 1

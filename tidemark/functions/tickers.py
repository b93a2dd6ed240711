"""Tickers in texts: listed symbols before a colon, and company names, in the order of their places."""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Tickers and further names of each (the symbol itself is always a name), in the order that settles ties.
NAMES = {
    "ACB": ["Ngân hàng Á Châu", "Asia Commercial Bank"],
    "BID": ["BIDV", "Ngân hàng Đầu tư và Phát triển Việt Nam"],
    "BSR": ["Bình Sơn Refining", "Lọc hóa dầu Bình Sơn"],
    "CTG": ["VietinBank", "Ngân hàng Công Thương Việt Nam"],
    "DIG": ["DIC Corp", "DIC"],
    "DXG": ["Đất Xanh", "Đất Xanh Group"],
    "FPT": ["Tập đoàn FPT", "Công ty Cổ phần FPT"],
    "HAG": ["Hoàng Anh Gia Lai", "HAGL"],
    "HPG": ["Hòa Phát", "Tập đoàn Hòa Phát"],
    "MWG": ["Thế Giới Di Động", "Mobile World"],
    "NLG": ["Nam Long", "Nam Long Group"],
    "PVD": ["PV Drilling", "Khoan Dầu khí"],
    "SSI": ["Chứng khoán SSI", "SSI Securities"],
    "TCB": ["Techcombank", "Ngân hàng Kỹ thương"],
    "VCB": ["Vietcombank", "Ngân hàng Ngoại thương"],
    "VHM": ["Vinhomes"],
    "VIC": ["Vingroup", "Tập đoàn Vingroup"],
    "VNM": ["Vinamilk", "Công ty Cổ phần Sữa Việt Nam"],
    "BCM": ["Becamex IDC"],
    "BVH": ["Bảo Việt", "Tập đoàn Bảo Việt"],
    "GAS": ["PV Gas", "Tổng Công ty Khí Việt Nam"],
    "GVR": ["Cao su Việt Nam", "Tập đoàn Công nghiệp Cao su Việt Nam"],
    "HDB": ["HDBank", "Ngân hàng Phát triển TP.HCM"],
    "MBB": ["MB Bank", "Ngân hàng Quân đội"],
    "MSN": ["Masan", "Tập đoàn Masan"],
    "PLX": ["Petrolimex", "Tập đoàn Xăng dầu Việt Nam"],
    "POW": ["PV Power", "Điện lực Dầu khí"],
    "SAB": ["Sabeco", "Tổng Công ty Bia Rượu"],
    "SHB": ["Ngân hàng Sài Gòn - Hà Nội"],
    "SSB": ["SeABank", "Ngân hàng Đông Nam Á"],
    "STB": ["Sacombank", "Ngân hàng Sài Gòn Thương Tín"],
    "TPB": ["TPBank", "Ngân hàng Tiên Phong"],
    "VIB": ["Ngân hàng Quốc tế Việt Nam"],
    "VJC": ["Vietjet", "Vietjet Air"],
    "VPB": ["VPBank", "Ngân hàng Việt Nam Thịnh Vượng"],
    "VRE": ["Vincom Retail"],
    "ANV": ["Nam Việt"],
    "CEO": ["CEO Group"],
    "CII": ["Đầu tư Hạ tầng Kỹ thuật TP.HCM"],
    "DBC": ["Dabaco"],
    "DGC": ["Hóa chất Đức Giang"],
    "DGW": ["Digiworld"],
    "DPM": ["Đạm Phú Mỹ"],
    "DPR": ["Cao su Đồng Phú"],
    "HCM": ["Chứng khoán HSC"],
    "KDH": ["Khang Điền"],
    "KBC": ["Kinh Bắc"],
    "MSB": ["Ngân hàng Hàng hải"],
    "NT2": ["Điện lực Dầu khí Nhơn Trạch 2"],
    "PC1": ["PC1 Group"],
    "REE": ["Cơ điện lạnh REE"],
    "SBT": ["Thành Thành Công - Biên Hòa"],
    "SZC": ["Sonadezi Châu Đức"],
    "VCI": ["Chứng khoán Vietcap"],
    "VND": ["Chứng khoán VNDirect"],
    "VOS": ["Vận tải biển Việt Nam"],
    "VIX": ["Chứng khoán VIX"],
    "VTP": ["Viettel Post"],
    "AAA": ["An Phat Bioplastics"],
    "ACV": ["Airports Corporation of Vietnam"],
    "BWE": ["Biwase"],
    "CMG": ["CMC Corporation"],
    "CSV": ["Southern Basic Chemicals"],
    "CTR": ["Viettel Construction"],
    "EIB": ["Eximbank"],
    "FRT": ["FPT Retail", "Long Châu"],
    "GEX": ["Gelex"],
    "HNX": [],
    "HVN": ["Vietnam Airlines"],
    "KDC": ["Kido Group"],
    "LPB": ["LPBank", "LienVietPostBank"],
    "NAB": ["Nam A Bank"],
    "OCB": ["Orient Commercial Bank"],
    "PDR": ["Phat Dat Real Estate"],
    "SHS": ["Chứng khoán Sài Gòn - Hà Nội"],
    "VHC": ["Vinh Hoan"],
    "VSC": ["Vietnam Container Shipping"],
    "VSH": ["Vinh Son - Song Hinh"],
}

# The basket that news is filtered to.
BASKET = [
    "ACB", "BCM", "BID", "BVH", "CTG", "FPT", "GAS", "GVR", "HDB", "HPG",
    "MBB", "MSN", "MWG", "PLX", "POW", "SAB", "SHB", "SSB", "SSI", "STB",
    "TCB", "TPB", "VCB", "VIB", "VHM", "VIC", "VJC", "VNM", "VPB", "VRE",
]

LISTED = re.compile(r"(?<!\w)([A-Z]{2,4}(?:/[A-Z]{2,4})+):")


class Fold(dict):
    """Code point of a letter: the one that stands for all its cases. Always one for one, so that places stay."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        out = next((x for x in ("i" if c in "İı" else c.casefold(), c.lower(), c) if len(x) == 1), c)
        self[code] = ord(out)
        return self[code]


FOLD = Fold()


def folded(text: str) -> str:
    if text.isascii():
        return text.lower()
    out = text.casefold()  # one for one where it is as long as the text, as it never shortens
    return out if len(out) == len(text) and "ı" not in text else text.translate(FOLD)


@functools.lru_cache(maxsize=16)
def automaton(names: tuple[tuple[str, tuple[str, ...]], ...]) -> ahocorasick.Automaton:
    """All names of all tickers in one automaton over folded letters; a name holds (ticker's turn, name's rank) of each ticker."""
    held: dict[str, list[tuple[int, int]]] = {}
    for turn, (_, own) in enumerate(names):
        for rank, name in enumerate(own):
            held.setdefault(folded(name), []).append((turn, rank))
    out = ahocorasick.Automaton()
    for name, whose in held.items():
        out.add_word(name, (len(name), whose))
    out.make_automaton()
    return out


def in_order(text: str, names: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    """Tickers of a text by place. One pass of the automaton finds every name; a name counts between word boundaries, and of a
    ticker's names the first that occurs at all, where it first does."""
    place: dict[str, int] = {}
    if ":" in text:
        known = {ticker for ticker, _ in names}
        for m in LISTED.finditer(text):
            for ticker in m.group(1).split("/"):
                if ticker in known:
                    place.setdefault(ticker, m.start())
    best: dict[int, tuple[int, int]] = {}
    end_of_text = len(text)
    for last, (length, whose) in automaton(names).iter(folded(text)):
        first, after = last - length + 1, last + 1
        if (first and ((c := text[first - 1]).isalnum() or c == "_")) or (after < end_of_text and ((c := text[after]).isalnum() or c == "_")):
            continue
        for turn, rank in whose:
            if turn not in best or (rank, first) < best[turn]:
                best[turn] = (rank, first)
    for turn in sorted(best):
        place.setdefault(names[turn][0], best[turn][1])
    return sorted(place, key=place.__getitem__)  # ties stay as they came in: lists first, then dictionary order


def tickers(text: Column, names: dict[str, list[str]] | None = None, keep: list[str] | None = None) -> Column:
    """Array of tickers found in a text, ordered by place.

    A ticker listed as in "AAA/BBB:" stands at its list; any other at the match of the first of its names, in dictionary order,
    that occurs at all. Ties keep lists first, then dictionary order. keep filters afterwards. Null gives an empty array.
    """
    every = tuple((t, (t, *more)) for t, more in (names or NAMES).items())

    @F.arrow_udf(ArrayType(StringType()))
    def find(column: pa.Array) -> pa.Array:
        return pa.array([in_order(x.as_py() or "", every) for x in column], pa.list_(pa.string()))

    found = find(text)
    return F.array_intersect(found, F.array(*[F.lit(t) for t in keep])) if keep else found


def merged(first: Column, second: Column) -> Column:
    """Ordered union of two ticker arrays; null counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(first, empty), F.coalesce(second, empty)))


def added(second: Column, first: Column) -> Column:
    """Tickers of second that first lacks."""
    empty = F.array().cast("array<string>")
    return F.array_except(F.coalesce(second, empty), F.coalesce(first, empty))

"""Operator 1: exact BPE encoding and decoding.

Method: dynamic programming over prefixes (prefix_bpe.py): the matches of a suffix automaton over the vocabulary plus tests of
token pairs give the one last token of every prefix; back-pointers from the end of a word give its ids. Texts are cut into
words as the tokenizer file's own pre-tokenizer does; a table of at most MEMO_WORDS words already seen saves repeated work and
holds no result that the automaton would not give again.

The work is one pass over the rows without a shuffle. Texts are used whole, whatever their length; the memory that a word needs
is in proportion to it, and what workers keep is bounded.

Defined results: a null text encodes as an empty one (no ids, decoded text empty); white space alone gives no ids; special
strings in a text are one id, as the library does by default; repeated rows are encoded each; an empty table gives an empty
one; an input column named as an added one is replaced. Decoding: null ids give an empty text; ids that the vocabulary does not
have are left out, as the library does.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.common import map_text, table
from tidemark.llm.prefix_bpe import LastTokens

#: Words kept in a worker's table before it is emptied.
MEMO_WORDS = 100_000

_ADDED = "n_tokens long, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class Memo(dict):
    """Packed ids by word; a word not seen yet is encoded, and the encoder may keep it here."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        return self.encode(word)


class WordBpe:
    """A BPE tokenizer with word ends, from a file of the tokenizers library.

    The last letter of a word together with the word end is one symbol; here it is the letter shifted into a private plane.
    """

    SHIFT = 0xF0000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        self.end = end

        def symbols(token: str) -> str:
            if not token.endswith(end):
                return token
            body = token[: -len(end)]
            return body[:-1] + chr(ord(body[-1]) + self.SHIFT)

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # a merge is known by its two strings with a space between, which no token holds
        rank = {" ".join(map(symbols, pair)): n for n, pair in enumerate(model["merges"])}
        self.tokens = LastTokens({i: symbols(t) for t, i in model["vocab"].items() if t not in special}, lambda a, b: rank.get(f"{a} {b}"))
        self.shown = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in special.items()}
        self.special = special
        self.cut_special = regex.compile("|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", WHITE)).findall
        self.letters = byte_letters()
        self.memo = Memo(self.word)

    def word(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode("utf-8")])
        ids = self.tokens.encode(letters[:-1] + chr(ord(letters[-1]) + self.SHIFT))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = packed
        return packed

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each character alone: no final sigma
        return b"".join(map(self.memo.__getitem__, self.words(text.lower())))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after another."""
        if not text:
            return b""
        if not any(t in text for t in self.special):
            return self.plain(text)
        out, at = [], 0
        for m in self.cut_special.finditer(text):
            out += [self.plain(text[at : m.start()]), struct.pack("<I", self.special[m.group()])]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Tokens with a space between them: the file names no decoder, and the library then joins them so."""
        shown = map(self.shown.get, np.frombuffer(ids, "<u4").tolist())
        return " ".join(filter(None, shown))


#: White space of the pattern's \s: Unicode's property, without the separators U+001C-U+001F that Python adds.
WHITE = r"\t-\r\x20\x85\xa0  -     　"


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_encode(df: DataFrame, vocabulary: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add n_tokens, ids (packed little-endian uint32) and decoded (the text that the ids decode to)."""

    def make():
        t = tokenizer(vocabulary)

        def run(texts: list) -> dict:
            ids = [t.encode(x) for x in texts]
            return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [t.decode(x) for x in ids]}

        return run

    return map_text(df, make, _ADDED, text_col, keep_text)


def bpe_decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text of packed ids; null ids give an empty text."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def text(ids):
        t = tokenizer(vocabulary)
        return ids.map(lambda x: t.decode(x or b""))

    return df.withColumn(out_col, text(F.col(ids_col)))


def unpacked(ids: str):
    """Column of packed ids as array<bigint>, by built-in functions."""
    h = F.hex(F.col(ids))
    at = F.sequence(F.lit(0), F.greatest(F.length(h) / 8, F.lit(1)).cast("int") - 1)
    byte = lambda i, k: F.substr(h, i * 8 + 1 + 2 * k, F.lit(2))
    full = F.transform(at, lambda i: F.conv(F.concat(byte(i, 3), byte(i, 2), byte(i, 1), byte(i, 0)), 16, 10).cast("long"))
    return F.when(F.length(h) >= 8, full).otherwise(F.array().cast(ArrayType(LongType())))


def op1_bpe_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every whole document; digests of the ids and of the decoded text."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep_text=False)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))

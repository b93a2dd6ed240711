"""Operator 2: token counts without token lists.

Method: the tokenizer is compiled to a deterministic transducer whose transitions carry the change of the token count
(prefix_bpe.py; states are made when first met). Every text is cut into chunks. A chunk's map says for an entry state in which
state the chunk is left and how many tokens it adds; maps of neighbours are composed pairwise, level by level, and the map of
the whole text at the start state is the count. A map is made from a run from the start state; another entry state runs only
until it meets that run in one state at one place, which then holds for the rest of the chunk, or else to the end. Words are
entered as from the start state, since no token holds the end of one and the start of the next; their transitions are kept.

One pass, no shuffle. Texts are used whole. The transducer's tables are bounded, within a text too.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; an empty table gives an empty
one; an input column named as an added one is replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from tidemark.llm.common import map_text, table
from tidemark.llm.prefix_bpe import START, CountingTransducer, State

#: Code points of a chunk, and places at its head where runs from two entry states are compared.
CHUNK, HEAD = 4096, 64
#: Words whose transitions are kept.
WORDS = 300_000
LIMIT = 4096
MARK = "▁"
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"


class Words(dict):
    """Change of the count over a word that is entered from the start state: a transition over all its symbols at once."""

    def __init__(self, auto: CountingTransducer):
        super().__init__()
        self.auto = auto

    def __missing__(self, word: str) -> int:
        n = self.auto.run(word, self.auto.state(START))[1]
        if len(word) <= 64:
            if len(self) >= WORDS:
                self.clear()
            self[word] = n
        return n


class ChunkMap(dict):
    """Entry state: (exit state, tokens), of one chunk. States are told by their paths, which outlive the transducer's tables."""

    def __init__(self, words: Words, cut, text: str):
        super().__init__()
        self.words, self.auto, self.cut, self.text, self.head = words, words.auto, cut, text, []
        s, n = self.auto.state(START), 0
        for c in text[:HEAD]:
            s, change = s[c]
            n += change
            self.head.append((s.paths, n))
        exit_, rest = self.to_end(s)
        self[START] = (exit_, n + rest)

    def to_end(self, s: State) -> tuple[tuple, int]:
        """From state s behind the head: symbol by symbol to the first word start, word by word, and through the last word."""
        parts = self.cut(self.text, HEAD)
        if not parts:
            return s.paths, 0
        s, n = self.auto.run(parts[0], s)
        if len(parts) > 1:
            n += sum(map(self.words.__getitem__, parts[1:-1]))
            s, rest = self.auto.run(parts[-1], self.auto.state(START))
            n += rest
        return s.paths, n

    def __missing__(self, entry: tuple) -> tuple[tuple, int]:
        s, n = self.auto.state(entry), 0
        for c, (paths, m) in zip(self.text, self.head, strict=False):
            s, change = s[c]
            n += change
            if s.paths == paths:
                exit_, all_ = self[START]
                self[entry] = (exit_, n + all_ - m)
                return self[entry]
        exit_, rest = self.to_end(s)
        self[entry] = (exit_, n + rest)
        return self[entry]


class Composed(dict):
    """The map of two neighbouring stretches, from their maps."""

    def __init__(self, first: dict, second: dict):
        super().__init__()
        self.first, self.second = first, second

    def __missing__(self, entry: tuple) -> tuple[tuple, int]:
        middle, n = self.first[entry]
        exit_, m = self.second[middle]
        self[entry] = (exit_, n + m)
        return self[entry]


class PieceCounter:
    """Transducer of a sentencepiece BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = (i, -model.get_score(i))
        spare = model.get_piece_size()
        bare = sorted({c for p in pieces for c in p} - pieces.keys())  # characters only known inside pieces
        tokens = {i: p for p, (i, _) in pieces.items()} | {spare + n: c for n, c in enumerate(bare)}
        weights = {i: 1 for i, _ in pieces.values()} | {spare + n: len(c.encode()) for n, c in enumerate(bare)}
        rank = {p: r for p, (_, r) in pieces.items()}
        self.auto = CountingTransducer(tokens, weights, lambda a, b: rank.get(a + b))
        self.words = Words(self.auto)
        # parts of a text between places where no token holds both neighbours, so that each is entered as from the start
        feed = "" if any("\n" in pair for pair in self.auto.adjacent) else "\n"
        stops = "".join(re.escape(c) for c in ".,;:!?)" if not any(pair[1] == c and re.match(LETTER, pair[0]) for pair in self.auto.adjacent))
        before_stop = f"{MARK}*{LETTER}+(?=[{stops}])|" if stops else ""
        starts = all(pair[1] != MARK or pair[0] == MARK for pair in self.auto.adjacent)
        self.cut = re.compile(before_stop + f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+" + ("|\n" if feed else "")).findall if starts else re.compile("(?s).+").findall

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = (MARK + text).replace(" ", MARK)
        maps: list[dict] = [ChunkMap(self.words, self.cut, text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # one level of the scan: neighbours are composed
            maps = [Composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0][START][1]


@lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(df: DataFrame, model: str, limit: int = LIMIT, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""

    def make():
        c = counter(model)

        def run(texts: list) -> dict:
            n = [c.count(x) for x in texts]
            size = [0 if x is None else len(x) if x.isascii() else len(x.encode("utf-8")) for x in texts]
            return {"n_bytes": size, "n_tokens": n, "over_limit": [x > limit for x in n]}

        return run

    return map_text(df, make, "n_bytes long, n_tokens long, over_limit boolean", text_col, keep_text)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every whole document by the piece model."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)

"""Operator 8: secrets, with a random forest against false positives.

Method: wide patterns find candidates: every value that is assigned to a secret's name, whatever its length and characters;
passwords in addresses; quoted strings of 8 or more without white space; and runs of 12 or more key characters and symbols, with
what lies between their symbols, dots and slashes, so that a key in a path is met alone and a key with dots as a whole (findings
may overlap). Outside names and addresses a candidate has a digit or changes from lower to upper case; letters of one case must
be 12 or more in quotes or after an assignment, others are words. The forest's features are: length; mean log-likelihood of the
character transitions under a table made from the words of the corpus; shares of digits, upper-case and hexadecimal letters and
other symbols; number of character kinds; entropy; share covered by dictionary words; whether the path (a column such as a source
or a file name) looks like a test or sample; and the neighbouring words and the marks that touch the candidate, hashed. A random
forest trained on labelled findings gives the score; findings below the cutoff are dropped as false positives.

Labelled findings: rows (the finding, its context on both sides, its path and a label). Where no such table is given, findings
of a fold of the corpus are labelled by what the forest is not shown: issuers' prefixes with the right length, the shape of
addresses and hooks, the whole pattern of a named assignment, placeholders, the check digit and other fixed formats of numbers,
and in how many documents the string is found (a key is not in many). These marks are names and prefixes for the most part, so
keys that no rule knows are made: in texts of the same fold, between words, generated keys of usual shapes and, as many, strings
spelled from the text's own words with numbers and signs. Their contexts are alike, so only the string tells them apart.

Bounds: the dictionary has at most DICTIONARY_WORDS words, those in the largest number of documents, each in a share of at least
DICTIONARY_SHARE of all; the transition table has 40 x 40 cells; the training sample is about TRAIN_ROWS findings by a hash of
their text and place, besides PLANT_TEXTS texts by hash for the made ones; they go to the driver or are broadcast. Words, transitions and holders are counted over all documents.

Defined results: null and empty texts have no findings; repeated rows give repeated findings; a null path counts as empty; with
labels of one kind only (no text to learn from, or a reviewed table) every finding gets that label's rate; an empty table gives an empty one; very long texts are searched as
a whole. Only findings come back, with their place in the whole text; no other column, so that none can clash.
"""

from __future__ import annotations

import base64
import bisect
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, give_back, sized, slices, staged, table, unstaged

DICTIONARY_WORDS, DICTIONARY_SHARE, TRAIN_ROWS = 20_000, 4e-4, 20_000
#: About so many texts, by a hash of id and text, that keys and other strings are made in, and how many of either in each.
PLANT_TEXTS, PLANTS = 1_500, 3
#: Documents that a string must be found in to be taken as none, in the labels by rule.
MANY = 5
TREES, DEPTH, CUTOFF = 24, 8, 0.5
LEAST = 12

#: Names of secrets before an assignment, and prefixes that issuers give to keys.
NAMES = "api_key|apikey|auth|key|passphrase|passwd|password|pwd|secret|token"
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "SG.")
#: Names that prose has before a colon as well.
COMMON_NAMES = ("auth", "key", "token")

SYMBOLS = "~!@#$%^&*"
NAMED = rf"({NAMES})(?:_?\d+|_\w+)?\b[\"'`]?\s*"
run = re.compile(rf"(?<![\w+/.{SYMBOLS}-])[\w+/.{SYMBOLS}-]{{{LEAST},}}={{0,2}}", re.ASCII)
parts = (re.compile(rf"[\w+/-]{{{LEAST},}}={{0,2}}", re.ASCII), re.compile(rf"[\w+-]{{{LEAST},}}={{0,2}}", re.ASCII))
quoted = re.compile(r"([\"'`])([^\s\"'`]{8,})\1")
name = re.compile(rf"(?i){NAMED}(?:[:=]{{1,2}}>?|is\b)\s*", re.ASCII)
value = re.compile(r"([\"'`])((?:\\.|(?!\1)[^\n\\])+)\1|[\"'`<]?((?:(?![,;&]\s*\w+\s*[:=]|[,;.)\]}]+(?:\s|$))[^\s\"'`<>])+)")
password = re.compile(r"://[^\s/:@\"'<>]*:([^\s/\"'<>]+)@")
user = re.compile(r"://[^\s/:@\"'<>]*:$")
hook = re.compile(r"/(?:services/T\w{6,}/B\w{6,}|api/webhooks/\d+)/[\w-]{16,}$", re.ASCII)
mixed = re.compile(r"\d|[a-z][A-Z]", re.ASCII)
before = re.compile(rf"(?i){NAMED}(?:[:=]{{1,2}}>?|is\b)?\s*[\"'`]?$", re.ASCII)
assigned = re.compile(r"[:=]>?\s*[\"'`]?$")
placeholder = re.compile(r"(?i)[$%]?[{(\[].*|\$\w+|(.)\1+|null|none|nil|true|false|undefined|\w*(changeme|example|your_)\w*|[\w.]+[(\[].*[)\]]")
address = re.compile(r"[\w.+-]+@[\w-]+(\.[\w-]+)+")
word = re.compile(r"[^\W\d_]+")
sample_path = re.compile(r"(?i)test|example|sample|mock|fixture")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789_-+ "
SLOTS = 96


def kinds(c: str) -> int:
    at = ALPHABET.find(c.lower())
    return at if at >= 0 else len(ALPHABET) - 1


def word_counts(df: DataFrame) -> DataFrame:
    """Documents for each lower-case word of 3 letters or more, over all rows; df: text."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).to_pylist():
                    seen.update({w for w in word.findall((text or "").lower()) if 3 <= len(w) <= 30})
                if len(seen) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])
                    seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])
        give_back()

    return df.mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def transitions(words: list) -> np.ndarray:
    """Log-probabilities of the next character, from words weighted by their documents."""
    n = np.ones((len(ALPHABET), len(ALPHABET)))
    for w, k in words:
        codes = [kinds(c) for c in f" {w} "]
        np.add.at(n, (codes[:-1], codes[1:]), math.log1p(k))
    return np.log(n / n.sum(axis=1, keepdims=True))


def places(text: str) -> list[tuple[int, int, int]]:
    """(start, end, start of its context) of each candidate, in order."""
    found, whole = {}, []
    low = text.lower()
    if any(n in low for n in NAMES.split("|")):
        for m in name.finditer(text):
            v = value.match(text, m.end())
            if v:
                start, end = v.span(2 if v.group(2) else 3)
                found[start, end] = min(m.start(), max(0, start - 48))
    for m in password.finditer(text) if "://" in low else ():
        found[m.span(1)] = min(m.start(), max(0, m.start(1) - 48))
    for start, end in found:
        if not re.search(r"\s", text[start:end]):
            whole.append((start, end))
    open_ = []
    for m in quoted.finditer(text):
        if mixed.search(m.group(2)) or len(m.group(2)) >= LEAST:
            open_.append(m.span(2))
    for m in run.finditer(text):
        start = m.start()
        end = start + len(m.group().rstrip("."))
        sure = assigned.search(text, max(0, start - 8), start) or text[start - 1 : start] in ("'", '"', "`") and text[start - 1 : start] == text[end : end + 1]
        if not sure and not mixed.search(text, start, end):
            continue
        if end - start >= LEAST:
            open_.append((start, end))
        for part in parts[text.startswith("//", start) :]:
            open_ += [x.span() for x in part.finditer(text, start, end) if sure or mixed.search(x.group())]
    whole.sort()
    starts = [x for x, _ in whole]
    reach = list(itertools.accumulate((x for _, x in whole), max))
    for start, end in open_:
        k = bisect.bisect_right(starts, start)
        if not k or reach[k - 1] < end:  # else it is a part of a value that is a candidate
            found.setdefault((start, end), max(0, start - 48))
    return sorted((*k, v) for k, v in found.items())


class Features:
    """Feature vector of a candidate in its context."""

    def __init__(self, words: list):
        self.table = transitions(words)
        self.words = {w for w, _ in words if len(w) >= 4}

    def covered(self, text: str) -> float:
        """Share of the characters in dictionary words, the longest first from the left."""
        low, at, hit = text.lower(), 0, 0
        while at < len(low):
            for size in range(min(14, len(low) - at), 3, -1):
                if low[at : at + size] in self.words:
                    hit += size
                    at += size
                    break
            else:
                at += 1
        return hit / max(len(low), 1)

    def vector(self, text: str, left: str, right: str, path: str) -> list[float]:
        codes = [kinds(c) for c in text]
        n, counts = len(text), Counter(text)
        out = [
            float(n),
            float(self.table[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0,
            sum(c.isdigit() for c in text) / n,
            sum(c.isupper() for c in text) / n,
            sum(c in "0123456789abcdefABCDEF" for c in text) / n,
            float(sum(any(f(c) for c in text) for f in (str.isdigit, str.isupper, str.islower, lambda c: not c.isalnum()))),
            -sum(k / n * math.log2(k / n) for k in counts.values()),
            self.covered(text),
            float(bool(sample_path.search(path))),
            sum(not c.isalnum() and c not in "_+/=-" for c in text) / n,
        ]
        slots = [0.0] * SLOTS
        near = word.findall(left.lower())[-2:] + word.findall(right.lower())[:1]
        for mark in (*near, "<" + left.rstrip(" \"'`")[-1:], "<" + left[-1:], ">" + right[:1]):
            slots[xxhash.xxh3_64_intdigest(mark) % SLOTS] = 1.0
        return out + slots


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others, as on payment cards."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def ruled(text: str, left: str, right: str = "") -> int | None:
    """Label of a finding by rule; None: the rules do not know. A card number is personal data, not a key."""
    named = before.search(left)
    if named and assigned.search(left):
        if placeholder.fullmatch(text):
            return 0
        prose = named.group(1).lower() in COMMON_NAMES and re.fullmatch(r"[^\W\d_]+|\d{1,11}|.*\s.*", text)
        return None if prose else 1
    if hook.search(left + text) or right[:1] == "@" and user.search(left):
        return 1
    if text.startswith(PREFIXES) and len(text) >= 20:
        return 1
    text = text.strip(SYMBOLS + ".-")
    if 13 <= len(text) <= 19 and text.isdigit() and luhn(text):
        return 0
    if text.isdigit() or re.fullmatch(r"[\d.+-]*", text) or address.fullmatch(text):
        return 0
    if re.fullmatch(r"[A-Za-z]+[\d_-]{1,4}", text) or re.fullmatch(r"(?i)v?\d+([._-]\d+)+", text):
        return 0
    return None


def candidates(df: DataFrame, features: Features, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """One row per candidate: id, start, end (code points), text, x (features), rule (label by rule or null)."""
    shared = df.sparkSession.sparkContext.broadcast(features)
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), path.alias("p")).filter(F.col("t").isNotNull())

    def run(batches):
        f = shared.value
        for batch in batches:
            for part in slices(batch, 1, 512):
                owner, starts, ends, texts, xs, rules = [], [], [], [], [], []
                for k, (text, where) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    for start, end, since in places(text):
                        secret, left, right = text[start:end], text[since:start], text[end : end + 32]
                        owner.append(k)
                        starts.append(start)
                        ends.append(end)
                        texts.append(secret)
                        xs.append(f.vector(secret, left, right, where))
                        rules.append(ruled(secret, left, right))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(texts, pa.string()), pa.array(xs, pa.list_(pa.float64())), pa.array(rules, pa.int32())],
                    names=["id", "start", "end", "secret", "x", "rule"],
                )
        give_back()

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, start int, end int, secret string, x array<double>, rule int")


def made_key(rnd: random.Random) -> str:
    """A key of a usual shape."""
    hexadecimal, letters = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    of = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    shape = rnd.randrange(6)
    if shape == 0:
        return of(hexadecimal, rnd.choice([32, 40, 40, 64]))
    if shape == 1:
        return base64.b64encode(rnd.randbytes(rnd.choice([15, 20, 24, 30, 32, 33]))).decode()
    if shape == 2:
        return of(letters + "-_", rnd.choice([22, 32, 43]))
    if shape == 3:
        return "-".join(of(hexadecimal, n) for n in (8, 4, 4, 4, 12))
    return of(letters, rnd.choice([16, 20, 24, 24, 32, 40])) if shape == 4 else of(letters[26:], rnd.choice([24, 32, 40]))


def made_string(rnd: random.Random, words: list[str]) -> str:
    """What looks like a key and is none: words with numbers and signs."""
    w = [rnd.choice(words) for _ in range(3)]
    number = str(rnd.randrange(10 ** rnd.randrange(1, 6)))
    shapes = [
        f"{w[0]}{w[1].title()}{w[2].title()}{number}", f"{w[0]}-{w[1]}-{number}", f"{w[0]}_{w[1]}_{w[2]}", f"/{w[0]}/{w[1]}{number}.html", f"v{number}.{len(w[0])}.{len(w[1])}-rc{len(w[2])}",
        f"20{rnd.randrange(10, 30)}-0{rnd.randrange(1, 10)}-1{rnd.randrange(10)}T0{rnd.randrange(10)}:{rnd.randrange(10, 60)}", f"{w[0]}@{w[1]}.{w[2][:3]}", f"{w[0].upper()}-{number}-{w[1].upper()}", "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(12, 20))), f"{w[0]}{w[1]}{w[2]}{number}",
    ]
    out = rnd.choice(shapes)
    return out if len(out) >= LEAST else out + "-" + "-".join(w)


def planted(df: DataFrame, features: Features) -> DataFrame:
    """(features, label) of keys and other strings made between words of some texts; df: id, t, p (path)."""
    shared = df.sparkSession.sparkContext.broadcast(features)

    def run(batches):
        f = shared.value
        for batch in batches:
            for part in slices(batch, 0):
                xs, labels = [], []
                for text, where in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    rnd = random.Random(xxhash.xxh3_64_intdigest(text))
                    gaps, words = [m.end() for m in re.finditer(r"\S+", text)], [w.lower() for w in word.findall(text) if len(w) > 2]
                    if not gaps or not words:
                        continue
                    for label in [0, 1] * PLANTS:
                        at, made = rnd.choice(gaps), made_key(rnd) if label else made_string(rnd, words)
                        mark = rnd.choice([" ", " ", " ", ' "', " (", ": ", "="])
                        xs.append(f.vector(made, text[max(0, at - 48) : at] + mark, rnd.choice([" ", mark[-1:], ",", "."]) + text[at : at + 31], where))
                        labels.append(float(label))
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["x", "label"])
        give_back()

    keep = max(1, math.ceil(df.count() / PLANT_TEXTS))
    some = df.filter(F.col("t").isNotNull() & (F.pmod(F.xxhash64("id", "t"), F.lit(keep)) == 0))
    return some.select("t", "p").mapInArrow(run, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")


def rule_labels(found: DataFrame, id_col: str, fold_of: Column | None) -> DataFrame:
    """features and label of about TRAIN_ROWS candidates of a fold that the rules know; found: rows of candidates."""
    holders = found.groupBy(F.xxhash64("secret").alias("s")).agg(F.approx_count_distinct("id").alias("n")).filter(F.col("n") >= MANY)
    common = staged(holders.select("s"), "common-strings")
    known = found.withColumn("s", F.xxhash64("secret")).join(sized(common.withColumn("many", F.lit(True))), "s", "left")
    # what many documents hold is none, unless a rule says that it is; what the rules don't know is not learnt from
    known = known.withColumn("label", F.coalesce("rule", F.when(F.col("many"), 0))).filter("label is not null")
    if fold_of is not None:
        known = known.withColumnRenamed("id", id_col).filter(fold_of)
    keep = max(1, math.ceil(known.count() / TRAIN_ROWS))
    known = known.filter(F.pmod(F.xxhash64("start", "secret"), F.lit(keep)) == 0)
    return known.select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))


def secrets(df: DataFrame, labelled: DataFrame | None = None, train_fold=None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", cutoff: float = CUTOFF) -> DataFrame:
    """Findings of df: id_col, start, end, secret, score, kept (score >= cutoff).

    labelled: (secret, left, right, path, label) rows of reviewed findings; without it the rules label those where train_fold
    (a condition on id_col) holds.
    """
    path_col = path_col if path_col in df.columns else None
    words = word_counts(df.select(F.col(text_col).alias("text"))).filter(F.col("n") >= max(5, DICTIONARY_SHARE * df.count()))
    rows = words.orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS).collect()
    features = Features([(r["w"], r["n"]) for r in rows])
    found = staged(candidates(df, features, id_col, text_col, path_col), "candidates")
    if labelled is None:
        path = F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")) if path_col else F.lit("")
        texts = (df if train_fold is None else df.filter(train_fold)).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), path.alias("p"))
        train = rule_labels(found, id_col, train_fold).unionByName(planted(texts, features))
    else:
        reviewed = labelled.orderBy(F.xxhash64("secret", "left", "right", "path"), "label").limit(TRAIN_ROWS).collect()  # made by people, bounded all the same
        spark = df.sparkSession
        made = [(features.vector(r["secret"], r["left"] or "", r["right"] or "", r["path"] or ""), float(r["label"])) for r in reviewed if r["secret"]]
        train = spark.createDataFrame(made, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    train = staged(train, "secret-train")  # read by the forest, deleted below
    n, positive = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    vectors = found.withColumn("features", array_to_vector("x"))
    if 0 < positive < n:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt").fit(train)
        scored = forest.transform(vectors).withColumn("score", F.get(vector_to_array("probability"), 1))
    else:
        scored = vectors.withColumn("score", F.lit(positive / n if n else 0.0))
    unstaged(train)
    return scored.select(F.col("id").alias(id_col), "start", "end", "secret", "score", (F.col("score") >= cutoff).alias("kept"))


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Findings in every whole document and the forest's verdict; the forest learns from where crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = secrets(docs, train_fold=fold("doc_id", 5) != 0)
    return out.select("doc_id", "start", "end", F.sha2("secret", 256).alias("secret_sha256"), F.round("score", 6).alias("score"), "kept")


def secret_planted_recall(spark, sf_dir: str) -> DataFrame:
    """Of one bare key put between the words of every document that the forest did not learn from, how many it finds and keeps,
    by shape; and what else it keeps there. Names, prefixes and signs are in none of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    digest = F.sha2(F.concat(F.lit("planted:"), F.col("doc_id").cast("string")), 512)
    raw = F.base64(F.unhex(F.substring(digest, 1, 96)))
    shape = F.pmod(F.xxhash64("doc_id"), F.lit(4)).cast("int")
    key = F.when(shape == 0, F.substring(digest, 1, 40)).when(shape == 1, F.substring(F.regexp_replace(raw, "[+/=]", ""), 1, 24)).when(shape == 2, F.substring(raw, 1, 40)).otherwise(F.substring(digest, 1, 64))
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    middle = F.floor(F.size(words) / 2).cast("int")
    with_key = F.concat_ws(" ", F.slice(words, 1, middle), F.array("key"), F.slice(words, middle + 1, F.size(words)))
    held = docs.filter(fold("doc_id", 5) == 0).withColumns({"key": key, "shape": F.get(F.array(*[F.lit(x) for x in ("hex40", "letters24", "base64_40", "hex64")]), shape)})
    rows = docs.filter(fold("doc_id", 5) != 0).unionByName(held.withColumn("text", with_key).select("doc_id", "text", "source"))
    found = staged(secrets(rows, train_fold=fold("doc_id", 5) != 0).filter(fold("doc_id", 5) == 0), "planted-findings")
    own = found.join(held.select(F.col("doc_id").alias("d"), "key"), (F.col("doc_id") == F.col("d")) & (F.col("secret") == F.col("key")))
    own = own.groupBy("doc_id").agg(F.max("kept").alias("kept"))
    out = held.join(own, "doc_id", "left").groupBy("shape").agg(F.count("*").alias("planted"), F.count("kept").alias("found"), F.count_if("kept").alias("kept"))
    others = found.join(held.select(F.col("doc_id").alias("d"), "key"), (F.col("doc_id") == F.col("d")) & F.col("key").contains(F.col("secret")), "left_anti")
    rest = others.agg(F.lit("others").alias("shape"), F.lit(0).cast("long").alias("planted"), F.count("*").alias("found"), F.count_if("kept").alias("kept"))
    return out.unionByName(rest)

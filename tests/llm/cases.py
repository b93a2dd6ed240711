"""One table with what operators must survive: nulls in every column, empty and long texts, repeated rows, clashing extra columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept string, score string"

PROSE = "The quick brown fox jumps over the lazy dog while seven wizards boil their old socks in a pot of tea near the river. "


def rows():
    long = "word%d other thing. "
    texts = [None, "", " \n\t ", "a", "no words? 123 !!!", PROSE, PROSE, PROSE + "One more ending here.", PROSE * 40, "".join(long % i for i in range(4000)), "é" * 3000, "x" * 5000, "Zeile\n" * 30, "<|endoftext|> 日本語 😀 \x00 \x1c"]
    out = [(i, t, "en" if i % 3 else None, "s" if i % 4 else None, len(t) if t else None, "old", "old", "old") for i, t in enumerate(texts)]
    return [*out, out[5], (None, PROSE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

"""Small tables and brute-force versions for the operator tests."""

import random

from pyspark.sql import types as T

WS = " \t\n\x0b\x0c\r"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
# Names that operators use for columns of their own.
CLASHING = ["key", "row_id", "row_hash", "n_words", "words", "text2", "component_id", "n", "count", "kept", "h",
            "_id", "_lines", "gone", "pos", "score", "length", "start", "u", "rank", "group", "a", "b", "rep", "fold"]


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    return df


def odd_documents():
    """Nulls, empty and blank texts, repeated rows, ties, a very long text, text without letters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(4)]
    return [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, prose[0], "en"), (4, prose[0], "en"),
        (5, prose[0], "en"), (6, prose[1] + "\nsame line\n" + prose[1], None), (None, prose[2], "de"),
        (None, None, None), (7, "12 34 %% ## !!", "fr"), (8, "one two", "en"), (9, "É\x00 日本語 \U0001F600 ﬁ", "en"),
        (10, "\n".join([prose[3]] * 400) + "tail", "en"), (11, "w" * 300_000, "en"), (12, "A" + prose[0][1:], "en"),
    ]


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}

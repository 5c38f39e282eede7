"""Quality rules by distribution divergence, in DataFrame functions only.

A document is compared with references of its own language, made from *all*
documents of that language: the histogram of character classes, and the
histogram of the language's most common words (with one class for all other
words). The measure is the Jensen-Shannon distance (base 2, 0 to 1). Short
documents have noisy histograms, so each comparison has a minimum length.

Base rules of the contract come first: too few words, or too many words in
repeated three-word windows.

Defined results: null text counts as empty (no words, base rules fail). Null
language is a language of its own. Repeated rows each get a result. Empty
tables give empty results. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import WS_RUN, stage, text_or_empty

SYMBOLS = "#*$%&|<>"
CLASSES = ("c_upper", "c_letter", "c_digit", "c_symbol", "c_punct", "c_space")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_pct: int = 50
    common_words: int = 32          # words of a language's word reference
    min_chars: int = 300            # guard of the character histogram
    min_words_js: int = 100         # guard of the word histogram
    max_char_distance: float = 0.25
    max_word_distance: float = 0.42
    broadcast_rows: int = 20_000    # references beyond this many rows are joined by shuffle


def _pick(arr: str, index: Column) -> Column:
    return F.get(F.col(arr), index)


def identity() -> list[Column]:
    """Non-null join key of a row. Rows equal in id, text and language share it, and their results."""
    return [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("row_id"),
            F.xxhash64("text", "lang").alias("row_hash")]


def base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, key, lang, base counts and character classes: one narrow row per document, no shuffle."""
    d = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                    text_or_empty().alias("text"))
    d = d.withColumns({
        "words": F.array_remove(F.split("text", WS_RUN), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        # What is neither letter nor white space; the other classes are counted in this short rest.
        "marks": F.regexp_replace("text", r"[\p{L}\x20\x09-\x0D]+", ""),
        "upper": F.regexp_replace("text", r"\P{Lu}+", ""),
    })
    d = d.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    d = d.withColumn("win", F.transform(
        F.slice("h", F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, _pick("h", i + 1), _pick("h", i + 2))))
    # Only documents that repeat a window go on; most have no more than a few such windows.
    d = d.withColumn("sorted", F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array("win")))
    d = d.withColumn("twice", F.array_distinct(F.filter("sorted", lambda x, i: x == _pick("sorted", i - 1))))
    few = F.size("twice") <= 16
    d = d.withColumn("ranked", F.when(~few, F.array_sort(F.transform(
        "win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    d = d.withColumn("starts", F.when(few, F.filter(
        F.transform("win", lambda x, i: F.when(F.array_contains("twice", x), i)), lambda i: i.isNotNull()),
    ).otherwise(F.array_sort(F.transform(
        F.filter("ranked", lambda e, i: F.coalesce(e["x"] == _pick("ranked", i - 1)["x"], F.lit(False))
                 | F.coalesce(e["x"] == _pick("ranked", i + 1)["x"], F.lit(False))),
        lambda e: e["i"]))))
    covered = F.aggregate(
        F.transform("starts", lambda p, i: F.least(F.lit(3), F.coalesce(_pick("starts", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x)
    word_chars = F.length(F.array_join("words", ""))
    upper, marks = F.length("upper"), F.length("marks")
    digits = marks - F.length(F.regexp_replace("marks", r"\p{N}+", ""))
    symbols = marks - F.length(F.translate("marks", SYMBOLS, ""))
    chars = F.length("text")
    return d.select(
        "doc_id", *identity(), "lang",
        n.cast("long").alias("n_words"),
        word_chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        upper.cast("long").alias("c_upper"),
        (word_chars - marks - upper).cast("long").alias("c_letter"),
        digits.cast("long").alias("c_digit"),
        symbols.cast("long").alias("c_symbol"),
        (marks - digits - symbols).cast("long").alias("c_punct"),
        (chars - word_chars).cast("long").alias("c_space"),
    )


def doc_words(docs: DataFrame) -> DataFrame:
    """One row per word occurrence: (row_id, row_hash, lang, w), w a hash of language and lower-case word."""
    d = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                    text_or_empty().alias("text"))
    d = d.select(*identity(), "lang", F.split(F.lower("text"), WS_RUN).alias("ws"))
    d = d.select("row_id", "row_hash", "lang", F.explode("ws").alias("w")).filter("w <> ''")
    return d.select("row_id", "row_hash", "lang", F.xxhash64("lang", "w").alias("w"))


def common_words(words: DataFrame, k: int) -> DataFrame:
    """(lang, w, q): the words of each language's k highest counts (ties at the last all count), and
    their share of all its words."""
    counts = stage(words.groupBy("lang", "w").agg(F.count("*").alias("c")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("c").alias("total"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("c"))
    top = counts.withColumn("r", F.rank().over(by_count)).filter(F.col("r") <= k)
    return top.join(totals, "lang").select("lang", "w", (F.col("c") / F.col("total")).alias("q"))


def half_kl(p: Column, q: Column) -> Column:
    """The term of one class in the Jensen-Shannon divergence, zero shares included."""
    mean = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x / 2 * F.log2(x / mean)).otherwise(0.0)
    return part(p) + part(q)


def distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per document: base counts, base_failed, char_distance, word_distance (null below the guards), kept."""
    stats = stage(base_stats(docs), "quality-stats")

    # Character classes: sums over every document of the language.
    total = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    sums = stats.groupBy("lang").agg(*[F.sum(c).alias("r_" + c) for c in CLASSES])
    whole = sum((F.col("r_" + c) for c in CLASSES[1:]), F.col("r_" + CLASSES[0]))
    char_ref = stage(sums.select("lang", *[(F.col("r_" + c) / whole).alias("r_" + c) for c in CLASSES]),
                     "char-ref")

    word_ref = stage(common_words(doc_words(docs), rules.common_words), "word-ref")
    bounded = word_ref.count() <= rules.broadcast_rows
    small = F.broadcast if bounded else (lambda x: x)

    # Identical rows add up in the counts of their identity; dividing by their words undoes that.
    sizes = stats.groupBy("row_id", "row_hash").agg(F.sum("n_words").alias("n"))
    hits = (doc_words(docs).join(small(word_ref.drop("lang")), "w")
            .groupBy("row_id", "row_hash", "w").agg(F.count("*").alias("c"), F.first("q").alias("q"))
            .join(sizes, ["row_id", "row_hash"]))
    p = F.col("c") / F.col("n")
    hits = hits.groupBy("row_id", "row_hash").agg(
        F.sum(half_kl(p, F.col("q"))).alias("d_hit"), F.sum(p).alias("p_hit"), F.sum("q").alias("q_hit"))
    q_all = word_ref.groupBy("lang").agg(F.sum("q").alias("q_all"))

    d = stats.join(small(char_ref), "lang").join(small(q_all), "lang", "left")
    d = d.withColumn("chars", total)
    d_char = sum((half_kl(F.col(c) / F.col("chars"), F.col("r_" + c)) for c in CLASSES[1:]),
                 half_kl(F.col(CLASSES[0]) / F.col("chars"), F.col("r_" + CLASSES[0])))
    d = d.withColumn("char_distance", F.when(F.col("chars") >= rules.min_chars, distance(d_char)))
    d = d.join(hits, ["row_id", "row_hash"], "left")
    p_hit, q_hit = F.coalesce("p_hit", F.lit(0.0)), F.coalesce("q_hit", F.lit(0.0))
    q_all_c = F.coalesce("q_all", F.lit(0.0))
    d_word = (F.coalesce("d_hit", F.lit(0.0)) + (q_all_c - q_hit) / 2
              + half_kl(F.greatest(1 - p_hit, F.lit(0.0)), F.greatest(1 - q_all_c, F.lit(0.0))))
    word_distance = F.when(F.col("n_words") >= rules.min_words_js, distance(d_word))
    base_failed = ((F.col("n_words") < rules.min_words)
                   | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")))
    out = d.select(
        "doc_id", "row_id", "row_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "char_distance", word_distance.alias("word_distance"))
    far = (F.coalesce(F.col("char_distance") > rules.max_char_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def reject_low_quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs``, with all its columns, that :func:`quality` keeps."""
    bad = quality(docs, rules).filter("not kept").select("row_id", "row_hash").distinct()
    row_id = F.coalesce(docs["doc_id"], F.lit(-1))
    row_hash = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")),
                          F.coalesce(docs["lang"].cast("string"), F.lit("")))
    return docs.join(bad, (row_id == bad["row_id"]) & (row_hash == bad["row_hash"]), "left_anti")

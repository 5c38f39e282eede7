"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the characters of words (order 5), one
of toxic and one of ordinary labelled documents. Each has its own counts at the
highest order only; below it both back off to the same continuation counts,
shared by the classes, so that a rare expression leans on what both classes say
about its ending, and the log-likelihood ratio stems from what the classes do
differently. A document's evidence is the ratio per word: over the whole
document, and over its most toxic window of ``window`` words. A logistic curve,
fitted on a fold that its models had not seen, turns both into a score.

Counting runs in Spark over every labelled row: words first, then the n-grams of
distinct words. All n-grams count. Up to ``max_grams`` of them make a model that is
sent to the workers; more stay in a table, where the same ratios are computed, and
the distinct words of the texts are joined to it and scored once.

Defined results: null or empty text scores as a text without evidence, like any
text without letters. Rows without an id are held out. A document with several
labels counts as toxic if one of them is 1; null labels are ignored. Without any
toxic or ordinary label, every score is 0. Repeated rows get equal results.
Only doc_id and text are read from documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import SLICE, give_back, let_go, small_batches
from tidemark.llm.shared import fold_of, held_out, n_partitions, ship, stage

BITS = 12                      # a character code; larger code points are folded
TOP = (1 << BITS) - 1
ORDER = 5
CALIBRATION_FOLD = 3
CHUNK = 20_000                 # words scored at once
COUNTS = ("toxic", "ordinary", "early_toxic", "early_ordinary")
NOT_LETTERS = regex.compile(r"\P{L}+")


@dataclass(frozen=True)
class ToxicityParams:
    discount: float = 0.75
    max_grams: int = 2_000_000     # more n-grams than this are joined by shuffle
    lowest: float = -0.1             # least ratio of a word
    window: int = 40
    calibration_rows: int = 20_000   # of the fold that calibrates, at most
    broadcast_labels: int = 1_000_000  # more labels than this are joined by shuffle
    threshold: float = 0.3
    cache_words: int = 150_000


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, word number) of every character of every word and its end; grams as packed codes."""
    c = np.frombuffer((" ".join(words) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    end = c == 32
    code = np.where(end, 1, c % (TOP - 1) + 2)
    word = np.cumsum(end) - end
    starts = np.concatenate([[0], np.flatnonzero(end)[:-1] + 1])
    inside = np.arange(len(c)) - starts[word]
    gram = code.copy()
    for k in range(1, ORDER):
        back = np.zeros_like(code)
        back[k:] = code[:-k]
        gram |= np.where(inside >= k, back, 0) << (BITS * k)
    return gram, word


def shared_probability(grams: np.ndarray, discount: float) -> np.ndarray:
    """Kneser-Ney probability of each gram's last character after the rest but the first, from the
    numbers of distinct left extensions, interpolated down to the uniform distribution."""
    levels = []
    keys = grams
    for n in range(ORDER - 1, 0, -1):
        keys, inverse, extensions = np.unique(keys & ((1 << (BITS * n)) - 1), return_inverse=True, return_counts=True)
        levels.append((keys, inverse, extensions))
    p = np.full(1, 1.0 / max(len(levels[-1][0]), 1))
    into = np.zeros(len(levels[-1][0]), np.int64)
    for keys, inverse, extensions in reversed(levels):
        _, at = np.unique(keys >> BITS, return_inverse=True)
        total, kinds = np.bincount(at, extensions), np.bincount(at)
        p = (np.maximum(extensions - discount, 0) + discount * kinds[at] * p[into]) / total[at]
        into = inverse
    return p[into]


class KneserNeyRatio:
    """Log-likelihood ratio (toxic over ordinary) of words; arrays only."""

    def __init__(self, grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, params: ToxicityParams):
        self.params = params
        order = np.argsort(grams)
        self.grams, counts = grams[order], (toxic[order], ordinary[order])
        low = shared_probability(self.grams, params.discount)
        self.history, at = np.unique(self.grams >> BITS, return_inverse=True)


        def discounted(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Discounted relative frequencies, and by history what the discounts leave to the back-off."""
            total = np.bincount(at, n, minlength=len(self.history))
            kinds = np.bincount(at, n > 0, minlength=len(self.history))
            weight = np.where(total > 0, params.discount * kinds / np.maximum(total, 1), 1.0)
            return np.maximum(n - params.discount, 0) / np.maximum(total, 1)[at], weight
        ratio, rest = np.zeros(len(grams)), np.zeros(len(self.history))
        for sign, n in zip((1, -1), counts):
            own, weight = discounted(n)
            ratio += sign * np.log(own + weight[at] * low)
            rest += sign * np.log(weight)
        self.ratio, self.rest = ratio.astype(np.float32), rest.astype(np.float32)
        self.curve = (0.0, 0.0, -30.0)

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], otherwise)

    def words(self, words: list[str]) -> np.ndarray:
        gram, word = word_grams(words)
        rest = self._find(self.history, self.rest, gram >> BITS, np.zeros(len(gram), np.float32))
        found = np.bincount(word, self._find(self.grams, self.ratio, gram, rest), minlength=len(words))
        # A word can speak for a toxic text, hardly against: most words of such texts are ordinary, and
        # a language with few toxic examples would weigh on every word.
        return np.maximum(found, self.params.lowest)

    def evidence(self, texts: list[str | None], cache: dict[str, float]) -> np.ndarray:
        """(ratio per word of the text, of its most toxic window) by text."""
        split = [t.lower().split() if t else [] for t in texts]
        if len(self.grams):
            if len(cache) > self.params.cache_words:
                cache.clear()
            new = list(set().union(*split).difference(cache))
            bare = [NOT_LETTERS.sub("", w) for w in new]
            for at in range(0, len(new), CHUNK):
                found = self.words([b or "." for b in bare[at:at + CHUNK]])
                cache.update(zip(new[at:at + CHUNK], np.where(
                    [bool(b) for b in bare[at:at + CHUNK]], found, 0.0).tolist()))
        out = np.zeros((len(texts), 2))
        for i, tokens in enumerate(split):
            if not tokens or not len(self.grams):
                continue
            total = np.concatenate([[0.0], np.cumsum(np.fromiter(map(cache.__getitem__, tokens), float, len(tokens)))])
            w = min(self.params.window, len(tokens))
            # Windows shorter than the parameter would exaggerate one word.
            out[i] = total[-1] / len(tokens), (total[w:] - total[:-w]).max() / self.params.window
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * evidence[:, 0] + b * evidence[:, 1] + c, -30, 30)))


class RatioTables:
    """The ratios of :class:`KneserNeyRatio` as tables (gram, ratio) and (history, rest)."""

    scores = KneserNeyRatio.scores

    def __init__(self, counts: DataFrame, params: ToxicityParams):
        """``counts``: gram, toxic, ordinary."""
        self.params, self.curve, d = params, (0.0, 0.0, -30.0), params.discount
        levels, keys = [], counts.withColumnRenamed("gram", "key")
        for n in range(ORDER - 1, 0, -1):
            keys = stage(keys.groupBy(_last("key", n).alias("key")).agg(F.count("*").alias("extensions")), "toxic-level")
            levels.append((n, keys))
        low = None
        for n, keys in reversed(levels):
            sums = keys.groupBy(F.shiftright("key", BITS).alias("h")).agg(
                F.sum("extensions").alias("total"), F.count("*").alias("kinds"))
            rows = keys.join(sums, F.shiftright("key", BITS) == F.col("h"))
            if low is None:
                rows = rows.withColumn("p", F.lit(1.0 / keys.count()))
            else:
                rows = rows.join(low.withColumnRenamed("key", "into"), _last("key", n - 1) == F.col("into"))
            p = (F.greatest(F.col("extensions") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("p")) / F.col("total")
            low = stage(rows.select("key", p.alias("p")), "toxic-low")
        classes = ("toxic", "ordinary")
        sums = counts.groupBy(F.shiftright("gram", BITS).alias("history")).agg(
            *[F.sum(c).alias(f"total_{c}") for c in classes], *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in classes])
        weights = {f"weight_{c}": F.when(F.col(f"total_{c}") > 0, d * F.col(f"kinds_{c}") / F.col(f"total_{c}"))
                   .otherwise(1.0) for c in classes}
        sums = stage(sums.withColumns(weights), "toxic-histories")
        self.rest = sums.select("history", (F.log("weight_toxic") - F.log("weight_ordinary")).alias("rest"))
        rows = (counts.join(sums, F.shiftright("gram", BITS) == F.col("history"))
                .join(low, _last("gram", ORDER - 1) == F.col("key")))
        one, two = (F.log(F.greatest(F.col(c) - d, F.lit(0.0)) / F.greatest(F.col(f"total_{c}"), F.lit(1))
                          + F.col(f"weight_{c}") * F.col("p")) for c in classes)
        self.ratios = stage(rows.select("gram", (one - two).alias("ratio")), "toxic-ratios")

    def words(self, tokens: DataFrame) -> DataFrame:
        """(w1, w2, value) of the distinct words with letters, named by two hashes."""
        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bare = [NOT_LETTERS.sub("", w) for w in b["w"].to_pylist()]
                at = np.flatnonzero([bool(w) for w in bare])
                if len(at):
                    gram, word = word_grams([bare[i] for i in at])
                    w1, w2 = (b[c].to_numpy()[at][word] for c in ("w1", "w2"))
                    yield pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), pa.array(gram)], ["w1", "w2", "gram"])
        rows = tokens.select("w1", "w2", "w").dropDuplicates(["w1", "w2"]).mapInArrow(spell, "w1 long, w2 long, gram long")
        rows = (rows.join(self.ratios, "gram", "left")
                .join(self.rest, F.shiftright("gram", BITS) == F.col("history"), "left"))
        value = F.greatest(F.sum(F.coalesce("ratio", "rest", F.lit(0.0))), F.lit(self.params.lowest))
        return rows.groupBy("w1", "w2").agg(value.alias("value"))

    def evidence(self, rows: DataFrame) -> DataFrame:
        """(k1, k2, mean_ratio, peak_ratio, score) of the distinct texts that have words."""
        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k1, k2, text in zip(*(b[c].to_pylist() for c in ("k1", "k2", "text"))):
                    w = text.lower().split()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1] * len(w), pa.int64()), pa.array([k2] * len(w), pa.int64()),
                         pa.array(range(len(w)), pa.int64()), pa.array(w, pa.string())], ["k1", "k2", "pos", "w"])
        texts = rows.select(*text_keys(), "text").filter("text IS NOT NULL").dropDuplicates(["k1", "k2"])
        tokens = texts.mapInArrow(split, "k1 long, k2 long, pos long, w string")
        tokens = tokens.withColumns({"w1": F.xxhash64("w"), "w2": F.xxhash64("w", F.lit("word"))})
        tokens = stage(tokens, "toxic-tokens")
        valued = tokens.drop("w").join(self.words(tokens), ["w1", "w2"], "left").select("k1", "k2", "pos", F.coalesce("value", F.lit(0.0)).alias("value"))
        window, curve = self.params.window, self.curve

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, []

            def found() -> pa.RecordBatch:
                values = np.concatenate(held)
                total = np.concatenate([[0.0], np.cumsum(values)])
                w = min(window, len(values))
                x = np.array([[total[-1] / len(values), (total[w:] - total[:-w]).max() / window]])
                score = 1 / (1 + np.exp(-np.clip(curve[0] * x[:, 0] + curve[1] * x[:, 1] + curve[2], -30, 30)))
                return pa.RecordBatch.from_arrays(
                    [pa.array([key[0]]), pa.array([key[1]]), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(score)],
                    ["k1", "k2", "mean_ratio", "peak_ratio", "score"])
            for b in batches:
                if not b.num_rows:
                    continue
                k1, k2, value = (b[c].to_numpy() for c in ("k1", "k2", "value"))
                starts = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
                for s, e in zip(starts, [*starts[1:], len(k1)]):
                    if key != (k1[s], k2[s]):
                        if held:
                            yield found()
                        key, held = (k1[s], k2[s]), []
                    held.append(value[s:e])
            if held:
                yield found()
        return (valued.repartition(n_partitions(rows.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2", "pos")
                .mapInArrow(judge, "k1 long, k2 long, mean_ratio double, peak_ratio double, score double"))

    def join(self, rows: DataFrame) -> DataFrame:
        """``rows`` as t, with the evidence of their texts as e; texts without words have none."""
        found = stage(self.evidence(rows), "toxic-evidence").alias("e")
        k1, k2 = text_keys("t.text")
        return rows.alias("t").join(found, (k1 == F.col("e.k1")) & (k2 == F.col("e.k2")), "left")


def _last(column: str, n: int) -> Column:
    """The last ``n`` characters of a packed gram."""
    return F.col(column).bitwiseAND(F.lit((1 << (BITS * n)) - 1).cast("long"))


def text_keys(text: str = "text") -> tuple[Column, Column]:
    """Two hashes that name a text."""
    t = F.col(text).cast("string")
    return F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit("text")).alias("k2")


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Ridge-penalised logistic regression by Newton steps."""
    if len(set(y.tolist())) < 2:
        return 1.0, 4.0, -4.0
    scale = x.std(axis=0) + 1e-9
    z = np.column_stack([x / scale, np.ones(len(x))])
    w, penalty = np.zeros(3), np.diag([0.3, 0.3, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale[0]), float(w[1] / scale[1]), float(w[2])


def labelled(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """(doc_id, text, toxic, fold) of the rows that may be learned from."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .filter(~held_out(F.col("doc_id"))))
    marks = stage(marks, "toxic-labels")
    if marks.count() <= params.broadcast_labels:
        marks = F.broadcast(marks)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(marks, "doc_id").withColumn("fold", fold_of(F.col("doc_id")))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, COUNTS) summed over the rows: by word first, so grams are made of distinct words."""
    early = (F.col("fold") != CALIBRATION_FOLD).cast("int")
    sums = dict(zip(COUNTS, (F.col("toxic"), 1 - F.col("toxic"), F.col("toxic") * early, (1 - F.col("toxic")) * early)))
    # The same words as those that are scored: between white space, without what is no letter.
    words = (rows.select("toxic", "fold", F.explode(F.split(F.lower("text"), r"(?U)[\s\x1c-\x1f]+")).alias("w"))
             .withColumn("w", F.regexp_replace("w", r"\P{L}+", "")).filter("w <> ''").groupBy("w").agg(*[F.sum(v).alias(c) for c, v in sums.items()]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            gram, word = word_grams(b["w"].to_pylist())
            keys, inverse = np.unique(gram, return_inverse=True)
            sums = [np.bincount(inverse, b[c].to_numpy()[word]).astype(np.int64) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums)], ["gram", *COUNTS])
    return (words.mapInArrow(count, "gram long, " + ", ".join(f"{c} long" for c in COUNTS))
            .groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> KneserNeyRatio | RatioTables:
    """Models from all folds that may be learned from; the curve comes from models of the other folds
    on the calibration fold."""
    rows = labelled(docs, labels, params)
    grams = stage(gram_counts(rows), "toxic-grams")
    sums = grams.agg(F.count("*"), *[F.sum(c) for c in COUNTS]).first()
    if not (sums[1] and sums[2]):
        return KneserNeyRatio(*[np.zeros(0, np.int64)] * 3, params)
    wide = sums[0] > params.max_grams
    if wide:
        model = RatioTables(grams.select("gram", "toxic", "ordinary"), params)
    else:
        table = {c: v.to_numpy() for c, v in zip(("gram", *COUNTS), grams.toArrow().columns)}
        model = KneserNeyRatio(table["gram"], table["toxic"], table["ordinary"], params)
    model.curve = (1.0, 4.0, -4.0)
    if sums[3] and sums[4]:
        if wide:
            early = grams.select("gram", F.col("early_toxic").alias("toxic"), F.col("early_ordinary").alias("ordinary"))
            early = RatioTables(early.filter("toxic + ordinary > 0"), params)
        else:
            seen = table["early_toxic"] + table["early_ordinary"] > 0
            early = KneserNeyRatio(*[table[c][seen] for c in ("gram", "early_toxic", "early_ordinary")], params)
        part = rows.filter(F.col("fold") == CALIBRATION_FOLD).withColumn("h", F.xxhash64("doc_id", F.lit("toxicity")))
        n = part.count()
        if n > params.calibration_rows:
            part = part.filter(F.pmod("h", F.lit(1_000_000)) < int(1e6 * params.calibration_rows / n))
        found = evidence(part.select("doc_id", "text", "toxic"), early, "toxic int").toArrow()
        x = np.column_stack([found[c].to_numpy() for c in ("mean_ratio", "peak_ratio")])
        model.curve = fit_curve(x, found["toxic"].to_numpy().astype(float))
    return model


def evidence(rows: DataFrame, model: KneserNeyRatio | RatioTables, carry: str) -> DataFrame:
    """doc_id, the ``carry`` column, mean_ratio, peak_ratio and score of every row."""
    if isinstance(model, RatioTables):
        none = float(model.scores(np.zeros((1, 2)))[0])
        return model.join(rows).select(
            "t.doc_id", f"t.{carry.split()[0]}", *[F.coalesce(f"e.{c}", F.lit(0.0)).alias(c) for c in ("mean_ratio", "peak_ratio")],
            F.coalesce("e.score", F.lit(none)).alias("score"))
    load, carried = ship(rows.sparkSession, model), carry.split()[0]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m, cache = load(), {}
        for b in batches:
            for part in small_batches(b, "text", SLICE):
                e = m.evidence(part["text"].to_pylist(), cache)
                give_back()
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part[carried], pa.array(e[:, 0]), pa.array(e[:, 1]), pa.array(m.scores(e))],
                    ["doc_id", carried, "mean_ratio", "peak_ratio", "score"])
    return rows.mapInArrow(judge, f"doc_id long, {carry}, mean_ratio double, peak_ratio double, score double")


def score(docs: DataFrame, model: KneserNeyRatio | RatioTables) -> DataFrame:
    """(doc_id, held_out, score, predicted, mean_ratio, peak_ratio) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id")).alias("held_out"))
    return evidence(rows, model, "held_out boolean").select(
        "doc_id", "held_out", "score", (F.col("score") >= model.params.threshold).cast("int").alias("predicted"),
        "mean_ratio", "peak_ratio")


def reject_toxic(docs: DataFrame, model: KneserNeyRatio | RatioTables) -> DataFrame:
    """The rows of ``docs``, with all its columns, that the model does not call toxic; no join and no shuffle
    unless the model is in tables."""
    if isinstance(model, RatioTables):
        none = float(model.scores(np.zeros((1, 2)))[0])
        return model.join(docs).filter(F.coalesce("e.score", F.lit(none)) < model.params.threshold).select("t.*")
    load = ship(docs.sparkSession, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m, cache = load(), {}
        for b in batches:
            for part in small_batches(b, "text", SLICE):
                scores = m.scores(m.evidence(part["text"].to_pylist(), cache))
                give_back()
                yield part.filter(pa.array(scores < m.params.threshold))
    return docs.mapInArrow(keep, docs.schema)

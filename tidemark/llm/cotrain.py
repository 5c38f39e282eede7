"""Quality classifier by co-training on two views of a document.

The *content* view sees the text: hashed character trigrams and how much of the
text repeats. The *metadata* view sees the page around it: source, language,
length and layout. Each view has a logistic classifier. Over some rounds, each
scores unlabelled rows and hands the ones it is most sure of, as pseudo-labels,
to the other one's training set. Afterwards a fold that neither has seen
calibrates each view and the weights of their combination, which scores every
document.

Fitting uses a bounded sample of labelled rows: ``labelled_rows`` ids on average, chosen
by a hash of the id, whose feature vectors (not texts) come to the driver. All
unlabelled rows that are not held out are scored in the executors in every round, and
those with the surest scores, a fixed number, are handed over. Every document is
scored on its whole text.

Defined results: null text counts as empty; null source or language is a value of
its own. Of labelled rows with one id, one is learned from, the least by hash. Rows without an id are held out. A document with several labels takes
the least. Without labels of both kinds every score is 0.5. Repeated rows get
equal results. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import small_batches
from tidemark.llm.shared import fold_of, held_out, ship, stage

CALIBRATION_FOLD = 3


@dataclass(frozen=True)
class CoTrainParams:
    dims: int = 1024              # of the hashed trigrams
    labelled_rows: int = 4000
    rounds: int = 4
    handed_over: int = 120        # pseudo-labels a view hands over in a round
    sure: float = 0.9             # least confidence of a pseudo-label
    ridge: float = 1.0
    steps: int = 150
    broadcast_ids: int = 300_000   # more labelled ids are joined by shuffle


META = 64 + 16 + 12 + 12 + 12


def content_features(text: str, dims: int) -> np.ndarray:
    """Normalised log counts of hashed byte trigrams, and shares of repeated words and lines."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    out = np.zeros(dims + 3, np.float32)
    if len(b) >= 3:
        grams = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
        grams = (grams ^ (grams >> np.uint32(15))) % np.uint32(dims)
        counts = np.log1p(np.bincount(grams, minlength=dims))
        out[:dims] = counts / max(np.linalg.norm(counts), 1e-9)
    words, lines = text.split(), text.split("\n")
    triples = list(zip(words, words[1:], words[2:]))
    out[dims] = 1 - len(set(words)) / max(len(words), 1)
    out[dims + 1] = 2 * (1 - len(set(triples)) / max(len(triples), 1))
    out[dims + 2] = 1 - len(set(lines)) / max(len(lines), 1)
    return out


def metadata_features(source: str | None, lang: str | None, text: str) -> np.ndarray:
    """One-hot source, language, and bins of length, lines and line length."""
    out = np.zeros(META, np.float32)
    lines = text.count("\n") + 1
    bins = (zlib.crc32(repr(source).encode()) % 64, 64 + zlib.crc32(repr(lang).encode()) % 16,
            80 + min(int(np.log2(len(text) + 1)), 11), 92 + min(int(np.log2(lines)), 11),
            104 + min(int(np.log2(len(text) / lines + 1)), 11))
    out[list(bins)] = 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Weights (last one the intercept) of a ridge logistic regression, by accelerated gradient steps."""
    x, y = np.column_stack([x, np.ones(len(x), np.float32)]), y.astype(np.float32)
    # Both classes weigh the same, as bad pages are rare.
    c = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)).astype(np.float32)
    rate = np.float32(4 * len(x) / max(float((c[:, None] * x * x).sum()), 1e-9))
    w = v = np.zeros(x.shape[1], np.float32)
    for i in range(steps):
        grad = x.T @ (c * (sigmoid(x @ v) - y)) / len(x)
        grad[:-1] += np.float32(ridge / len(x)) * v[:-1]
        new = v - rate * grad
        v = new + np.float32(i / (i + 3)) * (new - w)
        w = new
    return w


def platt(z: np.ndarray, y: np.ndarray, steps: int = 40) -> np.ndarray:
    """Newton fit of a small logistic curve; z holds one column for each input."""
    x, w = np.column_stack([z, np.ones(len(z))]), np.zeros(z.shape[1] + 1)
    penalty = np.diag([0.1] * z.shape[1] + [1e-6])
    for _ in range(steps):
        p = sigmoid(x @ w)
        w -= np.clip(np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty,
                                     x.T @ (p - y) + penalty @ w), -2, 2)
    return w


class CoTrained:
    """Weights of both views, their calibration and combination."""

    def __init__(self, params: CoTrainParams):
        self.params = params
        self.views: list[np.ndarray] = []
        self.curves: list[np.ndarray] = []
        self.join = np.zeros(3)

    def logits(self, x: list[np.ndarray]) -> np.ndarray:
        z = [a @ w[:-1] + w[-1] for a, w in zip(x, self.views)]
        return np.column_stack([c[0] * a + c[1] for a, c in zip(z, self.curves)])

    def scores(self, x: list[np.ndarray]) -> np.ndarray:
        if not self.views:
            return np.full(len(x[0]), 0.5)
        return sigmoid(self.logits(x) @ self.join[:2] + self.join[2])

    def features(self, rows) -> list[np.ndarray]:
        d = self.params.dims
        return [np.array([content_features(t or "", d) for t, _, _ in rows], np.float32).reshape(-1, d + 3),
                np.array([metadata_features(s, g, t or "") for t, s, g in rows], np.float32).reshape(-1, META)]


def sure_rows(p: np.ndarray, keys: np.ndarray, taken: np.ndarray, most: tuple[int, int], sure: float) -> list[np.ndarray]:
    """Places of the surest bad and good rows that were not handed over yet, the surest first, ties by key."""
    free = ~np.isin(keys, taken)
    out = []
    for confidence, n in ((1 - p, most[0]), (p, most[1])):
        at = np.flatnonzero(free & (confidence >= sure))
        out.append(at[np.lexsort((keys[at], -confidence[at]))[:n]])
    return out


def co_train(x: list[np.ndarray], y: np.ndarray, hand_over: Callable, params: CoTrainParams) -> list[np.ndarray]:
    """Weights of both views after the exchange of pseudo-labels.

    ``hand_over(weights, taken, most)`` gives (view, label, key, features of both views) of the unlabelled
    rows of which each view is surest, ``most`` (bad, good) of them, without those in ``taken[view]``.
    """
    more_x, more_y, taken = [[], []], [[], []], [np.zeros(0, np.int64)] * 2
    for turn in range(params.rounds + 1):
        weights = [logistic(np.concatenate([x[v], *more_x[v]]), np.concatenate([y, more_y[v]]), params.ridge, params.steps)
                   for v in (0, 1)]
        if turn == params.rounds:
            break
        share = min(max(float(y.mean()), 0.1), 0.9)
        most = int(params.handed_over * (1 - share)) + 1, int(params.handed_over * share)
        for v, label, key, features in hand_over(weights, taken, most):
            more_x[1 - v].append(features[1 - v][None, :])
            more_y[1 - v].append(label)
            taken[v] = np.append(taken[v], key)
    return weights


def label_marks(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the labelled ids."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")))


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, source, lang, key) of the rows that are not held out; key is a hash of the row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")])
    return rows.filter(~held_out(F.col("doc_id"))).withColumn("key", F.xxhash64("doc_id", "text", "source", "lang"))


def labelled_sample(docs: DataFrame, marks: DataFrame, model: CoTrained) -> list[tuple]:
    """(fold, quality, content, metadata) of the bounded sample of labelled ids; features are made in the executors."""
    params, rows = model.params, document_rows(docs)
    ids = rows.select("doc_id").join(marks, "doc_id").distinct().withColumn(
        "u", F.pmod(F.xxhash64("doc_id", F.lit("cotrain")), F.lit(1 << 30)))
    share = min(1.0, params.labelled_rows / max(ids.count(), 1))
    chosen = ids.filter(F.col("u") < share * (1 << 30)).select("doc_id", "quality")
    # One row an id, as rows may be repeated without bound.
    picked = (rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
              .agg(F.min_by(F.struct("text", "source", "lang"), "key").alias("x"))
              .select(fold_of(F.col("doc_id")).alias("fold"), "quality", "x.*", "doc_id"))
    load = ship(docs.sparkSession, model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for whole in batches:
            for b in small_batches(whole, "text", 1 << 20):
                x = m.features(list(zip(*(b[c].to_pylist() for c in ("text", "source", "lang")))))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], b["fold"], b["quality"], *(pa.array([r.tobytes() for r in v], pa.binary()) for v in x)],
                    ["doc_id", "fold", "quality", "content", "metadata"])
    found = picked.mapInArrow(features, "doc_id long, fold long, quality int, content binary, metadata binary").collect()
    return sorted(found, key=lambda r: (r["doc_id"], bytes(r["content"])))


def pool_hand_over(pool: DataFrame, model: CoTrained) -> Callable:
    """The ``hand_over`` of :func:`co_train` over a table of any size: every row is scored in the executors, each
    task keeps its surest rows, and the surest of these come to the driver, a fixed number with their features."""
    spark, sure = pool.sparkSession, model.params.sure

    def hand_over(weights: list[np.ndarray], taken: list[np.ndarray], most: tuple[int, int]) -> list[tuple]:
        load = ship(spark, (model, weights, taken))

        def surest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, weights, taken = load()
            best: list[list] = [[], []]   # of each view: (confidence, label, key, features)
            for whole in batches:
                for b in small_batches(whole, "text", 1 << 20):
                    x = m.features(list(zip(*(b[c].to_pylist() for c in ("text", "source", "lang")))))
                    keys = b["key"].to_numpy()
                    for v in (0, 1):
                        p = sigmoid(x[v] @ weights[v][:-1] + weights[v][-1])
                        for label, at in enumerate(sure_rows(p, keys, taken[v], most, sure)):
                            own = {r[2]: r for r in best[v] if r[1] == label}
                            own |= {int(keys[i]): (float(p[i] if label else 1 - p[i]), label, int(keys[i]),
                                                   [y[i].tobytes() for y in x]) for i in at}
                            kept = sorted(own.values(), key=lambda r: (-r[0], r[2]))[:most[label]]
                            best[v] = [r for r in best[v] if r[1] != label] + kept
            for v in (0, 1):
                for c, label, key, (content, metadata) in best[v]:
                    yield pa.RecordBatch.from_pylist([{"view": v, "label": label, "confidence": c, "key": key,
                                                       "content": content, "metadata": metadata}], schema)
        ddl = "view int, label int, confidence double, key long, content binary, metadata binary"
        schema = pa.schema([("view", pa.int32()), ("label", pa.int32()), ("confidence", pa.float64()), ("key", pa.int64()),
                            ("content", pa.binary()), ("metadata", pa.binary())])
        rows = pool.mapInArrow(surest, ddl).dropDuplicates(["view", "label", "key"])
        rank = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("confidence"), "key"))
        found = rows.withColumn("rank", rank).filter(
            F.col("rank") <= F.when(F.col("label") == 1, most[1]).otherwise(most[0])).collect()
        return [(r["view"], r["label"], r["key"], [np.frombuffer(r[c], np.float32) for c in ("content", "metadata")])
                for r in sorted(found, key=lambda r: (r["view"], -r["label"], r["rank"]))]
    return hand_over


def fit(docs: DataFrame, labels: DataFrame, params: CoTrainParams = CoTrainParams()) -> CoTrained:
    model = CoTrained(params)
    marks = stage(label_marks(labels), "cotrain-marks")
    if marks.count() <= params.broadcast_ids:
        marks = F.broadcast(marks)
    rows = labelled_sample(docs, marks, model)

    def part(test) -> tuple[list[np.ndarray], np.ndarray]:
        some = [r for r in rows if test(r)]
        widths = (params.dims + 3, META)
        return ([np.frombuffer(b"".join(r[c] for r in some), np.float32).reshape(len(some), w)
                 for c, w in zip(("content", "metadata"), widths)], np.array([r["quality"] for r in some], float))
    x, y = part(lambda r: r["fold"] != CALIBRATION_FOLD)
    cx, cy = part(lambda r: r["fold"] == CALIBRATION_FOLD)
    if len(set(y.tolist())) < 2 or len(set(cy.tolist())) < 2:
        return model
    pool = document_rows(docs).join(marks.select("doc_id"), "doc_id", "left_anti")
    model.views = co_train(x, y, pool_hand_over(pool, model), params)
    model.curves = [platt((a @ w[:-1] + w[-1])[:, None], cy) for a, w in zip(cx, model.views)]
    model.join = platt(model.logits(cx), cy)
    return model


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """(doc_id, held_out, score, predicted): probability of quality 1 of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")])
    load = ship(docs.sparkSession, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for whole in batches:
            for b in small_batches(whole, "text", 1 << 20):
                p = m.scores(m.features(list(zip(*(b[c].to_pylist() for c in ("text", "source", "lang"))))))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], b["held_out"], pa.array(p.astype(float)), pa.array((p >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int")

"""Language identification by nearest centroid over TF-IDF character n-grams.

Fit: a bounded, hash-ordered sample of labelled rows (``per_lang`` a language,
``max_sample`` in all) becomes hashed count vectors in the executors. On the
driver, the sample (max_sample x dims floats at most) gives IDF weights, and
each language's normalised vectors are clustered by spherical k-means into a few
centroids. Predict: every document's whole text becomes one normalised vector;
the language of the centroid with the greatest cosine wins. A document farther
from its centroid than nearly all of the centroid's own sample is ``rejected``.

Defined results: null text, or text without a letter, is ``und`` with score 0.
Rows whose lang is null are predicted, never learned from. Repeated rows get
equal results. With nothing to learn from, every prediction is ``und``. Equal
cosines go to the language first in order. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import held_out, ship

UND = "und"
CHUNK = 1 << 20  # characters handled at once, so that a very long text needs no more memory


@dataclass(frozen=True)
class LangIdParams:
    dims: int = 4096
    per_lang: int = 400
    max_sample: int = 4000
    clusters: int = 3
    rounds: int = 12
    radius_quantile: float = 0.01   # share of a centroid's own sample outside its radius
    broadcast_langs: int = 10_000


ASCII_LETTERS = np.array([chr(i).isalpha() for i in range(128)])


def is_letter(c: np.ndarray) -> np.ndarray:
    """True for ASCII letters and for code points beyond Latin-1's and general punctuation."""
    low = ASCII_LETTERS[np.minimum(c, 127).astype(np.int64)] & (c < 128)
    high = (c >= 0xC0) & (c != 0xD7) & (c != 0xF7) & ~((c >= 0x2000) & (c < 0x2C00)) & ~((c >= 0x3000) & (c < 0x3040))
    return low | high


def ngram_counts(text: str, dims: int) -> np.ndarray:
    """Hashed counts of the text's character 1-, 2- and 3-grams, lower case; what is no letter is a blank."""
    counts = np.zeros(dims, np.int64)
    tail = np.empty(0, np.uint64)
    for at in range(0, len(text), CHUNK):
        part = text[at:at + CHUNK].lower().encode("utf-32-le", "replace")
        c = np.frombuffer(part, np.uint32).astype(np.uint64)
        c = np.where(is_letter(c), c, np.uint64(32))
        # One blank for a run of other characters.
        before = np.concatenate([tail[-1:], c[:-1]]) if len(tail) else np.concatenate([[np.uint64(0)], c[:-1]])
        c = c[(c != 32) | (before != 32)]
        old = len(tail)
        c = np.concatenate([tail, c])
        two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:]
        three = two[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[2:]
        # Grams that end in this chunk only: the tail's own were counted with the chunk before.
        for grams, skip in ((c, old), (two, max(old - 1, 0)), (three, 0)):
            g = (grams[skip:] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            counts += np.bincount((g >> np.uint64(40)).astype(np.int64) % dims, minlength=dims)
        tail = c[-2:]
    return counts


class CentroidModel:
    """IDF weights and centroids; small and of a fixed size for a number of languages."""

    def __init__(self, params: LangIdParams, idf: np.ndarray, centroids: np.ndarray, langs: list[str],
                 radius: np.ndarray):
        self.params, self.idf, self.centroids, self.langs, self.radius = params, idf, centroids, langs, radius

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts).astype(np.float32) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UND, 0.0, True
        cos = self.centroids @ self.vectors(ngram_counts(text, self.params.dims))
        best = int(np.argmax(cos))
        return self.langs[best], float(min(max(cos[best], 0.0), 1.0)), bool(cos[best] < self.radius[best])


def kmeans_cosine(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts at the rows that are farthest from those chosen so far."""
    chosen = [0]
    for _ in range(1, min(k, len(x))):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    c = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].sum(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def sample_vectors(docs: DataFrame, params: LangIdParams) -> DataFrame:
    """(lang, counts as bytes) of the bounded sample of rows that may be learned from."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # A share of each language by hash, about twice what is wanted, so that the exact rank sees few rows.
    ids = rows.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)).alias("h"))
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))
    if sizes.count() <= params.broadcast_langs:
        sizes = F.broadcast(sizes)   # else a shuffle would deal all ids out by language
    near = ids.join(sizes, "lang").filter((F.col("n") < 20) | (F.col("h") * F.col("n") < 2 * params.per_lang * (1 << 30)))
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    ranked = ranked.filter(F.col("r") <= params.per_lang)
    chosen = ranked.orderBy("r", "lang").limit(params.max_sample).select("doc_id", "lang").distinct()
    # One row an id, as rows may be repeated without bound.
    picked = (rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang")
              .agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    dims = params.dims

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), (t.as_py() for t in b["text"])):
                if any(map(str.isalpha, text)):
                    v = ngram_counts(text, dims).astype(np.uint32).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([v], pa.binary())], ["lang", "v"])
    return picked.select("lang", "text").mapInArrow(vectors, "lang string, v binary")


def fit(docs: DataFrame, params: LangIdParams = LangIdParams()) -> CentroidModel:
    rows = sorted((r["lang"], bytes(r["v"])) for r in sample_vectors(docs, params).collect())
    counts = np.array([np.frombuffer(v, np.uint32) for _, v in rows], np.float32).reshape(len(rows), params.dims)
    label = np.array([lang for lang, _ in rows])
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    model = CentroidModel(params, idf, np.zeros((0, params.dims), np.float32), [], np.zeros(0))
    x = model.vectors(counts)
    centroids, langs, radius = [], [], []
    for lang in sorted(set(label.tolist())):
        own = x[label == lang]
        c = kmeans_cosine(own, params.clusters, params.rounds)
        best = own @ c.T
        for j in range(len(c)):
            members = best[np.argmax(best, axis=1) == j, j]
            radius.append(float(np.quantile(members, params.radius_quantile)) if len(members) else 1.0)
            langs.append(lang)
        centroids.append(c)
    if centroids:
        model = CentroidModel(params, idf, np.concatenate(centroids), langs, np.array(radius))
    return model


def identify(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row."""
    load = ship(docs.sparkSession, model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for b in batches:
            found = [m.predict(t.as_py()) for t in b["text"]]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")

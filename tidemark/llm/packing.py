"""Packing documents into windows: non-negative least squares on the length histogram.

Every text is encoded whole and ends with one separator id. Full windows are cut
off its front; what remains is one piece, whose length is rounded up to units of
``grain`` tokens. The histogram of these lengths (a bounded table) is packed on
the driver: all combinations of at most ``depth`` lengths that fill a window are
enumerated, non-negative least squares finds how often to repeat each so that the
histogram is used up, and the counts are rounded down to what is there. What is
left is packed greedily, largest first, as long as windows come out nearly full.
The rest is laid end to end and cut at window ends.

Pieces find their windows by rank: a piece's rank among those of its length
decides the combination and copy. Ranks are prefix sums over hash chunks, so a
length that a third of all pieces share is no single task.

Defined results: null text counts as empty and gives a piece of the separator
alone. Repeated rows are packed each. A null doc_id is kept. Empty tables give
no pieces. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import Codec, decode_text, map_encoded, token_bytes
from tidemark.llm.shared import n_partitions, row_key, ship, stage, text_or_empty

__all__ = ["Codec", "JsonCodec", "PackingParams", "pack", "sequences", "decode_text", "token_bytes"]


@dataclass(frozen=True)
class PackingParams:
    window: int = 2048
    grain: int = 8             # unit of the histogram
    cut: int = 32              # tokens that a piece of the rest may be cut at; a multiple of grain
    depth: int = 3             # pieces of a combination
    separator: int = 1
    greedy_fill: float = 0.99  # windows that the greedy pass may close


class JsonCodec:
    """A tokenizers definition file, read on the driver and broadcast (a few MB, fixed)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            definition = f.read()
        self.path, self.load = path, ship(spark, (definition, []))


def piece_rows(docs: DataFrame, codec, params: PackingParams) -> DataFrame:
    """(doc_id, key, start, length, doc_tokens, crc, grains, u): the pieces of every row.

    ``grains`` of a last piece: crc32 of each run of ``cut`` ids, from which the
    crc32 of any part cut there follows.
    """
    window, cut, grain = params.window, params.cut, params.grain
    end = np.array([params.separator], "<u4").tobytes()

    def make(texts, encoded, table):
        pieces = []
        for e in encoded:
            e = memoryview(e + end)
            n, rows = len(e) // 4, []
            for s in range(0, n, window):
                part = e[4 * s:4 * (s + window)]
                k = len(part) // 4
                grains = None if k == window else [zlib.crc32(part[i:i + 4 * cut]) for i in range(0, 4 * k, 4 * cut)]
                rows.append({"start": s, "length": k, "doc_tokens": n, "crc": zlib.crc32(part), "grains": grains,
                             "u": -(-k // grain)})
            pieces.append(rows)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                                   ("crc", pa.int64()), ("grains", pa.list_(pa.int64())), ("u", pa.int64())]))
        return {"pieces": pa.array(pieces, kind)}
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text")
    schema = ("doc_id long, key long, pieces array<struct<start:long,length:long,doc_tokens:long,crc:long,"
              "grains:array<long>,u:long>>")
    return map_encoded(rows, codec, ["doc_id", "key"], schema, make).select(
        "doc_id", "key", F.inline("pieces"))


def fillings(units: int, depth: int) -> list[tuple[int, ...]]:
    """Combinations of at most ``depth`` lengths below a window whose sum is the window."""
    out = []
    for k in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, units // k + 1), k - 1):
            last = units - sum(head)
            if last >= head[-1]:
                out.append((*head, last))
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 of the least |a x - b|, by the active-set method."""
    x, active = np.zeros(a.shape[1]), []
    gram_diagonal = 1e-9
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= 1e-7 * max(b.max(initial=0.0), 1e-12):
            break
        active.append(j)
        while active:
            p = a[:, active]
            s = np.linalg.solve(p.T @ p + gram_diagonal * np.eye(len(active)), p.T @ b)
            if s.min() > 0:
                x[:] = 0
                x[active] = s
                break
            old = x[active]
            low = s <= 0
            step = np.min(old[low] / np.maximum(old[low] - s[low], 1e-300))
            new = old + step * (s - old)
            x[:] = 0
            x[active] = new
            active = [k for k, v in zip(active, new) if v > 1e-12]
    return x


def plan_windows(histogram: dict[int, int], params: PackingParams) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in units, copies) of the windows that are packed from whole pieces."""
    units = params.window // params.grain
    left = np.zeros(units + 1, np.int64)
    for u, n in histogram.items():
        left[u] = n
    plan = [((units,), int(left[units]))]
    left[units] = 0
    used = [f for f in fillings(units, params.depth) if all(left[u] for u in f)]
    if used:
        a = np.zeros((units, len(used)))
        for j, f in enumerate(used):
            np.add.at(a[:, j], [u - 1 for u in f], 1)
        rows = np.flatnonzero(a.any(axis=1))
        scale = float(left.max())
        x = non_negative_least_squares(a[rows], left[1:][rows] / scale) * scale
        for j in np.argsort(-x, kind="stable"):
            need = np.bincount(used[j])
            at = np.flatnonzero(need)
            copies = min(int(x[j] + 1e-6), int((left[at] // need[at]).min()))
            if copies > 0:
                left[at] -= copies * need[at]
                plan.append((used[j], copies))
    # Greedy: the largest length first, then whatever largest length still fits.
    skipped = np.zeros_like(left)
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        chosen, room = [largest], units - largest
        spare = left.copy()
        spare[largest] -= 1
        while room:
            fits = np.flatnonzero(spare[:room + 1])
            if not len(fits):
                break
            chosen.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            room -= int(fits[-1])
        need = np.bincount(chosen)
        at = np.flatnonzero(need)
        if units - room >= params.greedy_fill * units:
            copies = int((left[at] // need[at]).min())
            left[at] -= copies * need[at]
            plan.append((tuple(chosen), copies))
        else:
            skipped[largest] += left[largest]
            left[largest] = 0
    return [(f, n) for f, n in plan if n]


def slot_rows(plan: list[tuple[tuple[int, ...], int]]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(u, lo, hi, per, base): pieces of length u with rank lo..hi-1 go ``per`` to a window from ``base`` on."""
    rows, taken, base = [], {}, 0
    for lengths, copies in plan:
        for u in sorted(set(lengths)):
            per = lengths.count(u)
            lo = taken.get(u, 0)
            taken[u] = lo + per * copies
            rows.append((u, lo, taken[u], per, base))
        base += copies
    return rows, base


def _chunked_prefix(rows: DataFrame, by: list[str], value: F.Column, name: str, chunks: int) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same ``by`` that come before; any fixed order."""
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "key", "start"), F.lit(chunks))).withColumn("_v", value)
    totals = rows.groupBy(*by, "_chunk").agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_base", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    inside = (Window.partitionBy(*by, "_chunk").orderBy("doc_id", "key", "start")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return (rows.join(totals, [*by, "_chunk"])
            .withColumn(name, F.col("_base") + F.col("_in")).drop("_chunk", "_v", "_base", "_in"))


def crc_of_part(grains: list[int], lengths: list[int]) -> int:
    """crc32 of joined runs of ids from the runs' crc32s and lengths in ids."""
    crc = 0
    for g, n in zip(grains, lengths):
        zeros = bytes(4 * n)
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ g
    return crc


def cut_rest(rest: DataFrame, params: PackingParams, base: int, chunks: int) -> DataFrame:
    """Pieces that found no window, end to end in windows from ``base`` on, cut at their ends."""
    cut, window = params.cut, params.window // params.cut
    rest = _chunked_prefix(rest.withColumn("one", F.lit(1)), ["one"], F.ceil(F.col("length") / cut), "at", chunks)

    def split(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                n, at, done = len(r["grains"]), r["at"], 0
                while done < n:
                    take = min(n - done, window - (at + done) % window)
                    start, stop = done * cut, min((done + take) * cut, r["length"])
                    sizes = [min(cut, r["length"] - i * cut) for i in range(done, done + take)]
                    out.append((r["doc_id"], r["key"], r["start"] + start, stop - start, r["doc_tokens"],
                                crc_of_part(r["grains"][done:done + take], sizes), base + (at + done) // window))
                    done += take
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
    names = ["doc_id", "key", "start", "length", "doc_tokens", "crc", "sequence_id"]
    return rest.select("doc_id", "key", "start", "length", "doc_tokens", "grains", "at").mapInArrow(
        split, ", ".join(f"{n} long" for n in names))


def pack(docs: DataFrame, codec, params: PackingParams = PackingParams()) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    chunks = 4 * n_partitions(spark)
    pieces = stage(piece_rows(docs, codec, params), "pieces")
    histogram = {r["u"]: r["count"] for r in pieces.groupBy("u").count().collect()}
    slots, base = slot_rows(plan_windows(histogram, params))
    ranked = _chunked_prefix(pieces, ["u"], F.lit(1), "rank", chunks)
    # At most a few rows for each combination in use, whatever the number of documents.
    table = spark.createDataFrame(slots or [(0, 0, 0, 1, 0)], "u2 long, lo long, hi long, per long, base long")
    placed = stage(ranked.join(F.broadcast(table), (F.col("u") == F.col("u2")) & (F.col("rank") >= F.col("lo"))
                               & (F.col("rank") < F.col("hi")), "left")
                   .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
                   .drop("u2", "lo", "hi", "per", "base", "rank"), "placed")
    columns = ["doc_id", "key", "start", "length", "doc_tokens", "crc", "sequence_id"]
    out = placed.filter("sequence_id IS NOT NULL").select(columns).union(
        cut_rest(placed.filter("sequence_id IS NULL"), params, base, chunks).select(columns))
    inside = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "key", "start")
              .rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame, docs: DataFrame, codec, params: PackingParams = PackingParams()) -> DataFrame:
    """(sequence_id, ids): the packed ids themselves, for tables whose ids are unique."""
    end = np.array([params.separator], "<u4").tobytes()

    def make(texts, encoded, table):
        return {"ids": pa.array([np.frombuffer(e + end, "<u4").astype(np.int64) for e in encoded], pa.list_(pa.int64()))}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = map_encoded(rows, codec, ["doc_id"], "doc_id long, ids array<long>", make)
    parts = pieces.join(ids, "doc_id").select(
        "sequence_id", F.struct("offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
                                .alias("part")).alias("p"))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list("p")), lambda x: x["part"])).alias("ids"))

"""Exact n-gram Jaccard self-join by universe partition and pigeonhole, and its connected components.

A document's set is its distinct word k-grams, as 64-bit hashes. Exact copies
(equal sets) collapse to a representative first. Then:

* **Size bands.** Two linked sets differ in at most H = |smaller| (1-t)/t
  elements. A band fixes H for the smaller set; a set takes part in its own band
  and in those of the smaller sets that it may link with.
* **Universe partition.** In a band, elements are hashed into segments. An
  *exact* segment gives one key, the hash of its elements: two sets without that
  key in common differ there. A *one-deletion* segment also gives the keys of its
  elements less any one: without a match, the sets differ there twice. Segments
  of a total capacity (1 and 2 each) of H + 1 + e leave a match for every link
  even if e of the capacity is unusable.
* **Cost-based allocation.** For each band, the number of exact and one-deletion
  segments and e are those of the least cost: keys, chance matches and documents
  left to the fallback, for the band's number of documents.
* **Buckets.** Keys of 2 to ``bucket`` sets give all their pairs. A key of more is
  unusable, as is an empty segment; a set whose unusable capacity exceeds e is
  *heavy*. Any link with a set that is not heavy was found by the keys.
* **Heavy sets** (common passages, large groups of near copies) are joined among
  themselves by prefix filtering: the first (1-t)n + 1 elements of two linked sets
  meet, in any one order of all elements. Here rare ones come first, by counters
  that elements share by hash: tasks sum up what their sets hold, and only prefixes
  become rows. Sets that meet, directly or through others, are compared in blocks of
  a bounded number of elements; a task returns only the links that join its sets.
* Every candidate pair is **verified exactly** on whole texts.

Defined results: null or empty text has an empty set (n_shingles 0), linked with
nothing, its own component. Fewer than k words make one shingle. Rows without an
id are left out, as are second rows of an id (the one with the smallest hash of
its text stays). Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import give_back, small_batches
from tidemark.llm.shared import connected_components, n_partitions, ship, stage, unused_name

U64 = np.uint64
RADIX = 0x9E3779B97F4A7C15
CHUNK = 1 << 20


@dataclass(frozen=True)
class JaccardParams:
    words: int = 4
    num: int = 85                 # linked if den * |intersection| >= num * |union|
    den: int = 100
    bucket: int = 32              # keys of more sets are unusable
    band_ratio: float = 1.3
    chance: float = 0.005         # assumed chance that an element is shared by unrelated sets
    block_elements: int = 1 << 20   # of the heavy sets that a block holds, on average
    broadcast_ids: int = 2_000_000  # more ids than this are joined by shuffle
    counters: int = 1 << 22       # at most so many (a power of two) tell rare elements of heavy sets


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(RADIX))
_fold = np.arange(256)
_fold[65:91] += 32
LOWER_VALUES = BYTE_VALUES[_fold]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """RADIX ** i and its inverse's powers, modulo 2 ** 64."""
    inverse = pow(RADIX, -1, 1 << 64)
    n = CHUNK + 1
    return tuple(np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, b, U64))]) for b in (RADIX, inverse))


class Shingler:
    """Whole texts to sorted distinct k-gram hashes; A-Z in lower case, words split at ASCII white space."""

    def __init__(self, k: int):
        self.k = k
        self.up, self.down = _power_tables()
        self.weights = mix(np.arange(11, 11 + k, dtype=U64)) | U64(1)

    def _words(self, data: np.ndarray) -> np.ndarray:
        space = IS_SPACE[data]
        edge = np.diff(np.concatenate([[True], space, [True]]).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.concatenate([[U64(0)], np.cumsum(LOWER_VALUES[data] * self.up[:len(data)])])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64))

    def words(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        if len(data) <= CHUNK:
            return self._words(data)
        found, at = [], 0
        while at < len(data):
            end = min(at + CHUNK, len(data))
            if end < len(data):
                gaps = np.flatnonzero(IS_SPACE[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # one word of over a chunk: its parts stand for it
                    gaps = np.flatnonzero(IS_SPACE[data[end:]])
                    stop = end + int(gaps[0]) if len(gaps) else len(data)
                    parts = [self._words(data[i:min(i + CHUNK, stop)]) for i in range(at, stop, CHUNK)]
                    found.append(mix(np.cumsum(np.concatenate(parts) * U64(RADIX))[-1:]))
                    at = stop
                    continue
            found.append(self._words(data[at:end]))
            at = end
        return np.concatenate(found)

    def shingles(self, text: str | None) -> np.ndarray:
        w = self.words(text) if text else np.zeros(0, U64)
        if not len(w):
            return w
        if len(w) < self.k:
            return mix(np.sum(w * self.weights[:len(w)], keepdims=True) + U64(len(w)))
        n = len(w) - self.k + 1
        grams = w[:n] * self.weights[0]
        for i in range(1, self.k):
            grams += w[i:n + i] * self.weights[i]
        return np.unique(mix(grams))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    one, two = mix(s ^ U64(0xA5A5A5A5)).sum(dtype=U64), mix(s * U64(3) + U64(7)).sum(dtype=U64)
    return int(one.view(np.int64)), int(two.view(np.int64))


@dataclass(frozen=True)
class Band:
    index: int
    low: int
    high: int        # sizes low..high of the smaller set
    exact: int
    deletion: int
    spare: int       # e


def bands_for(params: JaccardParams, largest: int) -> list[tuple[int, int]]:
    out, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * params.band_ratio) - 1)
        out.append((low, high))
        low = high + 1
    return out


SPARE_SHARES = (0.02, 0.04, 0.06, 0.08, 0.1, 0.13, 0.16, 0.2, 0.25, 0.3)  # of H, tried as e


def poisson_at_most(k: int, mean: float) -> float:
    """Probability of at most ``k`` empty segments where ``mean`` are expected."""
    log_terms = [-mean + i * math.log(max(mean, 1e-300)) - math.lgamma(i + 1) for i in range(k + 1)]
    return min(1.0, sum(math.exp(t) for t in log_terms))


def allocate(params: JaccardParams, sizes: dict[int, int]) -> list[Band]:
    """Bands with their cheapest allocation, for ``sizes`` (set size -> number of sets)."""
    bands = []
    for index, (low, high) in enumerate(bands_for(params, max(sizes, default=0))):
        differ = high * (params.den - params.num) // params.num
        if not differ:
            continue  # only equal sets link, and those are one representative
        n = sum(c for size, c in sizes.items() if low <= size <= high * params.den // params.num)
        best = None
        for spare in sorted({*range(8), *(int(differ * f) for f in SPARE_SHARES)}):
            for deletion in range(0, (differ + 1 + spare) // 2 + 1 if high <= 64 else 1):
                exact = differ + 1 + spare - 2 * deletion
                m = exact + deletion
                each = low / m
                mean = exact * math.exp(-each)
                # A set without enough usable segments costs about all its elements, several times over.
                cost = (n * (exact + deletion * (1 + each)) + 4 * n * (1 - poisson_at_most(spare, mean)) * high
                        + n * n * m * params.chance ** max(each, 1e-9) / 2)
                if best is None or cost < best[0]:
                    best = cost, Band(index, low, high, exact, deletion, spare)
        bands.append(best[1])
    return bands


def band_keys(s: np.ndarray, band: Band) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, one-deletion flags, spare capacity left) of a set in a band."""
    seed = mix(np.array([band.index + 1], U64) * U64(0x51_7C_C1_B7_27_22_0A_95))[0]
    m = band.exact + band.deletion
    hashed = mix(s ^ seed)
    segment = ((hashed >> U64(33)) % U64(m)).astype(np.int64)
    value = mix(hashed + U64(RADIX))
    order = np.argsort(segment, kind="stable")
    segment, value = segment[order], value[order]
    there, first = np.unique(segment, return_index=True)
    sums = np.zeros(m, U64)
    sums[there] = np.add.reduceat(value, first)
    tag = mix(np.arange(m, dtype=U64) + seed)
    full = mix(sums + tag)
    keep = np.ones(m, bool)
    keep[:band.exact] = False
    keep[there] = True                      # empty exact segments give no key
    empty = m - int(keep.sum())
    one_less = segment >= band.exact
    less = mix(sums[segment[one_less]] - value[one_less] + tag[segment[one_less]])
    keys = np.concatenate([full[keep], less])
    flags = np.concatenate([np.zeros(int(keep.sum()), np.int8), np.ones(len(less), np.int8)])
    return keys.view(np.int64), flags, band.spare - empty


def _by_ids(docs: DataFrame, ids: DataFrame, params: JaccardParams, how: str) -> DataFrame:
    """Join documents with a staged table of ids: broadcast if it is small, else by shuffle."""
    small = ids.count() <= params.broadcast_ids
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", how)


def fingerprints(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(doc_id, n, f1, f2) of every row."""
    k = params.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for whole in batches:
            for b in small_batches(whole, "text"):
                sets = [shingler.shingles(t) for t in b["text"].to_pylist()]
                prints = [fingerprint(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64())],
                    ["doc_id", "n", "f1", "f2"])
        give_back()
    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long")


def key_rows(docs: DataFrame, params: JaccardParams, bands: list[Band]) -> DataFrame:
    """(key, doc_id, flag, spare) of every set in its bands; a set out of spare capacity also has flag 2."""
    k, num, den = params.words, params.num, params.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for whole in batches:
            for b in small_batches(whole, "text"):
                rows = []
                for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                    s = shingler.shingles(text)
                    for band in bands:
                        if band.low <= len(s) and -(-len(s) * num // den) <= band.high:
                            keys, flags, spare = band_keys(s, band)
                            if band.deletion:
                                spare //= 2  # any key may be worth a capacity of 2
                            if spare < 0:
                                keys, flags = np.append(keys, np.int64(doc)), np.append(flags, np.int8(2))
                            rows.append((keys, np.full(len(keys), doc, np.int64), flags,
                                         np.full(len(keys), max(spare, 0), np.int64)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*rows)], ["key", "doc_id", "flag", "spare"])
        give_back()
    return docs.mapInArrow(run, "key long, doc_id long, flag byte, spare long")


def bucket_rows(keys: DataFrame, params: JaccardParams) -> DataFrame:
    """Pairs (home, a, b) of small buckets, and rows (null, doc, spare) for each unusable key of a set."""
    most = params.bucket

    def pairs(doc: np.ndarray, flag: np.ndarray) -> np.ndarray:
        one, two = np.triu_indices(len(doc), 1)
        # Two one-deletion keys that meet say only that the segments differ in two elements.
        ok = ((flag[one] == 0) | (flag[two] == 0)) & (doc[one] != doc[two])
        a, b = np.minimum(doc[one], doc[two])[ok], np.maximum(doc[one], doc[two])[ok]
        return np.column_stack([np.full(len(a), doc.min()), a, b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(home, a, b):
            home = pa.nulls(len(a), pa.int64()) if home is None else pa.array(home, pa.int64())
            return pa.RecordBatch.from_arrays([home, pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              ["home", "a", "b"])
        held = [np.zeros(0, d) for d in (np.int64, np.int64, np.int8, np.int64)]
        hot = None                         # the key of a run that has grown past the limit
        for batch in batches:
            cols = [np.concatenate([h, batch[c].to_numpy()]) for h, c in
                    zip(held, ("key", "doc_id", "flag", "spare"))]
            key = cols[0]
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.append(starts[1:], len(key))
            heavy_a, heavy_b, found = [], [], []
            last = len(starts) - 1
            interesting = np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == last)
                                         | (key[starts] == (hot if hot is not None else 0))
                                         | (cols[2][starts] == 2))
            for i in interesting:
                s, e = starts[i], ends[i]
                if (hot is not None and key[s] == hot) or e - s > most:
                    heavy_a.append(cols[1][s:e])
                    heavy_b.append(cols[3][s:e])
                    if i == last:
                        hot, s = key[s], e
                elif i < last:
                    marked = cols[2][s:e] == 2
                    heavy_a.append(cols[1][s:e][marked])
                    heavy_b.append(np.full(int(marked.sum()), -1, np.int64))
                    if e - s - marked.sum() > 1:
                        found.append(pairs(cols[1][s:e][~marked], cols[2][s:e][~marked]))
                if i == last:
                    held = [c[s:] for c in cols]
            if found:
                p = np.concatenate(found)
                yield emit(p[:, 0], p[:, 1], p[:, 2])
            if heavy_a and sum(map(len, heavy_a)):
                yield emit(None, np.concatenate(heavy_a), np.concatenate(heavy_b))
        if len(held[0]):
            marked = held[2] == 2
            if marked.any():
                yield emit(None, held[1][marked], np.full(int(marked.sum()), -1, np.int64))
            if (~marked).sum() > 1:
                p = pairs(held[1][~marked], held[2][~marked])
                if len(p):
                    yield emit(p[:, 0], p[:, 1], p[:, 2])
        give_back()
    return (keys.repartition(n_partitions(keys.sparkSession), "key").sortWithinPartitions("key")
            .mapInArrow(run, "home long, a long, b long"))


def verify(pairs: DataFrame, docs: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs (group, a, b) whose sets are linked; a group's texts are read once for its pairs."""
    k, num, den = params.words, params.num, params.den
    need = stage(pairs.select(F.col("a").alias("doc_id"), "group").union(pairs.select("b", "group")).distinct(),
                 "jaccard-need")
    texts = _by_ids(docs, need, params, "inner").select(
        "group", F.col("doc_id").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    rows = texts.union(pairs.select("group", "a", "b", F.lit(None).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, group, sets = Shingler(k), None, {}
        for whole in batches:
            for batch in small_batches(whole, "text"):
                out = []
                for g, a, b, text in zip(*(batch[c].to_pylist() for c in ("group", "a", "b", "text"))):
                    if g != group:
                        group, sets = g, {}
                    if b is None:
                        sets[a] = shingler.shingles(text)
                        continue
                    one, two = sets[a], sets[b]
                    if min(len(one), len(two)) * den >= max(len(one), len(two)) * num:
                        both = len(np.intersect1d(one, two, assume_unique=True))
                        if den * both >= num * (len(one) + len(two) - both):
                            out.append((a, b))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
        give_back()
    return (rows.repartition(n_partitions(docs.sparkSession), "group")
            .sortWithinPartitions("group", F.col("b").asc_nulls_first(), "a").mapInArrow(run, "a long, b long"))


def element_counts(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(e, c): how many sets hold an element, summed up in each task over parts of about a million elements."""
    k = params.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(k), [], 0

        def counted() -> pa.RecordBatch:
            e, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)), pa.array(c)], ["e", "c"])
        for whole in batches:
            for b in small_batches(whole, "text", 1 << 20):
                for text in b["text"].to_pylist():
                    held.append(shingler.shingles(text))
                    size += len(held[-1])
                    if size >= CHUNK:
                        yield counted()
                        held, size = [], 0
        if held:
            yield counted()
        give_back()
    return docs.mapInArrow(run, "e long, c long")


def counter_table(counts: DataFrame, params: JaccardParams) -> np.ndarray:
    """Sums of :func:`element_counts` by the leading bits of the elements, at least 1: a table of bounded size."""
    total = counts.agg(F.sum("c")).first()[0] or 0
    bits = max(1, min(int(total).bit_length(), params.counters.bit_length() - 1))
    slot = F.shiftrightunsigned("e", 64 - bits).cast("int")
    found = counts.groupBy(slot.alias("slot")).agg(F.sum("c").alias("c")).filter("c > 1").toArrow()
    table = np.ones(1 << bits, np.int32)
    table[found["slot"].to_numpy()] = np.minimum(found["c"].to_numpy(), np.iinfo(np.int32).max)
    return table


def prefix_rows(docs: DataFrame, table: np.ndarray, params: JaccardParams) -> DataFrame:
    """(doc_id, n, e) of each set's first (1-t)n + 1 elements by (counter, e), without those that no other set holds."""
    k, num, den = params.words, params.num, params.den
    shift, often = 65 - len(table).bit_length(), ship(docs.sparkSession, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table = Shingler(k), often()
        for whole in batches:
            for b in small_batches(whole, "text", 1 << 20):
                rows = []
                for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                    s = shingler.shingles(text)
                    n = len(s)
                    c = table[(s >> U64(shift)).astype(np.int64)]
                    front = np.argsort(c, kind="stable")[:n - -(-n * num // den) + 1]  # s is sorted
                    e = s[front[c[front] > 1]]
                    rows.append((np.full(len(e), doc, np.int64), np.full(len(e), n, np.int64), e.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*rows)], ["doc_id", "n", "e"])
        give_back()
    return docs.mapInArrow(run, "doc_id long, n long, e long")


def heavy_links(docs: DataFrame, heavy: DataFrame, params: JaccardParams) -> DataFrame:
    """Links (a, b) that leave the heavy sets' components as all their links would.

    Sets that share an element of their prefixes are gathered into components, and these are compared
    block by block: a task holds the sets of two blocks and returns the links that join them.
    """
    k, num, den = params.words, params.num, params.den
    mine = stage(_by_ids(docs, heavy, params, "inner"), "jaccard-heavy")
    counts = stage(element_counts(mine, params), "jaccard-counts")
    front = stage(prefix_rows(mine, counter_table(counts, params), params), "jaccard-front")
    shared = (front.groupBy("e").agg(F.count("*").alias("df"), F.min("doc_id").alias("center"))
              .filter("df > 1").drop("df"))
    edges = (front.join(shared, "e").filter("doc_id <> center")
             .select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct())
    parts = connected_components(edges)
    sized = front.select("doc_id", "n").distinct().join(parts, F.col("doc_id") == F.col("node"))
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n") / params.block_elements).cast("int").alias("s"))
    members = stage(sized.join(blocks, "component").select("doc_id", "component", "s"), "jaccard-members")
    rows = _by_ids(mine, members, params, "inner").withColumn("i", F.pmod(F.xxhash64("doc_id"), F.col("s")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    rows = rows.select("doc_id", "text", "i", F.xxhash64("component", F.least("i", "j"), F.greatest("i", "j")).alias("pair"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, pair, held = Shingler(k), None, []

        def links() -> pa.RecordBatch:
            found = linked_within(held, num, den)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], ["a", "b"])
        for whole in batches:
            for b in small_batches(whole, "text"):
                for doc, text, i, p in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "i", "pair"))):
                    if p != pair:
                        if held:
                            yield links()
                        pair, held = p, []
                    held.append((doc, i, shingler.shingles(text)))
        if held:
            yield links()
        give_back()
    return (rows.repartition(n_partitions(docs.sparkSession), "pair").sortWithinPartitions("pair", "doc_id")
            .mapInArrow(compare, "a long, b long"))


def linked_within(held: list[tuple[int, int, np.ndarray]], num: int, den: int) -> list[tuple[int, int]]:
    """Links among (id, block, set) that join all that is linked: of one block all pairs are compared, of
    two those across. A set is compared with all others at once, by counting its elements in them."""
    ids = [h[0] for h in held]
    block = np.array([h[1] for h in held])
    across = len(set(block.tolist())) > 1
    sizes = np.array([len(h[2]) for h in held], np.int64)
    _, element = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    label, mark, out = np.arange(len(held)), np.zeros(int(element.max()) + 1, np.int64), []
    for x in range(len(held) - 1):
        rest = np.arange(x + 1, len(held))
        fits = (np.minimum(sizes[rest], sizes[x]) * den >= np.maximum(sizes[rest], sizes[x]) * num)
        if not (fits & (label[rest] != label[x])).any():
            continue
        own = element[starts[x]:ends[x]]
        mark[own] = 1
        both = np.add.reduceat(mark[element[starts[x + 1]:]], starts[x + 1:] - starts[x + 1])
        mark[own] = 0
        linked = den * both >= num * (sizes[x] + sizes[rest] - both)
        if across:
            linked &= block[rest] != block[x]
        for y in rest[linked]:
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                out.append((ids[x], ids[y]))
    return out


def jaccard_components(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.filter("doc_id IS NOT NULL")
    prints = stage(fingerprints(docs, params), "jaccard-prints")
    if prints.count() != prints.select("doc_id").distinct().count():
        docs = stage(docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "jaccard-docs")
        prints = stage(fingerprints(docs, params), "jaccard-prints")
    classes = stage(prints.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "jaccard-reps")
    sizes = {r["n"]: r["c"] for r in classes.groupBy("n").agg(F.count("*").alias("c")).collect()}
    bands = allocate(params, sizes)
    copies = stage(prints.join(classes, ["f1", "f2", "n"], "left").filter("rep IS NULL OR doc_id <> rep")
                   .select("doc_id"), "jaccard-copies")
    reps = _by_ids(docs, copies, params, "left_anti")

    found = stage(bucket_rows(key_rows(reps, params, bands), params), "jaccard-buckets")
    pairs = stage(found.filter("home IS NOT NULL").groupBy("a", "b").agg(F.min("home").alias("group")),
                  "jaccard-pairs")
    heavy = stage(found.filter("home IS NULL").groupBy(F.col("a").alias("doc_id"))
                  .agg(F.count("*").alias("unusable"), F.min("b").alias("spare"))
                  .filter("unusable > spare").select("doc_id"), "jaccard-heavy-ids")
    links = verify(pairs, docs, params)
    if not heavy.isEmpty():
        links = links.union(heavy_links(docs, heavy, params))
    links = stage(links, "jaccard-links")
    parts = connected_components(links)
    return (prints.join(classes, ["f1", "f2", "n"], "left")
            .join(parts, F.col("rep") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """The rows of ``docs``, with all its columns: of each component the row of the smallest id, and all rows
    without an id."""
    found = stage(jaccard_components(docs, params), "jaccard-components")
    gone = stage(found.filter("doc_id <> component_id").select("doc_id"), "jaccard-gone")
    kept = _by_ids(docs.alias("d"), gone, params, "left_anti")
    if docs.filter("doc_id IS NOT NULL").count() == found.count():
        return kept
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(F.col("text").cast("string"))))
    name = unused_name(docs, "_rank")
    return kept.withColumn(name, rank).filter(f"{name} = 1 OR doc_id IS NULL").drop(name)

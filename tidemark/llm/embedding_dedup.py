"""Embedding near-dedup: NN-descent within labels, threshold links, connected components.

1. Vectors that are equal bit for bit collapse to one with a weight.
2. **Start**: random-hyperplane buckets (about ``leaf`` vectors each, by the size
   of the label) give every vector a first list of its ``k`` nearest neighbours.
   Neighbours below ``floor`` are of no use for a link and are not kept.
3. **Descent**: at every vector, its neighbours and those that list it are compared
   with each other, and each vector's list is refined; until few lists change.
4. **Saturation**: a list full of links may miss some. Links that comparisons find
   beyond the lists are kept as spanning forests. Vectors with full lists are searched
   again for links with other components. Lists of a component with such a vector are
   enlarged to the whole component, compared block by block; tasks return counts, not
   pairs.
5. **Audit**: a bounded sample is compared with all vectors. While the recall of
   its links is below ``target_recall``, the search is repeated with twice as many
   bucket tables; after the last attempt, all vectors of a label are compared.

Cosines are in double precision. Defined results: a vector that is null, empty or
zero, holds null or non-finite components, or has no label, links with nothing.
Rows without an id are left out; of several rows of an id, one stays. Vectors of
different lengths never link. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import connected_components, n_partitions, ship, stage


@dataclass(frozen=True)
class NeighbourParams:
    threshold: float = 0.98
    floor: float = 0.9
    k: int = 12
    leaf: int = 64              # vectors of a bucket on average
    tables: int = 10
    rounds: int = 4             # of descent, at most
    settled: float = 0.002      # share of list entries whose change ends the descent
    chunk: int = 512            # vectors compared at once in a bucket
    block: int = 1024           # vectors of a component's block
    audit: int = 400            # sampled vectors, at first
    audit_links: int = 100      # the sample grows until so many vectors with links were seen,
    audit_most: int = 6400      # or it has so many
    target_recall: float = 0.98
    attempts: int = 3
    small_rows: int = 100_000   # tables up to this size are broadcast
    seed: int = 7


def runs(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Rows of equal ``key`` (sorted input) as tables of at most ``most`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        k = batch[key].to_numpy(zero_copy_only=False)
        at = 0
        for cut in [*(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]:
            if held and at < len(k) and held[-1][key][held[-1].num_rows - 1].as_py() != k[at]:
                yield pa.Table.from_batches(held)
                held = []
            while at < cut:
                room = most - sum(h.num_rows for h in held)
                held.append(batch.slice(at, min(room, cut - at)))
                at += held[-1].num_rows
                if room == held[-1].num_rows:
                    yield pa.Table.from_batches(held)
                    held = []
            if held and cut < len(k):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def unit(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of the binary column as unit vectors in double precision."""
    x = np.frombuffer(b"".join(vectors.to_pylist()), "<f8").reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def parts_by(table: pa.Table, column: str) -> Iterator[pa.Table]:
    """The table by values of a column; nearly always one part."""
    values = table[column].to_pylist()
    if len(set(values)) == 1:
        yield table
        return
    for v in sorted(set(values)):
        yield table.take([i for i, x in enumerate(values) if x == v])


def spanning(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs that join all that a symmetric matrix of links joins; fewer than it has rows."""
    unseen, a, b = np.ones(len(near), bool), [], []
    for root in np.flatnonzero(near.any(axis=1)).tolist():
        reached = [root] if unseen[root] else []
        unseen[root] = False
        while reached:
            at = reached.pop()
            new = np.flatnonzero(near[at] & unseen).tolist()
            unseen[new] = False
            a += [at] * len(new)
            b += new
            reached += new
    return a, b


def nearest(table: pa.Table, ids: str, params: NeighbourParams) -> pa.RecordBatch:
    """(a, b, s): each row's k nearest rows of other components c, at ``floor`` or more; and where links
    are not among them, as many links as join what all of them join."""
    i, c, x = table[ids].to_numpy(), table["c"].to_numpy(), unit(table["v"])
    s = x @ x.T
    s[c[:, None] == c[None, :]] = -2.0
    keep = s >= params.floor
    if len(i) > params.k:
        keep &= s >= -np.partition(-s, params.k - 1, axis=1)[:, params.k - 1:params.k]
        for row in np.flatnonzero(keep.sum(axis=1) > params.k):   # ties: the smallest ids
            own = np.flatnonzero(keep[row])
            keep[row, own[np.lexsort((i[own], -s[row, own]))[params.k:]]] = False
        near = s >= params.threshold
        near |= near.T
        if (near & ~keep & ~keep.T).any():
            keep[spanning(near)] = True
    a, b = np.nonzero(keep)
    return pa.RecordBatch.from_arrays([pa.array(y) for y in (i[a], i[b], s[a, b])], ["a", "b", "s"])


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, g, v) of the vectors that can link: g names label and length, v holds the doubles."""
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("e"))
    e = e.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(e) > 0")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, groups, out = [], [], []
            for i, label, v in zip(b["vec_id"].to_pylist(), b["label"].to_pylist(), b["e"].to_pylist()):
                x = np.array([np.nan if c is None else c for c in v], "<f8") + 0.0
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    groups.append(f"{len(x)}:{label}")
                    out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(groups, pa.string()), pa.array(out, pa.binary())],
                ["vec_id", "g", "v"])
    return e.mapInArrow(pack, "vec_id long, g string, v binary")


def _small(df: DataFrame, params: NeighbourParams) -> DataFrame:
    return F.broadcast(df) if df.count() <= params.small_rows else df


def _sorted_by(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.repartition(n_partitions(df.sparkSession), key).sortWithinPartitions(key, *order)


def first_lists(vectors: DataFrame, params: NeighbourParams, tables: range) -> DataFrame:
    """(a, b, s) from random-hyperplane buckets, ``tables`` of them. ``vectors``: vec_id, c, g, v."""
    sizes = stage(vectors.groupBy("g").agg(F.count("*").alias("size")), "nn-sizes")
    seed, leaf, span, count = params.seed, params.leaf, (tables.start, tables.stop), len(tables)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            table = pa.Table.from_batches([b])
            for part in parts_by(table, "g") if table.num_rows else ():
                x, size = unit(part["v"]), part["size"][0].as_py()
                bits = max(0, math.ceil(math.log2(max(size, 1) / leaf)))
                for t in range(*span):
                    # 16 bits more order the vectors of a bucket, so that its chunks hold near ones.
                    shape = (x.shape[1], bits + 16)
                    if (t, *shape) not in planes:
                        planes[t, *shape] = np.random.default_rng([seed, t, *shape]).standard_normal(shape)
                    side = x @ planes[t, *shape] > 0
                    code = side[:, :bits] @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                    fine = side[:, bits:] @ (1 << np.arange(16, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*(part[c].combine_chunks() for c in ("vec_id", "c", "g", "v")),
                         pa.array(np.full(len(x), t)), pa.array(code), pa.array(fine)],
                        ["vec_id", "c", "g", "v", "t", "code", "fine"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "bucket", params.chunk):
            for part in parts_by(run, "g") if run.num_rows > 1 else ():
                yield nearest(part, "vec_id", params)
    assert count
    coded = vectors.join(_small(sizes, params), "g").select("vec_id", "c", "g", "v", "size").mapInArrow(
        codes, "vec_id long, c long, g string, v binary, t long, code long, fine long")
    coded = coded.select("vec_id", "c", "g", "v", F.xxhash64("g", "t", "code").alias("bucket"), "fine")
    return _sorted_by(coded, "bucket", "fine", "vec_id").mapInArrow(compare, "a long, b long, s double")


def best_k(edges: DataFrame, k: int) -> DataFrame:
    """Each vector's k nearest of the edges found so far, ties by id."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return (edges.groupBy("a", "b").agg(F.max("s").alias("s"))
            .withColumn("r", rank).filter(F.col("r") <= k).drop("r"))


def descend(lists: DataFrame, vectors: DataFrame, params: NeighbourParams) -> DataFrame:
    """One round: neighbours and reverse neighbours of each vector are compared with each other."""
    both = lists.select("a", "b").union(lists.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    at = both.join(vectors.select(F.col("vec_id").alias("b"), "c", "v"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "a", params.chunk):
            if run.num_rows > 1:
                yield nearest(run, "b", params)
    return _sorted_by(at.select("a", "b", "c", "v"), "a", "b").mapInArrow(compare, "a long, b long, s double")


def neighbour_graph(vectors: DataFrame, params: NeighbourParams, found: DataFrame,
                    inner: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(lists, links found) after descent from the ``found`` edges, also along those of ``inner``."""
    links = found.filter(F.col("s") >= params.threshold)
    lists = stage(best_k(found, params.k), "nn-lists")
    total = lists.count()
    for _ in range(params.rounds if total else 0):
        more = stage(descend(lists if inner is None else lists.union(inner), vectors, params), "nn-round")
        links = links.union(more.filter(F.col("s") >= params.threshold))
        refined = stage(best_k(lists.union(more), params.k), "nn-lists")
        changed = refined.join(lists, ["a", "b"], "left_anti").count()
        lists = refined
        if changed <= params.settled * total:
            break
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return lists, stage(links, "nn-links")


def link_components(vectors: DataFrame, params: NeighbourParams, lists: DataFrame, links: DataFrame,
                    tables: int) -> tuple[DataFrame, DataFrame]:
    """(links, components) with those between components, of vectors whose lists are full of links.

    Their lists show nothing beyond their own component. So they are searched again, alone, by buckets and
    descent that compare only across components, until that joins no more of them.
    """
    parts = stage(connected_components(links), "nn-parts")
    full = full_lists(lists, params).withColumnRenamed("a", "vec_id")
    dense = stage(vectors.drop("c").join(full, "vec_id"), "nn-dense")
    while True:
        named = dense.join(parts.select(F.col("node").alias("vec_id"), F.col("component").alias("c")), "vec_id")
        several = named.groupBy("g").agg(F.count_distinct("c").alias("m")).filter("m > 1").select("g")
        named = stage(named.join(several, "g", "left_semi").select("vec_id", "c", "g", "v"), "nn-named")
        if named.isEmpty():
            return links, parts
        found = stage(first_lists(named, params, range(tables)), "nn-across")
        more = neighbour_graph(named, params, found, lists)[1]
        if more.isEmpty():
            return links, parts
        links = stage(links.union(more), "nn-links")
        parts = stage(connected_components(links), "nn-parts")


def full_lists(lists: DataFrame, params: NeighbourParams) -> DataFrame:
    """(a) of the lists that are full of links."""
    return (lists.filter(F.col("s") >= params.threshold).groupBy("a").count()
            .filter(F.col("count") >= params.k).select("a"))


def block_rows(members: DataFrame, params: NeighbourParams, spans: bool) -> DataFrame:
    """(vec_id, n, b): weights of the other members of its component that each vector links with, as
    parts of a sum; with ``spans`` also links (vec_id, 0, b) that join all that is linked.

    ``members``: vec_id, c, size, w, v. A component of s blocks is s (s + 1) / 2 tasks' worth of
    pairs of blocks; a task holds two blocks.
    """
    s = F.greatest(F.ceil(F.col("size") / params.block), F.lit(1))
    m = members.withColumn("s", s.cast("int")).withColumn("i", F.pmod(F.xxhash64("vec_id"), F.col("s")).cast("int"))
    m = m.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    m = m.select("vec_id", "w", "v", "i", F.xxhash64("c", F.least("i", "j"), F.greatest("i", "j")).alias("pair"))
    threshold = params.threshold

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "pair", 1 << 30):
            ids, w, i = (run[c].to_numpy() for c in ("vec_id", "w", "i"))
            x = unit(run["v"])
            n, kept = np.zeros(len(ids), np.int64), []
            for at in range(0, len(ids), 512):
                near = x[at:at + 512] @ x.T >= threshold
                near &= ids[at:at + 512, None] != ids[None, :]
                if len(set(i.tolist())) > 1:  # two blocks: only pairs across them
                    near &= i[at:at + 512, None] != i[None, :]
                n[at:at + 512] = near @ w
                kept.append(near if spans else near[:0])
            a, b = spanning(np.concatenate(kept)) if spans else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(ids, ids[a])), pa.array(np.append(n, np.zeros(len(a), np.int64))),
                 pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(ids[b], pa.int64())])], ["vec_id", "n", "b"])
    return _sorted_by(m, "pair", "vec_id").mapInArrow(count, "vec_id long, n long, b long")


def block_counts(members: DataFrame, params: NeighbourParams) -> DataFrame:
    """(vec_id, n): weights of the other members of its component that each vector links with."""
    return block_rows(members, params, False).groupBy("vec_id").agg(F.sum("n").alias("n"))


def compare_all(vectors: DataFrame, params: NeighbourParams) -> tuple[DataFrame, DataFrame]:
    """(links, counts) by comparing all vectors of each label, block by block: exact, and quadratic in its size."""
    sizes = vectors.groupBy("g").agg(F.count("*").alias("size"))
    members = vectors.join(_small(sizes, params), "g").select("vec_id", F.xxhash64("g").alias("c"), "size", "w", "v")
    rows = stage(block_rows(members, params, True), "nn-exact")
    counts = rows.groupBy("vec_id").agg(F.sum("n").alias("n")).filter("n > 0")
    return rows.filter("b IS NOT NULL").select(F.col("vec_id").alias("a"), "b"), stage(counts, "nn-counts")


def audit(vectors: DataFrame, counts: DataFrame, parts: DataFrame, params: NeighbourParams) -> float | None:
    """Recall of links, by a sample that grows until enough vectors with links are in it.

    None if it has not one: then recall is unknown, unless the sample is all there is.
    """
    total, size = vectors.count(), params.audit
    while True:
        recall, linked = sampled_recall(vectors, counts, parts, params, size)
        if size >= total:
            return 1.0 if recall is None else recall
        if linked >= params.audit_links or size >= params.audit_most:
            return recall
        size *= 4


def sampled_recall(vectors: DataFrame, counts: DataFrame, parts: DataFrame, params: NeighbourParams,
                   size: int) -> tuple[float | None, int]:
    """Recall of the sampled vectors' links, against a comparison of the sample with all vectors: the lower
    of the averages over vectors and over components, so that one large group does not hide the others;
    and how many of the sample have links."""
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(params.seed))).limit(size).select("vec_id", "g", "v")
    rows = sample.collect()
    by_group: dict[str, tuple[list[int], list[bytes]]] = {}
    for r in rows:
        ids, vs = by_group.setdefault(r["g"], ([], []))
        ids.append(r["vec_id"])
        vs.append(bytes(r["v"]))
    queries = {g: (np.array(i), unit(pa.chunked_array([pa.array(v)]))) for g, (i, v) in by_group.items()}
    load, threshold = ship(vectors.sparkSession, queries), params.threshold

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = load()
        for b in batches:
            table = pa.Table.from_batches([b])
            for part in parts_by(table, "g") if table.num_rows else ():
                if (q := asked.get(part["g"][0].as_py())) is not None:
                    near = q[1] @ unit(part["v"]).T >= threshold
                    near &= q[0][:, None] != part["vec_id"].to_numpy()[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q[0]), pa.array((near @ part["w"].to_numpy()).astype(np.int64))], ["vec_id", "n"])
    true = (vectors.mapInArrow(compare, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("actual"))
            .filter("actual > 0"))
    recall = F.least(F.coalesce("n", F.lit(0)) / F.col("actual"), F.lit(1.0)).alias("r")
    seen = (true.join(counts, "vec_id", "left").join(parts, F.col("vec_id") == F.col("node"), "left")
            .select(recall, F.coalesce("component", "vec_id").alias("c"))
            .groupBy("c").agg(F.sum("r").alias("r"), F.count("*").alias("m")))
    r = seen.agg(F.sum("r") / F.sum("m"), F.avg(F.col("r") / F.col("m")), F.sum("m")).first()
    return (None, 0) if r[0] is None else (min(r[0], r[1]), r[2])


def near_duplicates(embeddings: DataFrame, params: NeighbourParams = NeighbourParams()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every id."""
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).filter("vec_id IS NOT NULL").distinct()
    rows = valid_vectors(embeddings).groupBy("vec_id").agg(F.min(F.struct("g", "v")).alias("x"))
    rows = stage(rows.select("vec_id", "x.g", "x.v"), "nn-rows")
    copies = rows.groupBy("g", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w"))
    copies = stage(copies, "nn-copies")
    vectors = copies.select(F.col("rep").alias("vec_id"), F.col("rep").alias("c"), "g", "v", "w")

    found, done, tables = None, 0, params.tables
    for _ in range(params.attempts):
        more = stage(first_lists(vectors, params, range(done, tables)), "nn-first")
        found, done, tables = more if found is None else found.union(more), tables, 2 * tables
        lists, links = neighbour_graph(vectors, params, found)
        links, parts = link_components(vectors, params, lists, links, tables)
        # Components with a list that is full of links.
        wide = full_lists(lists, params).join(parts, F.col("a") == F.col("node")).select("component").distinct()
        wide = stage(parts.join(wide, "component", "left_semi"), "nn-wide")
        sizes = wide.groupBy("component").agg(F.count("*").alias("size"))
        members = (wide.join(sizes, "component").withColumnRenamed("component", "c")
                   .join(vectors.select("vec_id", "w", "v"), F.col("node") == F.col("vec_id"))
                   .select("vec_id", "c", "size", "w", "v"))
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = ends.join(wide.select(F.col("node").alias("a")), "a", "left_anti")
        counted = (ends.join(vectors.select(F.col("vec_id").alias("b"), "w"), "b")
                   .groupBy(F.col("a").alias("vec_id")).agg(F.sum("w").alias("n")))
        counts = stage(block_counts(members, params).union(counted), "nn-counts")
        recall = audit(vectors, counts, parts, params)
        if recall is not None and recall >= params.target_recall:
            break
    if recall is not None and recall < params.target_recall:
        links, counts = compare_all(vectors, params)
        parts = stage(connected_components(links), "nn-parts")

    owners = rows.join(copies, ["g", "v"]).select("vec_id", "rep", "w")
    owners = (owners.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left")
              .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
              .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    return (every.join(owners, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))

"""Near-duplicate operators against brute force."""

import itertools
import random

import numpy as np
import pytest
from helpers import components, documents, lower_ascii, odd_documents, words
from pyspark.sql import functions as F

from tidemark.llm.embedding_dedup import NeighbourParams, near_duplicates
from tidemark.llm.jaccard_join import JaccardParams, Shingler, allocate, band_keys, jaccard_components, keep_one
from tidemark.llm.shared import connected_components


def brute_jaccard(rows, k, num, den):
    sets = {}
    for doc, text, *_ in rows:
        w = words(lower_ascii(text or ""))
        sets[doc] = {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {d: len(s) for d, s in sets.items()}, components(sets, links)


def planted(seed):
    """Near copies in a large group, a common passage of varying share, short texts, chains."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    base, passage, out = prose(150), prose(60), []
    for _ in range(40):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        out.append(t)
    out += [passage + prose(rng.randint(0, 60)) for _ in range(50)]
    out += [prose(rng.randint(1, 9)) for _ in range(20)]
    chain = prose(100)
    for _ in range(15):
        chain = list(chain)
        chain[rng.randrange(100)] = rng.choice(vocabulary)
        out.append(chain)
    out += [prose(rng.randint(10, 300)) for _ in range(30)]
    out += [out[0], out[3], out[60]]
    return [(i * 7 + 1, " ".join(t).upper() if i % 9 == 0 else " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("params", [JaccardParams(), JaccardParams(bucket=4), JaccardParams(5, 80, 100, bucket=3)])
def test_jaccard_join_equals_brute_force(spark, params):
    rows = planted(3)
    n, c = brute_jaccard(rows, params.words, params.num, params.den)
    got = jaccard_components(documents(spark, rows, clashing=True), params).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in got} == n
    assert {r["doc_id"]: r["component_id"] for r in got} == c


def test_jaccard_join_odd_rows(spark):
    rows = odd_documents()
    got = jaccard_components(documents(spark, rows), JaccardParams()).collect()
    ids = {r[0]: r for r in rows if r[0] is not None}
    n, c = brute_jaccard(ids.values(), 4, 85, 100)
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (n[d], c[d]) for d in ids}
    assert jaccard_components(documents(spark, [])).count() == 0


def test_keep_one_keeps_all_columns_and_rows_without_id(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    kept = keep_one(docs, JaccardParams(5, 80, 100))
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(4) == 1 and 5 not in ids and 1 in ids and 11 in ids


@pytest.mark.parametrize("params", [JaccardParams(), JaccardParams(5, 80, 100)])
def test_jaccard_join_of_long_texts(spark, params):
    """More spare capacity is left in long texts than a byte holds."""
    rng, rows = random.Random(6), []
    for i, n in enumerate((8_000, 20_000, 25_000, 60_000)):
        text = [f"w{rng.randrange(50_000)}" for _ in range(n)]
        near = list(text)
        for at in rng.sample(range(n), n // 100):
            near[at] = "changed"
        far = [w if at % 9 else f"far{at}" for at, w in enumerate(text)]
        rows += [(10 * i + j, " ".join(t)) for j, t in enumerate((text, near, far))]
    n, c = brute_jaccard(rows, params.words, params.num, params.den)
    assert {c[r[0]] for r in rows} == {10 * i + j for i in range(4) for j in (0, 2)}
    got = jaccard_components(documents(spark, rows), params).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (n[d], c[d]) for d in n}


def near_copies(n, seed=8):
    """One text of 160 words with one to three words changed in each copy, and another passage with different ends."""
    rng = random.Random(seed)
    base, passage = ([f"{c}{rng.randrange(10_000)}" for _ in range(160)] for c in "bp")
    rows = []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(160), rng.randint(1, 3)):
            text[at] = f"new{rng.randrange(10_000)}"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(passage[:90] + [f"end{i}_{j}" for j in range(i % 60)]))]
    return rows


def test_heavy_sets_become_rows_by_prefix_only(spark, monkeypatch):
    """Of sets that share crowded keys, no step makes a row for each element."""
    frames, real = [], type(spark.range(1)).mapInArrow

    def spied(self, *args, **kwargs):
        frames.append(real(self, *args, **kwargs))
        return frames[-1]
    rows = near_copies(60)
    params = JaccardParams(5, 80, 100, bucket=8)
    n, c = brute_jaccard(rows, params.words, params.num, params.den)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", spied)
    got = jaccard_components(documents(spark, rows).coalesce(2), params).collect()
    monkeypatch.undo()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (n[d], c[d]) for d in n}
    made = {tuple(f.columns): f.count() for f in frames if "e" in f.columns}
    assert made[("doc_id", "n", "e")] <= sum(x - -(-x * 80 // 100) + 1 for x in n.values())
    assert sum(made.values()) < 0.7 * sum(n.values())


@pytest.mark.parametrize("counters", [2, 1 << 10])
def test_shared_counters_lose_no_link(spark, counters):
    """Elements that share a counter are put in a worse order, still one order of all."""
    rows = near_copies(20) + [(1000 + d, t) for d, t in planted(4)]
    params = JaccardParams(5, 80, 100, bucket=3, counters=counters)
    _, c = brute_jaccard(rows, params.words, params.num, params.den)
    got = jaccard_components(documents(spark, rows), params).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == c


def test_allocation_leaves_a_match_for_every_link():
    """Sets that differ by as much as a link allows share a usable key, unless one is out of capacity."""
    rng = np.random.default_rng(1)
    params = JaccardParams()
    for band in allocate(params, {size: 1000 for size in range(6, 400)}):
        for _ in range(40):
            size = int(rng.integers(band.low, band.high + 1))
            differ = size * (params.den - params.num) // params.num
            one = rng.integers(0, 1 << 62, size, dtype=np.uint64)
            gone = int(rng.integers(0, min(differ, size - 1) + 1))
            two = np.concatenate([one[gone:], rng.integers(0, 1 << 62, differ - gone, dtype=np.uint64)])
            (a, fa, sa), (b, fb, sb) = band_keys(np.unique(one), band), band_keys(np.unique(two), band)
            common = {(x, f) for x, f in zip(a.tolist(), fa)} , {(x, f) for x, f in zip(b.tolist(), fb)}
            meet = {(x, f, g) for x, f in common[0] for y, g in common[1] if x == y and not (f and g)}
            assert meet or (sa < 0 and sb < 0)


def test_shingles_of_a_long_text_do_not_depend_on_chunks():
    s = Shingler(4)
    text = " ".join(f"word{i % 977}" for i in range(300_000))
    assert len(s.shingles(text)) == 977 and len(s.shingles("x" * 3_000_000)) == 1
    assert not np.array_equal(s.shingles("x" * 3_000_000), s.shingles("x" * 3_000_001))


def brute_vectors(rows, threshold=0.98):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, np.array(v, float) / np.linalg.norm(np.array(v, float)), label))
    links = [(a[0], b[0]) for a, b in itertools.combinations(good, 2)
             if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= threshold]
    n = {}
    for a, b in links:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    return n, components({r[0] for r in rows if r[0] is not None}, links)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({"g": F.lit("x"), "v": F.lit(1), "w": F.lit(2), "component": F.lit(3)})


def check_vectors(spark, rows, params=NeighbourParams()):
    n, c = brute_vectors(rows)
    got = {r["vec_id"]: r for r in near_duplicates(vectors(spark, rows), params).collect()}
    assert set(got) == set(c)
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (n.get(i, 0), c[i], c[i] == i), i


def test_nn_descent_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (0, 1):
        for size in (1, 1, 2, 3, 9, 70):
            centre = rng.standard_normal(16)
            for _ in range(size):
                v = centre + rng.standard_normal(16) * 0.07
                rows.append((i, np.float32(v).tolist(), label))
                i += 1
        rows += [(i + j, np.float32(rng.standard_normal(16)).tolist(), label) for j in range(60)]
        i += 60
    # k and block smaller than the large group: saturated lists, several blocks.
    check_vectors(spark, rows, NeighbourParams(k=6, leaf=16, block=32, chunk=64))


def tight_groups(rng, cosine, size, spread, dim=32):
    """Two groups of near copies whose centres have the given cosine."""
    q, _ = np.linalg.qr(rng.standard_normal((dim, 2)))
    centres = q[:, 0], cosine * q[:, 0] + np.sqrt(1 - cosine ** 2) * q[:, 1]
    return [c + rng.standard_normal(dim) * spread / np.sqrt(dim) for c in centres for _ in range(size)]


def test_links_between_tight_groups(spark):
    """All of a label are in one bucket and every list is full of links of its own group."""
    rng = np.random.default_rng(8)
    rows = [(v.tolist(), label) for label, cosine in enumerate((0.986, 0.9)) for v in tight_groups(rng, cosine, 20, 0.02)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    n, c = brute_vectors(rows)
    assert n[0] == 39 and n[40] == 19 and len(set(c.values())) == 3
    check_vectors(spark, rows)


def test_exact_comparison_after_the_last_attempt(spark):
    """One bucket table and no descent lose isolated pairs; a large group does not hide them."""
    rng, rows = np.random.default_rng(9), []
    centre = rng.standard_normal(16)
    made = [centre + rng.standard_normal(16) * 0.02 for _ in range(80)]
    for _ in range(30):
        pair = rng.standard_normal(16)
        made += [pair + rng.standard_normal(16) * 0.12 for _ in range(2)]
    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(made)]
    check_vectors(spark, rows, NeighbourParams(tables=1, rounds=0, leaf=1, attempts=1, block=32))


def test_nn_descent_odd_rows(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, e, 0), (2, [2.0, 4.0, 6.0], 0), (3, e, 1), (4, e, None), (5, None, 0), (6, [0.0] * 3, 0),
            (7, [1.0, float("nan"), 0.0], 0), (8, [1.0, float("inf"), 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [], 0),
            (11, [1.0, 2.0], 0), (12, [1.0, 2.0], 0), (None, e, 0), (13, [-0.0, 0.0, 1.0], 1), (14, [0.0, 0.0, 1.0], 1)]
    check_vectors(spark, rows)
    repeated = near_duplicates(vectors(spark, [(1, e, 0), (1, e, 0), (2, e, 0)])).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in repeated) == [(1, 1), (2, 1)]
    assert near_duplicates(vectors(spark, [])).count() == 0


def test_connected_components_of_random_graphs(spark):
    rng = random.Random(4)
    for n, m in ((40, 30), (60, 20), (30, 200)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 140)]
        want = components({x for e in links if e[0] != e[1] for x in e}, [e for e in links if e[0] != e[1]])
        got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_audit_sees_links_or_says_so(spark):
    """Rare pairs: the sample grows until it has seen links; without any, recall is unknown."""
    from tidemark.llm.embedding_dedup import audit
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1200, 16))
    x[600:612] = x[:12] + rng.normal(size=(12, 16)) * 0.01
    rows = [(i, "l", [float(c) for c in v]) for i, v in enumerate(x)]
    from tidemark.llm.embedding_dedup import valid_vectors
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).select(
        "vec_id", "g", "v", F.lit(1).cast("long").alias("w")).cache()
    linked = [*range(12), *range(600, 612)]
    parts = spark.createDataFrame([(i, i % 600) for i in linked], "node long, component long")
    found = spark.createDataFrame([(i, 1) for i in linked if i % 600 < 6], "vec_id long, n long")
    params = NeighbourParams(audit=20, audit_links=20, audit_most=5000)
    assert audit(vectors, found, parts, params) == pytest.approx(0.5)
    alone = vectors.filter("vec_id < 600")
    assert audit(alone, found.limit(0), parts.limit(0), NeighbourParams(audit=10, audit_most=40)) is None
    assert audit(alone, found.limit(0), parts.limit(0), params) == 1.0   # all compared


def test_tied_neighbours_make_no_pairs_of_all(spark):
    """Scaled copies are ties at the same similarity: lists hold k of them, and the result counts all."""
    import pyarrow as pa
    from tidemark.llm.embedding_dedup import nearest
    v = np.random.default_rng(2).normal(size=8)
    n, params = 300, NeighbourParams()
    table = pa.table({"i": list(range(n)), "c": list(range(n)), "v": pa.array([(v * 2.0 ** (k % 40)).tobytes() for k in range(n)])})
    assert nearest(table, "i", params).num_rows <= (params.k + 2) * n
    rows = [(i, "l", [float(c) for c in v * (1 + i / 7)]) for i in range(n)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(n - 1, 0)}

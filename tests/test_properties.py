"""Property tests: operators against brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import latest_non_null, latest_per_key, link_on_any, upsert
from tidemark.operators.links import salted_equi_join

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
keys = st.integers(0, 4)
vals = st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""]))
rows3 = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 5)), vals), max_size=25)


@SETTINGS
@given(rows=rows3)
def test_latest_per_key_matches_brute_force(spark, rows):
    rows = [(k, ts, v, i) for i, (k, ts, v) in enumerate(rows)]  # i: unique tie-breaker
    df = spark.createDataFrame(rows, "k int, ts int, v string, i int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts", "i"]).collect())
    best = {}
    for r in rows:
        key = (r[1] is not None, r[1] if r[1] is not None else 0, r[3])  # NULL ts loses
        if r[0] not in best or key > best[r[0]][0]:
            best[r[0]] = (key, r)
    assert got == sorted(r for _, r in best.values())


@SETTINGS
@given(rows=rows3)
def test_latest_non_null_matches_brute_force(spark, rows):
    rows = [(k, ts if ts is not None else 0, v, i) for i, (k, ts, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, ts int, v string, i int")
    got = dict(tuple(r) for r in df.groupBy("k").agg(latest_non_null("v", ["ts", "i"]).alias("v")).collect())
    want = {}
    for k in {r[0] for r in rows}:
        cands = [r for r in rows if r[0] == k and r[2] is not None]
        want[k] = max(cands, key=lambda r: (r[1], r[3]))[2] if cands else None
    assert got == want


@SETTINGS
@given(old=st.dictionaries(keys, st.tuples(vals, st.integers(0, 9)), max_size=5),
       new=st.dictionaries(keys, st.tuples(vals, st.integers(10, 19)), max_size=5))
def test_upsert_matches_dict_merge(spark, old, new):
    schema = "k int, v string, created_at int"
    t = spark.createDataFrame([(k, v, c) for k, (v, c) in old.items()], schema)
    u = spark.createDataFrame([(k, v, c) for k, (v, c) in new.items()], schema)
    got = {r.k: (r.v, r.created_at) for r in upsert(t, u, ["k"]).collect()}
    want = dict(old)
    for k, (v, c) in new.items():
        want[k] = (v, old[k][1] if k in old else c)
    assert got == want


contacts = st.one_of(st.none(), st.sampled_from(["", "x", "y"]))


@SETTINGS
@given(left=st.lists(st.tuples(st.integers(0, 6), contacts, contacts), max_size=12),
       right=st.lists(st.tuples(st.sampled_from(["p", "q", "r"]), st.sampled_from(["", "x", "y"]),
                                st.sampled_from(["", "x", "y"])), max_size=8),
       salts=st.sampled_from([1, 3]))
def test_link_on_any_matches_or_join(spark, left, right, salts):
    ldf = spark.createDataFrame(left, "id int, email string, phone string")
    rdf = spark.createDataFrame(right, "cid string, email string, phone string")
    got = sorted(tuple(r) for r in link_on_any(ldf, rdf, [("email", "email"), ("phone", "phone")],
                                               ["id"], ["cid"], salts=salts).collect())
    want = sorted({(i, c) for i, e, p in left for c, re, rp in right
                   if (e is not None and e == re) or (p is not None and p == rp)})
    assert got == want


@SETTINGS
@given(big=st.lists(st.tuples(st.sampled_from(["", "a", "b"]), st.integers(0, 3)), max_size=20),
       small=st.lists(st.tuples(st.sampled_from(["", "a", "c"]), st.integers(0, 3)), max_size=6))
def test_salted_join_matches_plain(spark, big, small):
    b = spark.createDataFrame(big, "k string, x int")
    s = spark.createDataFrame(small, "k string, y int")
    got = sorted(tuple(r) for r in salted_equi_join(b, s, "k", [""], salts=4).collect())
    want = sorted((k, x, y) for k, x in big for k2, y in small if k == k2)
    assert got == want

"""Registered queries against their DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from tidemark.plans.oracle_sql import oracle_queries
from tidemark.plans.queries import QUERIES
from compare import compare, duck
from conftest import SF_SMALL

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(entry.queries()[name](spark, SF_SMALL), con, entry.oracle_sql()[name])
    assert res["columns_match"] and res["types_match"] and res["hash_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "customer_id" in df.columns


DUCK_TO_SPARK = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
                 "TIMESTAMP": "timestamp_ntz", "DECIMAL(38,9)": "decimal(38,9)", "DOUBLE": "double"}


def test_column_types_match_oracle(spark, con):
    bad = {}
    for name, fn in QUERIES.items():
        s = {f.name: f.dataType.simpleString() for f in fn(spark, SF_SMALL).schema.fields}
        rel = con.sql(entry.oracle_sql()[name])
        d = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
        if s != d:
            bad[name] = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
    assert not bad, bad


def test_every_candidate_place_decides_in_some_document(spark):
    """Each of the four places of a journey value wins in one fixture document, with a value of its own."""
    from tidemark.plans import models
    from tidemark.sources.fixtures import candidate_document
    docs = spark.createDataFrame([(i, candidate_document(i)) for i in range(4)], "i int, doc string")
    rec = models.journey_record("doc")
    fields = models.journey_fields(rec.bind("_rec"))
    rows = docs.select("i", "doc", rec.struct().alias("_rec")).select("i", *[c.alias(n) for n, c in fields.items()]).collect()
    counts = [31, 34, 35, 37]
    for r in rows:
        i = r["i"]
        assert (r["order_index"], r["day_to_conversion"], r["moments_count"]) == (10 + i, 20 + i, counts[i])
        for v, visit in enumerate(("first", "last")):
            for f in ("landing_page", "referral_code", "referrer_url", "source", "source_type"):
                assert r[f"{visit}_{f}"] == f"{visit} {f} {i}"
            assert r[f"{visit}_utm_parameters"] == f'{{"at":"{visit} utm_parameters {i}"}}'
            assert str(r[f"{visit}_occurred_at"]) == f"2024-0{v + 1}-0{i + 1} 03:04:05"


@pytest.mark.parametrize("a,b", [("deleted_at", "cancelled_at"), ("created_at", "processed_at")])
def test_a_swapped_rename_is_noticed(spark, con, monkeypatch, a, b):
    from tidemark.plans import models
    swapped = {out: {a: b, b: a}.get(src, src) for out, src in models.ORDERS_LATEST_RENAMES.items()}
    monkeypatch.setattr(models, "ORDERS_LATEST_RENAMES", swapped)
    res = compare(QUERIES["orders_latest"](spark, SF_SMALL), con, oracle_queries()["orders_latest"])
    assert res["columns_match"] and not res["hash_match"]


def test_no_two_order_columns_hold_the_same_values(spark):
    """A column read in another's place would show, and every nullable one is NULL somewhere."""
    from tidemark.sources.fixtures import fx_orders
    rows = fx_orders(spark, SF_SMALL).drop("updated_at").toPandas()
    seen = {}
    for c in rows.columns:
        values = tuple(rows[c].astype(str))
        assert values not in seen, (c, seen.get(values))
        seen[values] = c
    assert not [c for c in rows.columns if rows[c].notna().all() and c not in ("id", "extract_seq")]

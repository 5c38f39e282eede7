"""Operators: latest-per-key, latest values, OR-join rewrite, upsert, schema sync, checks."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import (
    check_summary, latest_non_null, latest_per_key, not_null, sync_schema, unique, unique_combo, upsert,
)
from tidemark.operators.links import matches_any, salted_equi_join
from tidemark.operators.upsert import key_violations
from tidemark.plans import models
from tidemark.plans.examples import first_model, second_model
from tidemark.plans.queries import full_run
from tidemark.schemas import IDENTITY_MAP
from tidemark.sources.fixtures import fx_customers

D = dt.datetime


def test_latest_per_key_null_timestamp_loses(spark):
    df = spark.createDataFrame([(1, None, 9), (1, D(2020, 1, 1), 1), (2, D(2020, 1, 1), 1),
                                (2, D(2020, 1, 1), 2)], "k int, ts timestamp_ntz, seq int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts", "seq"]).collect())
    assert got == [(1, D(2020, 1, 1), 1), (2, D(2020, 1, 1), 2)]


def test_latest_non_null(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 3), (1, "b", 2), (2, None, 1)],
                               "k int, v string, ts int")
    got = dict(tuple(r) for r in df.groupBy("k").agg(latest_non_null("v", ["ts"]).alias("v")).collect())
    assert got == {1: "b", 2: None}


def test_link_rewrite_equals_or_join(spark):
    cust = fx_customers(spark, SF_SMALL)
    idmap = full_run(spark, SF_SMALL)[IDENTITY_MAP.name]
    rewrite = models.shop_links(cust, idmap)
    ids = idmap.select("customer_id", F.coalesce("email", F.lit("")).alias("email"),
                       F.coalesce("phone", F.lit("")).alias("phone"))
    as_written = (cust.alias("ods").join(ids.alias("map"), matches_any([("email", "email"), ("phone", "phone")],
                                                                        "ods", "map"))
                  .filter(F.col("ods.id").isNotNull())
                  .select("map.customer_id", F.col("ods.id").alias("shopify_id"), "ods.updated_at").distinct())
    assert rewrite.count() == as_written.count() > 0
    assert rewrite.exceptAll(as_written).count() == 0
    assert as_written.exceptAll(rewrite).count() == 0


def test_salted_join_equals_plain_join(spark):
    big = spark.createDataFrame([("", i) for i in range(50)] + [("x", 1), ("y", 2)], "k string, a int")
    small = spark.createDataFrame([("", "p"), ("", "q"), ("x", "r")], "k string, b string")
    salted = salted_equi_join(big, small, "k", [""], salts=7)
    plain = big.join(small, "k")
    assert salted.count() == plain.count() == 101
    assert salted.exceptAll(plain).count() == 0


def test_ignore_blank_drops_blank_matches(spark):
    cust = fx_customers(spark, SF_SMALL)
    idmap = full_run(spark, SF_SMALL)[IDENTITY_MAP.name]
    assert models.shop_links(cust, idmap, ignore_blank=True).count() < models.shop_links(cust, idmap).count()


def test_upsert_shape(spark):
    old = spark.createDataFrame([(i, f"old{i}", D(2020, 1, 1)) for i in range(100)],
                                "k int, v string, created_at timestamp_ntz")
    new = spark.createDataFrame([(i, f"new{i}", D(2021, 1, 1)) for i in range(90, 120)],
                                "k int, v string, created_at timestamp_ntz")
    out = upsert(old, new, ["k"])
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == out.count() == 120
    assert rows[95].v == "new95" and rows[95].created_at == D(2020, 1, 1)
    assert rows[110].created_at == D(2021, 1, 1) and rows[5].v == "old5"


def test_upsert_syncs_schema(spark):
    old = spark.createDataFrame([(1, "a", 7)], "k int, v string, gone int")
    new = spark.createDataFrame([(2, "b", True)], "k int, v string, added boolean")
    out = upsert(old, new, ["k"], exclude=())
    assert out.columns == ["k", "v", "added"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", None), (2, "b", True)]
    synced = sync_schema(old, new.schema)
    assert synced.columns == ["k", "v", "added"]


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    r = key_violations(df, ["k"]).first()
    assert (r.null_keys, r.duplicate_keys) == (1, 2)


def test_checks_and_example_models(spark):
    first = first_model(spark)
    second = second_model(first)
    assert not_null(first, "id").count() == 1
    assert unique(first, "id").count() == 0
    assert not_null(second, "id").count() == 0 and second.count() == 1
    summary = {(r.check_name, r.column_name): r.failures
               for r in check_summary(first, "my_first", ["id"], ["id"]).collect()}
    assert summary == {("not_null", "id"): 1, ("unique", "id"): 0}
    dup = spark.createDataFrame([(None, "1"), ("", "1"), ("a", "2")], "e string, p string")
    assert [tuple(r) for r in unique_combo(dup, ["e", "p"], normalise=["e"]).collect()] == [("", "1", 2)]


def test_salt_count_does_not_change_the_shop_map(spark):
    from tidemark.operators.incremental import RunContext
    cust = fx_customers(spark, SF_SMALL)
    idmap = full_run(spark, SF_SMALL)[IDENTITY_MAP.name]
    ctx = RunContext("2002-01-01 00:00:00")
    a = models.shop_map_updates(cust, idmap, ctx, salts=1)
    b = models.shop_map_updates(cust, idmap, ctx, salts=5)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

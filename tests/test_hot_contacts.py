"""Hot contacts found from the data: grids, the split join, links against the OR join."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from tidemark.operators.incremental import RunContext
from tidemark.operators.links import find_hot_values, grid_equi_join, grid_of, matches_any
from tidemark.plans import models
from tidemark.plans.queries import QUERIES, stored_runs


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.integers(0, 10**9), st.integers(1, 10**7))
def test_grid_bounds_a_task_and_copies_the_smaller_side(left, right, limit):
    a, b = grid_of(left, right, limit)
    assert 1 <= a <= max(left, 1) and 1 <= b <= max(right, 1)
    assert left * right <= limit * a * b or (a, b) == (max(left, 1), max(right, 1))
    if left * right <= limit:
        assert (a, b) == (1, 1)
    if left > 4 * right and a * b > 1:
        assert a >= b    # the side with more rows is in more parts, so the other is copied more


def _tables(spark):
    """Raw blanks far above identity blanks, a hot phone on both sides, and ordinary contacts."""
    raw = spark.range(6000).selectExpr(
        "id AS shopify_id", "CASE WHEN id < 4000 THEN '' WHEN id % 7 = 0 THEN NULL ELSE concat('u', id % 900) END AS email",
        "CASE WHEN id % 3 = 0 THEN '+100' WHEN id % 5 = 0 THEN NULL ELSE concat('+', id % 700) END AS phone",
        "TIMESTAMP_NTZ '2024-01-01' AS updated_at")
    ids = spark.range(1500).selectExpr(
        "concat('c', id) AS customer_id", "CASE WHEN id < 3 THEN '' WHEN id < 10 THEN NULL ELSE concat('u', id) END AS email",
        "CASE WHEN id % 4 = 0 THEN '+100' ELSE concat('+', id) END AS phone")
    return raw, ids


def test_hot_values_and_their_sides(spark):
    raw, ids = _tables(spark)
    known = ids.select(F.coalesce("email", F.lit("")).alias("email"), "phone")
    email = find_hot_values(raw.select("email"), known.select("email"), "email", 5000)
    assert set(email) == {""} and email[""][0] > 1 and email[""][1] == 1          # raw rows spread, identities copied
    other = find_hot_values(known.select("email"), raw.select("email"), "email", 5000)
    assert other[""] == email[""][::-1]                                           # whichever side they are on
    phone = find_hot_values(raw.select("phone"), known.select("phone"), "phone", 5000)
    assert phone["+100"][0] > 1 and phone["+100"][1] > 1                          # both sides large: a grid
    assert phone["+100"][0] * phone["+100"][1] * 5000 >= 2000 * 375
    none = raw.filter("false")
    assert find_hot_values(none.select("email"), none.select("email"), "email", 1) == {}


@pytest.mark.parametrize("grids", [{}, {"+100": (7, 3)}, {"+100": (1, 9), "+5": (4, 1), "absent": (2, 2)}])
def test_grid_join_is_the_plain_join(spark, grids):
    raw, ids = _tables(spark)
    left, right = raw.select("phone", "shopify_id"), ids.select("phone", "customer_id")
    got, want = grid_equi_join(left, right, "phone", grids), left.join(right, "phone")
    assert got.columns == want.columns and want.count() > 500_000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_task_gets_a_whole_hot_value(spark):
    """Shuffled by its join keys, the hot phone lies in many partitions."""
    raw, ids = _tables(spark)
    left, right = raw.select("phone", "shopify_id"), ids.select("phone", "customer_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = grid_equi_join(left, right, "phone", find_hot_values(left, right, "phone", 5000)).filter("phone = '+100'")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 * 375 and max(sizes) < sum(sizes) / 3


def test_copies_of_a_grid_are_not_broadcast(spark, scratch):
    """A table of a few KB is 200,000 rows once it is copied, and the estimate of the plan stays at the few KB."""
    raw, ids = _tables(spark)
    for name, df in (("raw", raw.select("phone", "shopify_id")), ("ids", ids.select("phone", "customer_id"))):
        df.write.parquet(f"{scratch}/{name}")
    left, right = spark.read.parquet(f"{scratch}/raw"), spark.read.parquet(f"{scratch}/ids")
    joined = grid_equi_join(left, right, "phone", {"+100": (500, 1)})
    assert joined.count() == left.join(right, "phone").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("ignore_blank", [False, True])
def test_links_with_detection_are_those_of_the_or_join(spark, ignore_blank):
    raw, ids = _tables(spark)
    raw = raw.filter("shopify_id % 4 = 0")
    customers = raw.withColumnRenamed("shopify_id", "id")
    got = models.shop_links(customers, ids, ignore_blank, pairs_per_task=2000)
    a, b = raw, ids.select("customer_id", F.coalesce("email", F.lit("")).alias("email"), "phone")
    if ignore_blank:
        a = a.withColumn("email", F.nullif("email", F.lit("")))
    want = (a.alias("a").join(b.alias("b"), matches_any([("email", "email"), ("phone", "phone")], "a", "b"))
            .select("customer_id", "shopify_id", "a.updated_at").distinct())
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    pairs = models.shop_map_updates(customers, ids, RunContext("2024-02-01 00:00:00"), ignore_blank, pairs_per_task=2000)
    assert {tuple(r) for r in pairs.select("customer_id", "shopify_id").collect()} == {
        (r[0], r[1]) for r in want.collect()}


def test_the_stored_runs_meet_hot_contacts(spark):
    """The given tables hold a contact that is spread in the registered query shop_map_incremental."""
    from tidemark.plans.queries import STORED_PAIRS_PER_TASK, landed
    from tidemark.schemas import IDENTITY_MAP
    known = stored_runs(spark, SF_MEDIUM)[2][IDENTITY_MAP.name].select(F.coalesce("email", F.lit("")).alias("email"))
    hot = find_hot_values(landed(spark, SF_MEDIUM)["customers"].select("email"), known, "email", STORED_PAIRS_PER_TASK)
    assert QUERIES["shop_map_incremental"](spark, SF_MEDIUM).count() > 0
    assert hot and all(a * b > 1 for a, b in hot.values())

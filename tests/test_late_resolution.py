"""Orders stored without a customer, resolved when their shop id is linked later (opt-in)."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.incremental import RunContext
from tidemark.plans import models
from tidemark.plans.queries import QUERIES, stored_runs
from tidemark.schemas import ORDERS, ORDERS_MART_COLUMNS


def test_late_links_resolve_stored_orders(spark):
    store, r1, r2 = stored_runs(spark, SF_SMALL, late=True)
    off, on = r2[ORDERS.name], QUERIES["orders_late_resolution"](spark, SF_SMALL)
    one = off.select("order_id", F.col("customer_id").alias("was"), F.col("created_at").alias("born"), "updated_at")
    two = on.select("order_id", "customer_id", "created_at", F.col("updated_at").alias("now"))
    both = one.join(two, "order_id")
    assert both.count() == off.count() == on.count()
    moved = both.filter("was != customer_id")
    assert moved.count() > 0
    assert moved.filter("was != 'unknown' OR customer_id = 'unknown' OR born != created_at OR now <= updated_at").count() == 0
    assert both.filter("was = customer_id AND now != updated_at").count() == 0
    assert r1[ORDERS.name].count() <= on.count()


def _stored(spark, rows):
    df = spark.createDataFrame(rows, "order_id long, shopify_id long, customer_id string, updated_at timestamp_ntz")
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ORDERS_MART_COLUMNS])


def test_only_new_links_unknown_orders_and_untouched_orders_count(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    stored = _stored(spark, [(1, 10, "unknown", old), (2, 20, "unknown", old), (3, 10, "c0", old), (4, 10, "unknown", old),
                             (5, None, "unknown", old), (6, 30, "unknown", old)])
    links = spark.createDataFrame([("c1", 10, datetime(2023, 1, 1)), ("c2", 10, new), ("c3", 20, datetime(2023, 1, 1)),
                                   ("c4", None, new), ("c5", 99, new)],
                                  "customer_id string, shopify_id long, updated_at timestamp_ntz")
    ctx = RunContext("2024-02-02 00:00:00", stored)
    fresh = spark.createDataFrame([(4,)], "order_id long")
    got = models.late_resolved_orders(stored, fresh, links, ctx)
    assert got.columns == list(ORDERS_MART_COLUMNS)
    # 2 was linked before the mark, 3 is known, 4 is rewritten anyway, 5 has no shop id, 6 no link
    assert [(r["order_id"], r["customer_id"], r["updated_at"]) for r in got.collect()] == [(1, "c2", datetime(2024, 2, 2))]
    for empty in (stored.limit(0), stored):
        none = models.late_resolved_orders(empty, fresh, links.filter("false"), RunContext("2024-02-02 00:00:00", empty))
        assert none.count() == 0

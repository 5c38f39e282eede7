"""Wide rows and links are shuffled once or not at all; the results stay those of the plain forms."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import RunContext, latest_per_key, link_on_any
from tidemark.operators.latest import latest_version, newest_versions
from tidemark.plans import models
from tidemark.plans.queries import QUERIES
from tidemark.sources.fixtures import FIXTURE_LANDING, RAW_SOURCES, fixture_inputs, landed_inputs
from tidemark.sources.raw import deal_by_date

CONTACTS = [("email", "email"), ("phone", "phone")]


def _exchanges_with(df, column: str) -> int:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    found = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]$", buf.getvalue(), re.M)
    return sum(bool(re.search(rf"\b{column}#", columns)) for columns in found)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("pairs_per_task", [None, 1])
def test_links_are_distinct_without_a_shuffle_of_all(spark, pairs_per_task):
    left = spark.createDataFrame(
        [(1, "a", "p"), (1, "a", "p"), (1, "b", "q"), (2, "a", "p"), (3, None, "q"), (4, "", ""), (5, "a", None),
         (6, "b", "p"), (None, "a", "q"), (None, "b", "q")], "shop long, email string, phone string")
    right = spark.createDataFrame(
        [("x", "a", "p"), ("x", "b", "q"), ("y", "a", "q"), ("z", "", ""), ("w", "b", ""), ("w", "b", ""), ("v", "", "p")],
        "customer string, email string, phone string")
    links = link_on_any(left, right, CONTACTS, ["shop"], ["customer"], pairs_per_task=pairs_per_task)
    want = {(s, c) for s, e, p in map(tuple, left.collect()) for c, f, q in map(tuple, right.collect())
            if (e is not None and e == f) or (p is not None and p == q)}
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(want) and set(got) == want
    assert links._jdf.queryExecution().optimizedPlan().nodeName() == "Union"


@pytest.mark.parametrize("hot", [1, 1_000])
def test_latest_version_is_one_row_a_key(spark, hot):
    rows = [(k, t, i, f"{k}-{t}-{i}") for k in range(5) for t in (None, 1, 2, 2) for i in (None, 3)]
    df = spark.createDataFrame(rows, "k long, ts long, i long, wide string")
    got = sorted(map(tuple, latest_version(df, "k", ["ts", "i"], hot).collect()))
    assert got == sorted(map(tuple, latest_per_key(df, ["k"], ["ts", "i"]).collect())) == [(k, 2, 3, f"{k}-2-3") for k in range(5)]
    assert newest_versions(df, "k", ["ts", "i"], hot).count() == 10


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_older_versions_are_not_sorted(spark, no_broadcast):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS ts", "repeat('x', 100) AS wide")
    newest = newest_versions(df, "k", ["ts"])
    # The only sorts are those of the narrow side's window.
    assert "ShuffledHashJoin" in _plan(newest) and "SortMergeJoin" not in _plan(newest).split("ShuffledHashJoin")[0]
    assert sorted(r["ts"] for r in newest.collect()) == list(range(93, 100))


def test_orders_are_dealt_out_once(spark, no_broadcast):
    assert _exchanges_with(QUERIES["orders_mart"](spark, SF_SMALL), "line_items") == 1


@pytest.mark.parametrize("name, column", [("customers", "addresses"), ("orders", "fulfillments"), ("journey", "customer_journey_summary")])
def test_landing_deals_narrow_rows(spark, scratch, name, column):
    source, derive = RAW_SOURCES[name]
    landed = derive(deal_by_date(source(spark, SF_SMALL), "o_orderdate", FIXTURE_LANDING, "o_orderdate"))
    assert _exchanges_with(landed, column) == 0 and _exchanges_with(landed, "ingest_date") == 1
    plain, table = fixture_inputs(spark, SF_SMALL)[name], landed_inputs(spark, SF_SMALL, f"{scratch}/raw")[name]
    late = F.trunc(F.to_date(F.expr("updated_at + make_dt_interval(extract_seq % 3)")), "month")
    assert table.filter(~F.col("ingest_date").eqNullSafe(late)).isEmpty()
    table = table.select(*plain.columns)
    assert table.exceptAll(plain).isEmpty() and plain.exceptAll(table).isEmpty()


def _broadcasts_with(df, column: str) -> bool:
    return bool(re.search(rf"BroadcastExchange(?:(?!Exchange|Join).)*\b{column}#", _plan(df), re.S))


def _stored(spark, scratch, name, df):
    """A small file of many rows: dictionaries and runs make its size say little of its rows in memory."""
    df.write.parquet(f"{scratch}/{name}")
    return spark.read.parquet(f"{scratch}/{name}")


UPDATED = "TIMESTAMP_NTZ '2024-01-01' AS updated_at"


def test_stored_links_are_not_broadcast(spark, scratch):
    links = _stored(spark, scratch, "links", spark.range(5000).selectExpr(
        "concat('c', id % 3) AS customer_id", "id AS shopify_id", UPDATED))
    ids = _stored(spark, scratch, "ids", spark.range(4).selectExpr(
        "concat('c', id) AS customer_id", "concat('e', id) AS email", "'' AS phone", "TIMESTAMP_NTZ '2024-01-01' AS created_at"))
    customers = spark.range(2000).selectExpr(
        "id", "'x' AS currency", "'[]' AS addresses", "concat('f', id) AS first_name", "'l' AS last_name", "concat('t', id % 2) AS tags",
        "TIMESTAMP_NTZ '2023-01-01' AS created_at", UPDATED, "id AS seq")
    profile = models.customer_profile_updates(customers, ids, links, RunContext("2024-02-01 00:00:00"), "seq")
    assert not _broadcasts_with(profile, "shopify_id")
    got = {r["customer_id"]: (r["firstname"], r["shopify_tags"]) for r in profile.collect()}
    assert got == {"c0": ("f1998", '["t0","t1"]'), "c1": ("f1999", '["t0","t1"]'), "c2": ("f1997", '["t0","t1"]'), "c3": (None, None)}

    since = RunContext("2024-02-01 00:00:00", spark.sql("SELECT TIMESTAMP_NTZ '2023-06-01' AS updated_at"))
    changed = models.changed_customer_ids(customers, ids.withColumnRenamed("created_at", "updated_at"), links, since)
    assert not _broadcasts_with(changed, "shopify_id")
    assert sorted(r["customer_id"] for r in changed.collect()) == ["c0", "c1", "c2", "c3"]


def test_stored_orders_are_not_broadcast(spark, scratch):
    orders = _stored(spark, scratch, "orders", spark.range(5000).selectExpr(
        "id AS order_id", "if(id % 5 = 0, 'unknown', concat('c', id % 3)) AS customer_id", "id % 7 AS shopify_id"))
    journey = spark.range(2000).selectExpr("id AS order_id", "'s' AS shop_url", "'{}' AS customer_journey_summary",
                                           "TIMESTAMP_NTZ '2023-01-01' AS created_at", UPDATED, "id AS seq")
    mart = models.journey_mart_updates(journey, orders, RunContext("2024-02-01 00:00:00"), "seq")
    assert not _broadcasts_with(mart, "shopify_id")
    assert sorted(r["shopify_order_id"] for r in mart.collect()) == [i for i in range(2000) if i % 5]


def test_source_customers_are_not_broadcast(spark):
    """Customers grow with the input; their file of some KB would be broadcast by its size."""
    assert "Broadcast" not in _plan(fixture_inputs(spark, SF_SMALL)["customers"])

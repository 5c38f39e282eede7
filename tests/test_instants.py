"""Parsed timestamps follow the timestamp type of the mart, whatever the session's zone."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import safe_timestamp
from tidemark.operators.incremental import RunContext
from tidemark.plans import models
from tidemark.schemas import raw_journey_schema

# text, microseconds since the epoch (None: rejected)
CASES = [("2024-01-02T03:04:05Z", 1704164645000000), ("2024-01-02T03:04:05+02:00", 1704157445000000),
         ("2024-01-02 03:04:05", 1704164645000000), ("2024-01-02", 1704153600000000),
         ("2024-01-02T03:04:05.123456", 1704164645123456), ("2024-11-03 01:30:00", 1730597400000000),
         ("2024-03-31T02:30:00", 1711852200000000), ("2024-11-03T06:30:00Z", 1730615400000000),
         ("12:30", None), ("", None), ("2024-13-01", None), ("soon", None), (None, None)]


@pytest.fixture(params=["UTC", "America/New_York", "Europe/Berlin"])
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def test_instants_are_exact_in_every_zone(spark, zone):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    ts = safe_timestamp(F.col("t"), T.TimestampType())
    got = df.select("t", F.unix_micros(ts).alias("m"), ts.alias("ts"))
    assert got.schema["ts"].dataType == T.TimestampType()
    assert {r["t"]: r["m"] for r in got.collect()} == dict(CASES)


def test_wall_clock_times_are_utc_in_every_zone(spark, zone):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    ts = safe_timestamp(F.col("t"))
    got = df.select("t", ts.cast("string").alias("s"), ts.alias("ts"))
    assert got.schema["ts"].dataType == T.TimestampNTZType()
    rows = {r["t"]: r["s"] for r in got.collect()}
    assert rows["2024-11-03T06:30:00Z"] == "2024-11-03 06:30:00" and rows["2024-11-03 01:30:00"] == "2024-11-03 01:30:00"
    assert rows["2024-01-02T03:04:05+02:00"] == "2024-01-02 01:04:05" and rows["2024-03-31T02:30:00"] == "2024-03-31 02:30:00"
    assert all((rows[t] is None) == (m is None) for t, m in CASES)


@pytest.mark.parametrize("ts", [T.TimestampType(), T.TimestampNTZType()])
def test_journey_mart_has_one_timestamp_type(spark, ts):
    schema = raw_journey_schema(ts)
    doc = '{"firstVisit":{"occurredAt":"2024-01-02T03:04:05+02:00"},"last_occurred_at":"2024-01-02 03:04:05"}'
    raw = spark.range(1).select(*[F.lit({"order_id": 1, "customer_journey_summary": doc}.get(f.name)).cast(f.dataType).alias(f.name)
                                  for f in schema])
    orders = spark.createDataFrame([(1, "c", 9)], "order_id long, customer_id string, shopify_id long")
    mart = models.journey_mart_updates(raw, orders, RunContext("2024-02-01 00:00:00", ts_type=ts))
    kinds = {f.name: f.dataType for f in mart.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    assert set(kinds) == {"created_at", "updated_at", "first_occurred_at", "last_occurred_at"} and set(kinds.values()) == {ts}
    row = mart.select(F.col("first_occurred_at").cast("string").alias("a"), F.col("last_occurred_at").cast("string").alias("b")).first()
    assert tuple(row) == ("2024-01-02 01:04:05", "2024-01-02 03:04:05")

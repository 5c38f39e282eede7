"""Raw landing tables: partitions by ingest date, scans past a mark, plans."""

import contextlib
import io
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.functions.timex import ts_literal
from tidemark.operators.incremental import Landing, RunContext, incremental_filter
from tidemark.plans.queries import QUERIES
from tidemark.plans.sync import run_sync
from tidemark.schemas import MARTS, raw_customers_schema, raw_journey_schema, raw_orders_schema
from tidemark.sources.fixtures import FIXTURE_LANDING, RAW_SCHEMAS, fixture_inputs, landed_inputs
from tidemark.sources.raw import land_raw, read_raw
from tidemark.sources.snapshots import SnapshotStore


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _scan_filters(df) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*)\]", _plan(df))


@pytest.mark.parametrize("name", ["raw_customers", "raw_orders", "raw_journey"])
def test_mark_becomes_a_literal_partition_filter(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    filters = _scan_filters(df)
    # mark 2001-01-01, window 24 h, slack 24 h: 2000-12-30, in the month of December
    assert filters and all("ingest_date" in f and ">= 2000-12-01" in f for f in filters), filters
    assert "Subquery" not in _plan(df)


@pytest.mark.parametrize("name", ["identity_map_incremental", "upsert_orders", "journey_mart_incremental"])
def test_incremental_marts_prune_partitions(spark, name):
    assert any("ingest_date" in f for f in _scan_filters(QUERIES[name](spark, SF_SMALL)))


CUSTOMERS = raw_customers_schema()


def _rows(spark, rows):
    """(id, updated_at, extracted at) as raw customers."""
    df = spark.createDataFrame(rows, "id long, updated_at timestamp_ntz, _airbyte_extracted_at timestamp_ntz")
    return df.withColumn("unknown_to_the_schema", F.lit(1))


@pytest.mark.parametrize("grain", ["day", "week", "month", "year"])
def test_pruning_loses_no_row_that_the_filter_keeps(spark, scratch, grain):
    """Rows around the mark at every distance, ingested up to the slack before or long after their own time."""
    start = datetime(2023, 12, 25)
    rows = []
    for h in range(0, 24 * 14, 7):
        own = start + timedelta(hours=h)
        for late in (-24, -1, 0, 30, 24 * 40):
            rows.append((len(rows), own, own + timedelta(hours=late)))
    rows += [(-1, None, start), (-2, start, None), (-3, None, None)]
    landing = Landing(grain=grain)
    land_raw(_rows(spark, rows), f"{scratch}/t", CUSTOMERS, "_airbyte_extracted_at", landing)
    raw = read_raw(spark, f"{scratch}/t", CUSTOMERS, landing=landing)
    assert raw.columns == [*CUSTOMERS.fieldNames(), "ingest_date"] and raw.count() == len(rows)
    target = spark.createDataFrame([(datetime(2024, 1, 2),)], "updated_at timestamp_ntz")
    got = {r["id"] for r in incremental_filter(raw, "updated_at", RunContext("2024-02-01 00:00:00", target, landing=landing)).collect()}
    assert got == {i for i, own, _ in rows if own is not None and own > datetime(2024, 1, 1) and i >= 0}


def test_batches_append_and_a_wrong_type_raises(spark, scratch):
    at = datetime(2024, 1, 1)
    for i in (1, 2):
        land_raw(_rows(spark, [(i, at, at)]), f"{scratch}/t", CUSTOMERS, "_airbyte_extracted_at")
    land_raw(_rows(spark, []), f"{scratch}/t", CUSTOMERS, "_airbyte_extracted_at")
    rows = read_raw(spark, f"{scratch}/t", CUSTOMERS, landing=Landing()).collect()
    assert sorted(r["id"] for r in rows) == [1, 2] and all(str(r["ingest_date"]) == "2024-01-01" for r in rows)
    bad = _rows(spark, [(1, at, at)]).withColumn("id", F.lit("x"))
    with pytest.raises(Exception, match="(?i)type|cast"):
        land_raw(bad, f"{scratch}/u", CUSTOMERS, "_airbyte_extracted_at")


def test_a_hot_date_is_split(spark, scratch):
    """A backfill of one date is written by several tasks."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("email"), at.alias("updated_at"),
                                     at.alias("_airbyte_extracted_at"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        land_raw(df, f"{scratch}/t", CUSTOMERS, "_airbyte_extracted_at")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    raw = read_raw(spark, f"{scratch}/t", CUSTOMERS, landing=Landing())
    assert raw.count() == 200_000 and len(raw.inputFiles()) > 1


def test_run_sync_from_landing_tables(spark, scratch):
    """Two written runs from landing tables, with pruning, hold what runs over the plain frames hold."""
    before = F.col("updated_at") < ts_literal("2001-01-01 00:00:00")
    plain, landed = fixture_inputs(spark, SF_SMALL), landed_inputs(spark, SF_SMALL, f"{scratch}/raw")
    args = {"extracted_col": "extract_seq", "customer_tiebreak": "extract_seq", "bucketed": False}
    for root, tables, landing in (("a", plain, None), ("b", landed, FIXTURE_LANDING)):
        for now, keep in (("2001-01-01 00:00:00", before), ("2002-01-01 00:00:00", F.lit(True))):
            run_sync(spark, {n: tables[n].filter(keep) for n in RAW_SCHEMAS}, f"{scratch}/{root}", now, landing=landing, **args)
    a, b = SnapshotStore(spark, f"{scratch}/a"), SnapshotStore(spark, f"{scratch}/b")
    for spec in MARTS:
        one, two = a.read(spec.name), b.read(spec.name)
        assert one.count() > 0 and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_raw_schemas_fit_the_fixtures(spark):
    for name, schema in (("customers", raw_customers_schema), ("orders", raw_orders_schema), ("journey", raw_journey_schema)):
        df = fixture_inputs(spark, SF_SMALL)[name]
        want = schema(extracted_col="extract_seq", extracted_type=df.schema["extract_seq"].dataType)
        assert {(f.name, f.dataType) for f in df.schema} == {(f.name, f.dataType) for f in want}

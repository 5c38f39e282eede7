"""The merge in one pass: guard on keys, carried columns, recorded marks, plans on stored runs."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from tidemark.functions.timex import ts_literal
from tidemark.operators.incremental import RunContext, fresh_versions
from tidemark.operators.upsert import upsert
from tidemark.plans.marts import recorded_marks
from tidemark.plans.queries import QUERIES, stored_runs, two_runs
from tidemark.plans.sync import run_sync, snapshot_facts
from tidemark.schemas import IDENTITY_MAP, MARTS, ORDERS
from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, fixture_inputs
from tidemark.sources.snapshots import SnapshotStore

ROWS = "k1 string, k2 bigint, v string, state string, created_at string"


def tree(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


@pytest.mark.parametrize("bad", [("a", 1, "again", "s", "t"), (None, 1, "x", "s", "t"), ("a", None, "x", "s", "t")])
@pytest.mark.parametrize("first_run", [True, False])
def test_upsert_refuses_duplicate_and_null_keys(spark, bad, first_run):
    good = [("a", 1, "x", "s", "t"), ("b", 1, "y", "s", "t")]
    target = None if first_run else spark.createDataFrame(good, ROWS)
    assert upsert(target, spark.createDataFrame(good, ROWS), ["k1", "k2"]).count() == 2
    merged = upsert(target, spark.createDataFrame([*good, bad], ROWS), ["k1", "k2"])
    for read in (merged.count, merged.select("v").collect):
        with pytest.raises(PySparkException, match="duplicate or NULL merge key"):
            read()


def test_carried_and_excluded_columns(spark):
    target = spark.createDataFrame([("a", 1, "old", "S", "c1"), ("b", 2, "old", None, None), ("c", 3, "old", "S3", "c3")], ROWS)
    updates = spark.createDataFrame([("a", 1, "new", "{}", "n"), ("b", 2, None, "{}", "n"), ("d", 4, "new", "{}", "n")], ROWS)
    got = {r["k1"]: tuple(r)[2:] for r in upsert(target, updates, ["k1", "k2"], carry=["state"]).collect()}
    assert got == {"a": ("new", "S", "c1"), "b": (None, "{}", None), "c": ("old", "S3", "c3"), "d": ("new", "{}", "n")}


def test_a_merge_joins_its_target_once(spark):
    """One full outer join reads the stored target; no other join does, and the mark is a literal."""
    r2 = two_runs(spark, SF_SMALL)[1]
    for spec in MARTS:
        plan = tree(r2[spec.name])
        assert plan.count("FullOuter") == 1 and "Subquery" not in plan, spec.name


def test_facts_are_those_of_the_written_mart(spark):
    store, r1, _ = stored_runs(spark, SF_SMALL)
    for spec in MARTS:
        table = r1[spec.name]
        facts = store.facts(spec.name, 1)
        assert facts["rows"] == table.count() and facts["checked"] is True
        top = table.agg(F.max("updated_at")).first()[0]
        literal = spark.range(1).select(recorded_marks(facts)["updated_at"]).first()[0]
        assert top == literal == dt.datetime(2001, 1, 1)
    zoned = spark.createDataFrame([(dt.datetime(2024, 3, 5, 1, 2, 3, 456),)], T.StructType([T.StructField("updated_at", T.TimestampType())]))
    facts = snapshot_facts(zoned, False)
    assert spark.range(1).select(recorded_marks(facts)["updated_at"]).first()[0] == zoned.first()[0]
    assert snapshot_facts(zoned.limit(0), False) == {"rows": 0, "checked": False, "maxima": {}}


def test_unchecked_run_cannot_commit_doubled_rows(spark, scratch, monkeypatch):
    from tidemark.plans import models
    real = models.orders_mart_updates
    monkeypatch.setattr(models, "orders_mart_updates", lambda *a: real(*a).unionByName(real(*a)))
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    with pytest.raises(PySparkException, match="duplicate or NULL merge key"):
        run_sync(spark, run1, scratch, "2001-01-01 00:00:00", check=False, bucketed=False, extracted_col=FIXTURE_EXTRACTED_COL)
    store = SnapshotStore(spark, scratch)
    assert store.current_version(ORDERS.name) is None
    assert store.facts(IDENTITY_MAP.name)["checked"] is False   # what a later run goes by


def test_ingestion_time_as_watermark_column(spark):
    """A row that arrives late, but is dated long ago, counts; the latest version is still the one by updated_at."""
    rows = [(1, "2000-01-01", "2001-05-01"), (1, "2000-06-01", "2000-06-01"), (2, "2000-07-01", "2000-07-01"), (3, None, "2001-05-01")]
    df = spark.createDataFrame(rows, "id bigint, updated_at string, ingested string").select(
        "id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("updated_at", "ingested")])
    target = spark.createDataFrame([(dt.datetime(2001, 1, 1),)], "updated_at timestamp_ntz")
    by_date = fresh_versions(df, "id", RunContext("2002-01-01 00:00:00", target))
    assert by_date.count() == 0
    by_arrival = fresh_versions(df, "id", RunContext("2002-01-01 00:00:00", target, source_ts="ingested")).collect()
    assert sorted((r["id"], str(r["updated_at"])) for r in by_arrival) == [
        (1, "2000-01-01 00:00:00"), (1, "2000-06-01 00:00:00"), (3, "None")]


def test_incremental_profile_reads_few_tables(spark):
    plan = tree(QUERIES["customer_profile_incremental"](spark, SF_SMALL))
    assert plan.count("Scan parquet") < 40


def test_summary_counts_committed_files(spark):
    got = {(r["mart"], r["run"]): r["row_count"] for r in QUERIES["run_sync_summary"](spark, SF_SMALL).collect()}
    store = stored_runs(spark, SF_SMALL)[0]
    assert len(got) == 12 and all(store.facts(m, run)["rows"] == n for (m, run), n in got.items())

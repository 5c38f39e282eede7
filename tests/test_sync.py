"""Snapshot store and the written two-run sync."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.functions.timex import ts_literal
from tidemark.plans.sync import MartCheckError, run_sync, validate
from tidemark.schemas import IDENTITY_MAP, MARTS, ORDERS
from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, fixture_inputs
from tidemark.sources.snapshots import SnapshotStore


def _sync(spark, inputs, wh, now, **kw):
    return run_sync(spark, inputs, wh, now, extracted_col=FIXTURE_EXTRACTED_COL,
                    customer_tiebreak=FIXTURE_EXTRACTED_COL, **kw)


def test_two_run_sync_writes_and_commits(spark, scratch):
    base = fixture_inputs(spark, SF_SMALL)
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    v1 = _sync(spark, run1, scratch, "2001-01-01 00:00:00")
    assert v1 == {s.name: 1 for s in MARTS}
    v2 = _sync(spark, base, scratch, "2002-01-01 00:00:00")
    assert v2 == {s.name: 2 for s in MARTS}
    store = SnapshotStore(spark, scratch)
    old = store.read(ORDERS.name, version=1)
    new = store.read(ORDERS.name)
    assert new.count() >= old.count() > 0
    kept = old.select("order_id", F.col("created_at").alias("c1")).join(new.select("order_id", "created_at"), "order_id")
    assert kept.filter(F.col("c1") != F.col("created_at")).count() == 0
    assert store.prune(ORDERS.name, keep=1) == [1] and store.versions(ORDERS.name) == [2]


def test_failed_check_does_not_commit(spark, scratch):
    store = SnapshotStore(spark, scratch)
    good = spark.createDataFrame([("a", "", "x")], "email string, phone string, customer_id string")
    v = store.write(IDENTITY_MAP.name, good)
    store.commit(IDENTITY_MAP.name, v)
    bad = good.unionByName(good)
    assert validate(IDENTITY_MAP, store.read(IDENTITY_MAP.name)) == []
    problems = validate(IDENTITY_MAP, bad)
    assert problems and "duplicate" in problems[0]
    v2 = store.write(IDENTITY_MAP.name, bad)
    assert v2 == 2 and store.current_version(IDENTITY_MAP.name) == 1


def test_run_with_a_failing_check_stops_before_its_commit(spark, scratch, monkeypatch):
    from tidemark.plans import sync
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    real = sync.validate
    monkeypatch.setattr(sync, "validate", lambda spec, table: (
        [f"{spec.name}: unique(order_id) failed for 1"] if spec.name == ORDERS.name else real(spec, table)))
    with pytest.raises(MartCheckError, match="unique"):
        _sync(spark, run1, scratch, "2001-01-01 00:00:00")
    store = SnapshotStore(spark, scratch)
    assert store.current_version(ORDERS.name) is None and store.current_version(IDENTITY_MAP.name) == 1


def test_validate_reports_null_non_key_column(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "c", 6)], "order_id bigint, customer_id string, shopify_id bigint")
    problems = validate(ORDERS, df)
    assert problems == ["dwd_orders: not_null(customer_id) failed for 1"]


def test_interrupted_run_keeps_previous_versions_and_rerun_completes(spark, scratch, monkeypatch):
    from tidemark.schemas import SHOP_MAP, CUSTOMER
    base = fixture_inputs(spark, SF_SMALL)
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    _sync(spark, run1, scratch, "2001-01-01 00:00:00")
    store = SnapshotStore(spark, scratch)
    real_commit = SnapshotStore.commit

    def failing_commit(self, name, version):
        if name == SHOP_MAP.name:
            raise RuntimeError("executor lost while committing")
        return real_commit(self, name, version)

    monkeypatch.setattr(SnapshotStore, "commit", failing_commit)
    with pytest.raises(RuntimeError):
        _sync(spark, base, scratch, "2002-01-01 00:00:00")
    assert store.current_version(IDENTITY_MAP.name) == 2          # finished before the failure
    assert store.current_version(SHOP_MAP.name) == 1              # written, never committed
    assert store.current_version(CUSTOMER.name) == 1              # never built
    monkeypatch.setattr(SnapshotStore, "commit", real_commit)
    versions = _sync(spark, base, scratch, "2002-01-01 00:00:00")
    assert versions[SHOP_MAP.name] == 3 and store.current_version(SHOP_MAP.name) == 3
    assert validate(SHOP_MAP, store.read(SHOP_MAP.name)) == []


def test_bucketed_target_is_not_reshuffled_by_the_merge(spark, scratch):
    import contextlib
    import io

    from tidemark.plans.marts import SyncOptions, build_all
    from tidemark.schemas import ID_REGISTRY

    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    _sync(spark, run1, scratch, "2001-01-01 00:00:00")
    store = SnapshotStore(spark, scratch)
    opts = SyncOptions(now="2002-01-01 00:00:00", extracted_col=FIXTURE_EXTRACTED_COL,
                       snapshot_keys_checked=True)
    marts = build_all(fixture_inputs(spark, SF_SMALL),
                      lambda s: store.read(s.name, bucket_keys=list(s.keys)), opts)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        marts[ID_REGISTRY.name].explain("formatted")
    tree = buf.getvalue().split("\n\n")[0].splitlines()
    scan = next(i for i, line in enumerate(tree) if f"{ID_REGISTRY.name}_v000001" in line)
    merge = max(i for i, line in enumerate(tree[:scan]) if "SortMergeJoin FullOuter" in line)
    assert not any("Exchange" in line for line in tree[merge:scan])


def test_full_refresh_rebuilds_from_scratch(spark, scratch):
    import datetime as dt
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    _sync(spark, run1, scratch, "2001-01-01 00:00:00")
    versions = _sync(spark, fixture_inputs(spark, SF_SMALL), scratch, "2002-01-01 00:00:00", full_refresh=True)
    assert set(versions.values()) == {2}
    store = SnapshotStore(spark, scratch)
    created = {r[0] for r in store.read(IDENTITY_MAP.name).select("created_at").distinct().collect()}
    assert created == {dt.datetime(2002, 1, 1)}   # nothing carried over from run 1


def test_changed_keys_are_worked_out_once(spark):
    """The incremental profile reads a stored key set: one aggregate makes it, none of its inputs is in the plan."""
    import contextlib
    import io
    from tidemark.plans.queries import QUERIES
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["customer_profile_incremental"](spark, SF_SMALL).explain("formatted")
    plan = buf.getvalue()
    assert "_staged" in plan and plan.count("Union") == 0      # the union of the three key sources was run already
    semi = plan.count("LeftSemi")
    assert semi >= 3                                           # identities, links and raw rows


def test_staged_tables_are_dropped_after_the_commit(spark, scratch):
    store = SnapshotStore(spark, scratch)
    kept = store.stage("keys", spark.range(5).selectExpr("id AS k"))
    again = store.stage("keys", spark.range(3).selectExpr("id AS k"))
    assert kept.count() == 5 and again.count() == 3 and kept.columns == ["k"]
    import os
    store.drop_staged()
    assert not [f for _, _, files in os.walk(f"{scratch}/_staged") for f in files]
    base = fixture_inputs(spark, SF_SMALL)
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    for inputs, now in ((run1, "2001-01-01 00:00:00"), (base, "2002-01-01 00:00:00")):
        _sync(spark, inputs, f"{scratch}/wh", now)
    assert os.path.isdir(f"{scratch}/wh/_staged")              # run 2 staged its key set
    assert not [f for _, _, files in os.walk(f"{scratch}/wh/_staged") for f in files]

"""High-water semantics on two runs (FIXTURES section 3): boundary, late and NULL rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.functions.timex import ts_literal
from tidemark.plans.marts import SyncOptions, build_all
from tidemark.schemas import IDENTITY_MAP, ORDERS
from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, fixture_inputs

D = dt.datetime
CASES = {  # email -> updated_at of the hand-added run-2 row
    "late@x": D(2000, 6, 1), "boundary@x": D(2000, 12, 31), "inside@x": D(2000, 12, 31, 12),
    "nullts@x": None,
}


def _opts(now):
    return SyncOptions(now=now, extracted_col=FIXTURE_EXTRACTED_COL, customer_tiebreak=FIXTURE_EXTRACTED_COL)


def _with_extra_rows(spark, inputs):
    cust = inputs["customers"]
    extra = spark.createDataFrame(
        [(9_000_000 + i, e, None, None, None, None, None, None, ts, ts, -1) for i, (e, ts) in enumerate(CASES.items())],
        cust.schema)
    return dict(inputs, customers=cust.unionByName(extra))


def _runs(spark):
    base = fixture_inputs(spark, SF_SMALL)
    run1 = fixture_inputs(spark, SF_SMALL, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    r1 = build_all(run1, lambda s: None, _opts("2001-01-01 00:00:00"))
    run2 = _with_extra_rows(spark, base)
    r2 = build_all(run2, lambda s: r1[s.name], _opts("2002-01-01 00:00:00"))
    full = build_all(run2, lambda s: None, _opts("2002-01-01 00:00:00"))
    return r1, r2, full


@pytest.fixture(scope="module")
def runs(spark):
    return _runs(spark)


def test_window_boundary_late_and_null_rows(runs):
    r1, r2, full = runs
    got = {r.email for r in r2[IDENTITY_MAP.name].filter(F.col("email").endswith("@x")).collect()}
    assert got == {"inside@x"}                    # late, boundary (strict >) and NULL skipped
    got_full = {r.email for r in full[IDENTITY_MAP.name].filter(F.col("email").endswith("@x")).collect()}
    assert got_full == set(CASES)                 # a full run loads them all


def test_created_at_and_ids_survive_run_two(runs):
    r1, r2, _ = runs
    a = {(r.email, r.phone): (r.customer_id, r.created_at) for r in r1[IDENTITY_MAP.name].collect()}
    b = {(r.email, r.phone): (r.customer_id, r.created_at, r.updated_at) for r in r2[IDENTITY_MAP.name].collect()}
    assert set(a) <= set(b)
    for k, (cid, created) in a.items():
        assert b[k][0] == cid and b[k][1] == created
    o1 = {r.order_id: r.created_at for r in r1[ORDERS.name].select("order_id", "created_at").collect()}
    o2 = {r.order_id: (r.created_at, r.updated_at) for r in r2[ORDERS.name].select("order_id", "created_at", "updated_at").collect()}
    assert all(o2[k][0] == v for k, v in o1.items())
    assert any(u == D(2002, 1, 1) for _, u in o2.values()) and any(u == D(2001, 1, 1) for _, u in o2.values())


def test_determinism(spark, runs):
    _, a, _ = runs
    _, b, _ = _runs(spark)
    for name in a:
        assert a[name].exceptAll(b[name]).count() == 0 and b[name].exceptAll(a[name]).count() == 0

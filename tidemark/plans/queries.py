"""Registered queries: each runs one operator or model over the driver tables.

Inputs are the raw-shaped frames derived from ``orders`` and ``customer``
(:mod:`tidemark.sources.fixtures`) and the ``events`` table. Incremental
queries read these rows from raw landing tables partitioned by ingest date; they have run 1 (rows before 2001-01-01, run time 2001-01-01) and what they need
of run 2 (all rows, run time 2002-01-01) written as ``run_sync`` does, once a session,
and plan their mart's run 2 on the stored tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import safe_bigint
from tidemark.functions.jsonx import json_scalar, parse_doc
from tidemark.functions.timex import ts_literal
from tidemark.operators.checks import check_summary, not_null, unique, unique_combo
from tidemark.operators.incremental import RunContext, incremental_filter
from tidemark.operators.upsert import upsert
from tidemark.plans import models
from tidemark.plans.marts import LazyTables, SyncOptions, build_all, dedupe_snapshot, recorded_marks
from tidemark.plans.sync import written_marts
from tidemark.schemas import CUSTOMER, ID_REGISTRY, IDENTITY_MAP, JOURNEY, MARTS, ORDERS, SHOP_MAP, MartSpec
from tidemark.session import scratch_dir
from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, FIXTURE_LANDING, fixture_inputs, landed_inputs
from tidemark.sources.snapshots import SnapshotStore

RUN1_NOW = "2001-01-01 00:00:00"
RUN2_NOW = "2002-01-01 00:00:00"
RUN1_CUTOFF = "2001-01-01 00:00:00"
STORED_PAIRS_PER_TASK = 1_000      # small, so that the given tables have hot contacts at every size
EVENTS_FIRST_LOAD_BEFORE = "2024-01-20 00:00:00"


def _opts(now: str) -> SyncOptions:
    return SyncOptions(now=now, extracted_col=FIXTURE_EXTRACTED_COL,
                       customer_tiebreak=FIXTURE_EXTRACTED_COL, landing=FIXTURE_LANDING)


def _inputs(spark: SparkSession, sf_dir: str):
    """Raw inputs, derived in the plan: all rows."""
    return fixture_inputs(spark, sf_dir)


_LANDED: dict[tuple[str, str], Mapping[str, DataFrame]] = {}


def landed(spark: SparkSession, sf_dir: str, run: int = 2) -> Mapping[str, DataFrame]:
    """Scans of the raw landing tables, written once a session: run 1 sees rows before the cut-off, run 2 all."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        _LANDED[key] = landed_inputs(spark, sf_dir, f"{scratch_dir(spark)}/landing/{uuid.uuid4().hex}")
    tables = _LANDED[key]
    if run == 2:
        return tables

    def before(name):
        return lambda: tables[name].filter(F.col("updated_at") < ts_literal(RUN1_CUTOFF))
    return LazyTables({name: before(name) for name in tables})


def full_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """First (full-refresh) build over all rows at the run-2 time."""
    return build_all(_inputs(spark, sf_dir), lambda spec: None, _opts(RUN2_NOW))


_STORED: dict[tuple[str, str, bool], tuple[SnapshotStore, Mapping[str, DataFrame], Mapping[str, DataFrame]]] = {}


def stored_runs(spark: SparkSession, sf_dir: str, late: bool = False) -> tuple[SnapshotStore, Mapping[str, DataFrame], Mapping[str, DataFrame]]:
    """The store of a session and input, and the marts of runs 1 and 2 in it.

    They are written, checked and committed as ``run_sync`` does (plain, not bucketed), each mart once,
    when a query first asks for it. ``late``: in run 1 every fourth shop customer is yet to arrive.
    """
    key = (spark.sparkContext.applicationId, sf_dir, late)
    if key not in _STORED:
        store = SnapshotStore(spark, f"{scratch_dir(spark)}/runs/{uuid.uuid4().hex}")
        first = landed(spark, sf_dir, 1)
        if late:
            first = {**first, "customers": first["customers"].filter(F.col("id") % 4 != 0)}
        r1 = written_marts(store, first, replace(_opts(RUN1_NOW), pairs_per_task=STORED_PAIRS_PER_TASK), bucketed=False, current=lambda spec: None)
        r2 = written_marts(store, landed(spark, sf_dir), _on_run1(store), bucketed=False,
                           current=lambda spec: r1[spec.name])
        _STORED[key] = store, r1, r2
    return _STORED[key]


def _on_run1(store: SnapshotStore) -> SyncOptions:
    return replace(_opts(RUN2_NOW), pairs_per_task=STORED_PAIRS_PER_TASK, facts=lambda spec: store.facts(spec.name, 1))


def q_orders_late_resolution(spark, sf_dir):
    """H10, opted in: orders of run 1 whose customer was yet to arrive get it when run 2 links the shop id."""
    store, r1, r2 = stored_runs(spark, sf_dir, late=True)
    return build_all(landed(spark, sf_dir), lambda spec: r1[spec.name], replace(_on_run1(store), resolve_late=True),
                     upstream=lambda spec: r2[spec.name])[ORDERS.name]


def two_runs(spark: SparkSession, sf_dir: str) -> tuple[Mapping[str, DataFrame], Mapping[str, DataFrame]]:
    """Run 1 as stored, and the plans of run 2: each mart merges into its stored run 1, from the raw
    inputs and the stored run-2 tables of the marts before it."""
    store, r1, r2 = stored_runs(spark, sf_dir)
    return r1, build_all(landed(spark, sf_dir), lambda spec: r1[spec.name], _on_run1(store),
                         upstream=lambda spec: r2[spec.name], stage=SnapshotStore(spark, store.root).stage)


def _orders_latest(spark, sf_dir):
    return models.orders_latest(_inputs(spark, sf_dir)["orders"], FIXTURE_EXTRACTED_COL)


def _journey_latest(spark, sf_dir):
    return models.journey_latest(_inputs(spark, sf_dir)["journey"], FIXTURE_EXTRACTED_COL)


# ------------------------------------------------------------------ raw scans

def _raw_since(table: str, spec: MartSpec):
    """The raw rows that an incremental run of ``spec`` reads, all columns: one landing table past the mark
    that was recorded with the mart's run 1, partitions before it left unopened."""
    def q(spark, sf_dir):
        store, r1, _ = stored_runs(spark, sf_dir)
        ctx = RunContext(RUN2_NOW, r1[spec.name], marks=recorded_marks(store.facts(spec.name, 1)), landing=FIXTURE_LANDING)
        return incremental_filter(landed(spark, sf_dir)[table], "updated_at", ctx).drop(FIXTURE_LANDING.column)
    return q


# ------------------------------------------------------------------ views and operators

def q_contact_pairs(spark, sf_dir):
    return models.contact_pairs(_inputs(spark, sf_dir)["customers"])


def q_orders_latest(spark, sf_dir):
    return _orders_latest(spark, sf_dir)


def q_journey_latest(spark, sf_dir):
    return _journey_latest(spark, sf_dir)


def q_shop_links(spark, sf_dir):
    run = full_run(spark, sf_dir)
    return models.shop_links(_inputs(spark, sf_dir)["customers"], run[IDENTITY_MAP.name])


def q_shop_latest_customer(spark, sf_dir):
    return models.shop_latest_customer(full_run(spark, sf_dir)[SHOP_MAP.name])


def _raw_orders_doc(spark, sf_dir):
    o = _inputs(spark, sf_dir)["orders"]
    return o.select(F.col("id").alias("order_id"), FIXTURE_EXTRACTED_COL, "line_items", "shipping_lines",
                    parse_doc("line_items").alias("_li"), parse_doc("shipping_lines").alias("_sl"))


def q_line_item_skus(spark, sf_dir):
    return _raw_orders_doc(spark, sf_dir).select(
        "order_id", FIXTURE_EXTRACTED_COL, models.line_item_skus(F.col("line_items"), F.col("_li")).alias("sku"))


def q_line_item_products(spark, sf_dir):
    return _raw_orders_doc(spark, sf_dir).select(
        "order_id", FIXTURE_EXTRACTED_COL,
        models.line_item_products(F.col("line_items"), F.col("_li")).alias("shopify_product_id"))


def q_shipping_totals(spark, sf_dir):
    return _raw_orders_doc(spark, sf_dir).select(
        "order_id", FIXTURE_EXTRACTED_COL, models.shipping_total(F.col("shipping_lines"), F.col("_sl")).alias("shipping_price"))


def q_journey_moments(spark, sf_dir):
    rec = models.journey_record("customer_journey_summary")
    jl = _journey_latest(spark, sf_dir).select(
        "shopify_order_id", "customer_journey_summary", rec.struct().alias("_rec"))
    fields = models.journey_fields(rec.bind("_rec"))
    return jl.select("shopify_order_id", fields["moments"].alias("moments"),
                     fields["moments_count"].alias("moments_count"))


def q_json_scalar_events(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return ev.select("event_id", "event_type",
                     safe_bigint(json_scalar(parse_doc("props"), "$.k")).alias("k"))


def q_high_water_filter(spark, sf_dir):
    """Latest orders newer than the run-1 orders mart's mark (run-2 time window)."""
    ctx = RunContext(RUN2_NOW, stored_runs(spark, sf_dir)[1][ORDERS.name])
    return incremental_filter(_orders_latest(spark, sf_dir), "updated_at", ctx).select(
        "order_id", "updated_at")


def q_high_water_events(spark, sf_dir):
    """I1 on another column: events after (last loaded event time - 24 h)."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    loaded = ev.filter(F.col("ts") < ts_literal(EVENTS_FIRST_LOAD_BEFORE))
    ctx = RunContext(RUN2_NOW, loaded)
    return incremental_filter(ev, "ts", ctx, target_col="ts").select("event_id", "ts", "event_type")


# ------------------------------------------------------------------ marts

def _mart(name, which):
    def q(spark, sf_dir):
        if which == "full":
            return full_run(spark, sf_dir)[name]
        return two_runs(spark, sf_dir)[1][name]
    return q


def q_changed_customers(spark, sf_dir):
    r1, r2 = two_runs(spark, sf_dir)
    ctx = RunContext(RUN2_NOW, r1[CUSTOMER.name])
    return models.changed_customer_ids(_inputs(spark, sf_dir)["customers"], r2[IDENTITY_MAP.name],
                                       r2[SHOP_MAP.name], ctx)


def q_schema_sync(spark, sf_dir):
    """M3: merge run-2 order updates into a run-1 orders mart whose schema drifted
    (``note`` missing, an obsolete ``legacy_channel`` present)."""
    r1, r2 = two_runs(spark, sf_dir)
    ctx = RunContext(RUN2_NOW, r1[ORDERS.name])
    updates = models.orders_mart_updates(_inputs(spark, sf_dir)["orders"], r2[SHOP_MAP.name], ctx,
                                         FIXTURE_EXTRACTED_COL)
    drifted = r1[ORDERS.name].drop("note").withColumn("legacy_channel", F.lit("web"))
    return upsert(drifted, updates, ORDERS.keys, ORDERS.exclude_on_update)


def _both_runs(spark, sf_dir, name):
    r1, r2 = two_runs(spark, sf_dir)
    return r1[name].unionByName(r2[name])


def q_dedupe_contact_map(spark, sf_dir):
    return dedupe_snapshot(IDENTITY_MAP, _both_runs(spark, sf_dir, IDENTITY_MAP.name))


def q_dedupe_id(spark, sf_dir):
    return dedupe_snapshot(ID_REGISTRY, _both_runs(spark, sf_dir, ID_REGISTRY.name))


def q_dedupe_shop_map(spark, sf_dir):
    return dedupe_snapshot(SHOP_MAP, _both_runs(spark, sf_dir, SHOP_MAP.name))


def q_check_not_null(spark, sf_dir):
    return not_null(_orders_latest(spark, sf_dir), "shopify_id").select("order_id", "updated_at")


def q_check_unique(spark, sf_dir):
    return unique(_both_runs(spark, sf_dir, ID_REGISTRY.name), "customer_id")


def q_check_unique_combo(spark, sf_dir):
    return unique_combo(_both_runs(spark, sf_dir, IDENTITY_MAP.name), ["email", "phone"],
                        normalise=["email", "phone"])


def q_mart_checks(spark, sf_dir):
    """Q1/Q2 on every mart of run 2, one aggregate pass per table."""
    r2 = two_runs(spark, sf_dir)[1]
    parts = [check_summary(r2[s.name], s.name, s.not_null, s.unique) for s in MARTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_run_sync_summary(spark, sf_dir):
    """Rows of every mart after each of two written runs, counted in the committed files."""
    parts = []
    for run, marts in enumerate(stored_runs(spark, sf_dir)[1:], 1):
        for name in marts:
            parts.append(marts[name].agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("mart"), F.lit(run).alias("run"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "raw_customers": _raw_since("customers", IDENTITY_MAP),
    "raw_orders": _raw_since("orders", ORDERS),
    "raw_journey": _raw_since("journey", JOURNEY),
    "contact_pairs": q_contact_pairs,
    "orders_latest": q_orders_latest,
    "journey_latest": q_journey_latest,
    "identity_map_full": _mart(IDENTITY_MAP.name, "full"),
    "identity_map_incremental": _mart(IDENTITY_MAP.name, "incremental"),
    "id_registry": _mart(ID_REGISTRY.name, "full"),
    "id_registry_incremental": _mart(ID_REGISTRY.name, "incremental"),
    "shop_links": q_shop_links,
    "shop_map": _mart(SHOP_MAP.name, "full"),
    "shop_map_incremental": _mart(SHOP_MAP.name, "incremental"),
    "changed_customers": q_changed_customers,
    "customer_profile": _mart(CUSTOMER.name, "full"),
    "customer_profile_incremental": _mart(CUSTOMER.name, "incremental"),
    "shop_latest_customer": q_shop_latest_customer,
    "orders_mart": _mart(ORDERS.name, "full"),
    "orders_late_resolution": q_orders_late_resolution,
    "upsert_orders": _mart(ORDERS.name, "incremental"),
    "line_item_skus": q_line_item_skus,
    "line_item_products": q_line_item_products,
    "shipping_totals": q_shipping_totals,
    "journey_mart": _mart(JOURNEY.name, "full"),
    "journey_mart_incremental": _mart(JOURNEY.name, "incremental"),
    "journey_moments": q_journey_moments,
    "high_water_filter": q_high_water_filter,
    "high_water_events": q_high_water_events,
    "schema_sync": q_schema_sync,
    "dedupe_id": q_dedupe_id,
    "dedupe_shop_map": q_dedupe_shop_map,
    "dedupe_contact_map": q_dedupe_contact_map,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_unique_combo": q_check_unique_combo,
    "mart_checks": q_mart_checks,
    "json_scalar_events": q_json_scalar_events,
    "run_sync_summary": q_run_sync_summary,
}

"""Mart materialisation: pre-merge dedupe (M2), schema sync (M3) and upsert (M1).

``build_all`` wires the six marts in dependency order. It is written once and
used two ways: lazily (every mart is a DataFrame built from the previous ones,
for tests and the oracle comparison) and by :func:`tidemark.plans.sync.run_sync`,
which writes each mart, checks it, commits it, and hands the *written* table
to the downstream marts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import SAFETY_WINDOW_HOURS, Landing, RunContext
from tidemark.operators.latest import latest_per_key
from tidemark.operators.links import HOT_SALTS
from tidemark.operators.upsert import upsert
from tidemark.plans import models
from tidemark.schemas import CUSTOMER, ID_REGISTRY, IDENTITY_MAP, JOURNEY, ORDERS, SHOP_MAP, MartSpec


def dedupe_snapshot(spec: MartSpec, df: DataFrame, keys_checked: bool = False) -> DataFrame:
    """M2 (R1-R3): keep the most recent row per key of the current snapshot.

    ``keys_checked``: the snapshot passed the commit check (no NULL merge
    keys), so NULL -> '' normalisation is a no-op and is skipped; the window
    then partitions by the stored key columns and keeps a bucketed layout.
    """
    if not spec.dedupe_order:
        return df
    if spec.dedupe_normalise and not keys_checked:
        df = df.select(*[(F.coalesce(F.col(c), F.lit("")) if c in spec.dedupe_normalise else F.col(c)).alias(c)
                         for c in df.columns])
    return latest_per_key(df, list(spec.keys), list(spec.dedupe_order))


def recorded_marks(known: Mapping) -> dict[str, Column]:
    """Literal columns of the maxima recorded with a snapshot."""
    marks = {}
    for name, mark in known.get("maxima", {}).items():
        value = F.lit(mark["value"])
        marks[name] = (F.timestamp_micros(value.cast("long")) if mark["type"] == "timestamp" else value.cast(mark["type"]))
    return marks


def merge_into(spec: MartSpec, target: DataFrame | None, updates: DataFrame) -> DataFrame:
    """M1 + M3: the mart after merging ``updates`` (target already deduped)."""
    return upsert(target, updates, spec.keys, spec.exclude_on_update, spec.carry_on_update)


Facts = Callable[[MartSpec], Mapping]


@dataclass(frozen=True)
class SyncOptions:
    now: datetime | str
    window_hours: int = SAFETY_WINDOW_HOURS
    ts_type: T.DataType = T.TimestampNTZType()
    extracted_col: str = "_airbyte_extracted_at"
    customer_tiebreak: str | None = None
    ignore_blank: bool = False
    full_refresh: bool = False
    snapshot_keys_checked: bool = False
    hot_key_salts: int = HOT_SALTS
    pairs_per_task: int | None = None   # find hot contacts from the data; None: salt '' only
    source_ts: str = "updated_at"   # column of the raw sources that the mark is compared with
    resolve_late: bool = False      # stored orders without a customer are looked up again when their shop id is linked
    landing: Landing | None = None  # how the raw sources are partitioned by ingest date
    facts: Facts | None = None      # what was recorded when a mart's current snapshot was committed


Current = Callable[[MartSpec], DataFrame | None]
Stage = Callable[[str, DataFrame], DataFrame]
Materialize = Callable[[MartSpec, DataFrame], DataFrame]


def _lazy(_spec: MartSpec, df: DataFrame) -> DataFrame:
    return df


class LazyTables(Mapping):
    """Name -> DataFrame, each built on first access (and only then).

    Building a DataFrame costs driver-side analysis even before any job runs,
    so a caller that needs one mart should not pay for the others.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_all(inputs: Mapping[str, DataFrame], current: Current, opts: SyncOptions,
              materialize: Materialize = _lazy, upstream: Current | None = None,
              stage: Stage | None = None) -> LazyTables:
    """The six marts in dependency order, as a lazy {mart name: table} mapping.

    ``inputs``: raw ``customers``, ``orders``, ``journey``. ``current(spec)``
    gives the mart's current snapshot or None. Iterating the result in order
    (as :func:`tidemark.plans.sync.run_sync` does) builds every mart. With ``upstream``, a mart
    is planned on the tables that this gives for the marts before it, instead of on their plans.
    ``stage(name, df)`` stores an intermediate table that a model reads several times.
    """
    def run(spec: MartSpec, make: Callable[[RunContext], DataFrame]) -> DataFrame:
        snapshot = None if opts.full_refresh else current(spec)
        known = opts.facts(spec) if opts.facts and snapshot is not None else {}
        target = (dedupe_snapshot(spec, snapshot, opts.snapshot_keys_checked or known.get("checked", False))
                  if snapshot is not None else None)
        ctx = RunContext(opts.now, target, opts.window_hours, opts.ts_type, recorded_marks(known), opts.source_ts,
                         opts.landing, stage)
        return materialize(spec, merge_into(spec, target, make(ctx)))

    def t(spec):
        return lambda: out[spec.name] if upstream is None else upstream(spec)

    idmap, shop, orders_mart = t(IDENTITY_MAP), t(SHOP_MAP), t(ORDERS)
    builders = {
        IDENTITY_MAP.name: lambda: run(
            IDENTITY_MAP, lambda ctx: models.identity_map_updates(inputs["customers"], ctx)),
        ID_REGISTRY.name: lambda: run(
            ID_REGISTRY, lambda ctx: models.id_registry_updates(idmap(), ctx)),
        SHOP_MAP.name: lambda: run(
            SHOP_MAP, lambda ctx: models.shop_map_updates(inputs["customers"], idmap(), ctx,
                                                          opts.ignore_blank, opts.hot_key_salts,
                                                          opts.pairs_per_task)),
        CUSTOMER.name: lambda: run(
            CUSTOMER, lambda ctx: models.customer_profile_updates(inputs["customers"], idmap(), shop(),
                                                                  ctx, opts.customer_tiebreak)),
        ORDERS.name: lambda: run(
            ORDERS, lambda ctx: models.orders_mart_updates(inputs["orders"], shop(), ctx,
                                                           opts.extracted_col, opts.resolve_late)),
        JOURNEY.name: lambda: run(
            JOURNEY, lambda ctx: models.journey_mart_updates(inputs["journey"], orders_mart(), ctx,
                                                             opts.extracted_col)),
    }
    out = LazyTables(builders)
    return out

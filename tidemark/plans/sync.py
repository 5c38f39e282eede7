"""One pipeline run: build every mart, write it, check it, commit it.

Each mart is written as a new snapshot version, its checks run on the
*written* files (only the checked columns are read), and the version is
committed only if they pass; downstream marts then read the committed files.
That keeps each job's lineage short (a lost executor recomputes from the
written upstream table, not from the raw sources). Commits are per mart: a
failed run leaves the mart that failed, and those after it, at their previous
versions; marts committed before it keep the new one, and a rerun completes.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import Landing
from tidemark.operators.links import HOT_SALTS, PAIRS_PER_TASK
from tidemark.plans.marts import Current, LazyTables, SyncOptions, build_all
from tidemark.schemas import MartSpec
from tidemark.sources.snapshots import SnapshotStore


class MartCheckError(RuntimeError):
    pass


def validate(spec: MartSpec, table: DataFrame) -> list[str]:
    """Failed checks of a written mart, from one aggregate job.

    Groups by the merge key (partial aggregation, so only distinct keys are
    shuffled) and counts NULL keys, duplicate keys and NULLs in the not-null
    columns. Unique / unique-combination checks on other columns than the
    merge key get their own group-by.
    """
    keys = list(spec.keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nn_{c}") for c in spec.not_null if c not in keys])
    totals = per_key.agg(
        F.sum(F.when(null_key, F.col("_n")).otherwise(0)).alias("null_keys"),
        F.sum(F.when(~null_key & (F.col("_n") > 1), F.col("_n") - 1).otherwise(0)).alias("duplicate_keys"),
        *[F.sum(f"_nn_{c}").alias(f"nn_{c}") for c in spec.not_null if c not in keys]).first()
    problems = []
    if totals is None:
        return problems
    if totals["null_keys"] or totals["duplicate_keys"]:
        problems.append(f"{spec.name}: {totals['null_keys']} NULL merge keys, "
                        f"{totals['duplicate_keys']} duplicate merge keys")
    for c in spec.not_null:
        if c not in keys and totals[f"nn_{c}"]:
            problems.append(f"{spec.name}: not_null({c}) failed for {totals[f'nn_{c}']}")
    extra_unique = [c for c in spec.unique if [c] != keys]
    extra_unique += [list(combo) for combo in spec.unique_combos if list(combo) != keys]
    for cols in extra_unique:
        cols = [cols] if isinstance(cols, str) else cols
        dups = table.groupBy(*cols).count().filter(F.col("count") > 1).limit(1).count()
        if dups:
            problems.append(f"{spec.name}: unique({', '.join(cols)}) failed")
    return problems


def snapshot_facts(table: DataFrame, checked: bool, mark: str = "updated_at") -> dict:
    """Rows and greatest ``mark`` of a written mart (one column is read), for its commit marker."""
    kind = table.schema[mark].dataType.simpleString()
    top = F.unix_micros(F.max(mark)) if kind == "timestamp" else F.max(mark).cast("string")
    row = table.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    maxima = {} if row["top"] is None else {mark: {"type": kind, "value": row["top"]}}
    return {"rows": row["n"], "checked": checked, "maxima": maxima}


def written_marts(store: SnapshotStore, inputs: Mapping[str, DataFrame], opts: SyncOptions, check: bool = True,
                  bucketed: bool = True, current: Current | None = None) -> LazyTables:
    """The marts of one run; a mart is written, checked and committed when it, or one after it, is first asked for.

    ``current(spec)`` gives the snapshot that a mart merges into; the store's own by default.
    """
    def keys_of(spec: MartSpec):
        return list(spec.keys) if bucketed else None

    def materialize(spec: MartSpec, df: DataFrame) -> DataFrame:
        version = store.write(spec.name, df, bucket_keys=keys_of(spec))
        written = store.read(spec.name, version=version, bucket_keys=keys_of(spec))
        if check:
            problems = validate(spec, written)
            if problems:
                raise MartCheckError("; ".join(problems))
        store.record(spec.name, version, snapshot_facts(written, check))
        store.commit(spec.name, version)
        store.drop_staged()
        return written
    return build_all(inputs, current or (lambda spec: store.read(spec.name, bucket_keys=keys_of(spec))), opts, materialize,
                     stage=store.stage)


def run_sync(spark: SparkSession, inputs: dict[str, DataFrame], warehouse: str,
             now: datetime | str, full_refresh: bool = False, window_hours: int = 24,
             ts_type: T.DataType = T.TimestampNTZType(), extracted_col: str = "_airbyte_extracted_at",
             customer_tiebreak: str | None = None, ignore_blank: bool = False,
             check: bool = True, bucketed: bool = True, buckets: int | None = None,
             hot_key_salts: int = HOT_SALTS, source_ts: str = "updated_at",
             landing: Landing | None = None, pairs_per_task: int | None = PAIRS_PER_TASK,
             resolve_late: bool = False) -> dict[str, int]:
    """Build all marts into ``warehouse``; returns {mart: committed version}.

    ``inputs`` holds the raw ``customers``, ``orders`` and ``journey`` frames.
    ``now`` is the run time stamped on every row this run touches.
    ``bucketed`` writes every mart bucketed on its merge key (``buckets``
    defaults to ``spark.sql.shuffle.partitions`` at a table's first write).
    ``pairs_per_task``: contacts with more pairs of raw and identity rows than this are
    found before the link join is planned and spread over a grid of tasks; None spreads
    only blank contacts, over ``hot_key_salts`` tasks. ``source_ts``: the
    column of the raw sources compared with a mart's high-water mark; name an
    ingestion time there to catch rows that arrive more than ``window_hours`` late. ``landing``:
    the ingest-date partitioning of raw sources read by ``read_raw(..., landing=...)``; an
    incremental run then opens only the partitions that can hold rows beyond a mart's mark.
    ``resolve_late``: stored orders without a customer are resolved when their shop id is linked
    later on (off: they wait for a new version of the order). Their journeys still wait for one.

    A mart's row count and greatest ``updated_at`` are stored with its commit marker, so
    that the next run takes its mark from there and does not scan the mart for it.
    """
    store = SnapshotStore(spark, warehouse, buckets)
    opts = SyncOptions(now=now, window_hours=window_hours, ts_type=ts_type,
                       extracted_col=extracted_col, customer_tiebreak=customer_tiebreak,
                       ignore_blank=ignore_blank, full_refresh=full_refresh,
                       hot_key_salts=hot_key_salts, pairs_per_task=pairs_per_task,
                       resolve_late=resolve_late, source_ts=source_ts, landing=landing,
                       facts=lambda spec: store.facts(spec.name))
    marts = written_marts(store, inputs, opts, check, bucketed)
    for name in marts:  # dependency order; each access writes and commits one mart
        marts[name]
    return {name: store.current_version(name) for name in marts}

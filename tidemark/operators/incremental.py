"""Incremental processing: run context, high-water filter, changed-key sets.

The high-water mark is ``coalesce(max(target.updated_at), epoch) - window``,
expressed as a scalar subquery over the target snapshot. Spark evaluates it
once, before the main scan, and pushes ``ts > mark`` into the Parquet scan.
The comparison is strict, so a NULL source timestamp never passes (H14), and
a row older than the window is skipped once a run has happened (H1).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timex import epoch, hours_before, ts_literal

SAFETY_WINDOW_HOURS = 24


@dataclass(frozen=True)
class Landing:
    """How landing tables are partitioned: by ``column``, the ingest date cut to ``grain``.

    ``slack_hours``: by how much a row's own timestamp may lie ahead of its ingest time (clocks that
    disagree, sessions in other time zones). A row newer than a mark was then ingested no earlier than
    the mark less the slack, and its partition is no earlier than that moment's: cutting dates keeps
    their order, so nothing that the row filter would keep is pruned.
    """

    column: str = "ingest_date"
    grain: str = "day"              # day, week, month, quarter or year
    slack_hours: int = 24

    def date_of(self, moment: Column) -> Column:
        return F.to_date(moment) if self.grain == "day" else F.trunc(F.to_date(moment), self.grain)

    def since(self, mark: Column) -> Column:
        """The partitions that can hold rows newer than ``mark``."""
        return F.col(self.column) >= self.date_of(hours_before(mark, self.slack_hours))


@dataclass(frozen=True)
class RunContext:
    """One build of one mart: the run time and the mart's current snapshot.

    ``target`` is None on a first (or full-refresh) run; the run is then not
    incremental and no high-water filter applies. ``marks`` holds the maxima of target columns that
    are known already (recorded when the snapshot was committed), so that the target need not be read
    for them. ``source_ts`` is the column of the raw sources that is compared with the mark; an
    ingestion time catches rows that arrive late. ``landing`` tells how the raw sources are partitioned.
    ``stage(name, df)`` writes a table that a model reads several times, and reads it back.
    """

    now: datetime | str
    target: DataFrame | None = None
    window_hours: int = SAFETY_WINDOW_HOURS
    ts_type: T.DataType = T.TimestampNTZType()
    marks: Mapping[str, Column] = field(default_factory=dict)
    source_ts: str = "updated_at"
    landing: Landing | None = None
    stage: Callable[[str, DataFrame], DataFrame] | None = None

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, written once where the run has a place for it; else its plan."""
        return df if self.stage is None else self.stage(name, df)

    @property
    def incremental(self) -> bool:
        return self.target is not None

    def now_col(self) -> Column:
        return ts_literal(self.now, self.ts_type)

    def with_target(self, target: DataFrame | None) -> RunContext:
        return replace(self, target=target)


def high_water_mark(target: DataFrame, target_col: str = "updated_at",
                    window_hours: int = SAFETY_WINDOW_HOURS) -> Column:
    """Scalar-subquery column: latest ``target_col`` minus the safety window."""
    dtype = target.schema[target_col].dataType
    latest = F.coalesce(F.max(target_col), epoch(dtype))
    return target.agg(hours_before(latest, window_hours).alias("mark")).scalar()


def incremental_filter(df: DataFrame, ts_col: str, ctx: RunContext,
                       target_col: str = "updated_at") -> DataFrame:
    """Rows of ``df`` newer than the target's high-water mark; all rows on a first run.

    A mark recorded at commit is a literal (pushed into the scan, and good for partition pruning);
    else it is a scalar subquery over the target. Where ``df`` has the ingest date of ``ctx.landing``,
    only the partitions that can hold such rows are read.
    """
    if not ctx.incremental:
        return df
    if target_col in ctx.marks:
        mark = hours_before(ctx.marks[target_col], ctx.window_hours)
    else:
        mark = high_water_mark(ctx.target, target_col, ctx.window_hours)
    kept = df.filter(F.col(ts_col) > mark)
    if ctx.landing is not None and ctx.landing.column in df.columns:
        kept = kept.filter(ctx.landing.since(mark))
    return kept


def fresh_versions(df: DataFrame, key: str, ctx: RunContext) -> DataFrame:
    """Versions of a raw source that decide the latest version of every key touched since the mark.

    By ``updated_at`` these are the rows beyond the mark: a key's latest version carries its maximum,
    so an older one below the mark can never win. By another column a late row may be older than
    versions below the mark, so all versions of the keys touched are kept.
    """
    if not ctx.incremental or ctx.source_ts == "updated_at":
        return incremental_filter(df, ctx.source_ts, ctx)
    return keep_keys(df, incremental_filter(df, ctx.source_ts, ctx).select(key).distinct(), key)


def changed_keys(key: str, *frames: DataFrame) -> DataFrame:
    """UNION DISTINCT of the ``key`` column of several frames (one aggregate, not one per arm)."""
    out = None
    for df in frames:
        part = df.select(key)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``df`` rows whose key is in ``keys`` (left semi join; never duplicates rows)."""
    return df.join(keys, on, "left_semi")

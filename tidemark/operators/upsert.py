"""Keyed upsert (merge) and schema sync for snapshot tables.

Parquet has no MERGE, so the merged table is computed and written as a new
snapshot: one full outer join of target and updates on the merge key. Matched
rows take the update's values except the excluded columns (kept from the
target); unmatched target rows are kept; unmatched updates are inserted.
Nothing is deleted. One shuffle on the key, both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sync_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: add missing columns as typed NULLs, drop extra ones."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def null_key(keys: Sequence[str]) -> Column:
    """True where a merge key is NULL in one of its columns."""
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def unique_keys(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates``; reading it raises at a NULL key, or at the second row of a key.

    The test is part of the plan, not a pass of its own: counting the rows of a key needs them dealt out
    and sorted by key, which is what the merge join needs as well. Rows that lie so already are not dealt
    or sorted again.
    """
    number, found = F.count(F.lit(1)).over(Window.partitionBy(*keys)), unused("_n", updates)
    bad = null_key(keys) | (F.col(found) > 1)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"duplicate or NULL merge key ({', '.join(keys)}): "), shown)
    return (updates.withColumn(found, number)
            .filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(found))


def unused(name: str, df: DataFrame) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
           exclude: Sequence[str] = ("created_at",), carry: Sequence[str] = ()) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``keys``; result has the schema of ``updates``.

    Matched rows keep the target's ``exclude`` columns as they are, and its ``carry`` columns where
    these are not NULL (an id once given, a state column); all other columns come from the update. So
    an update needs no look at the target: one full outer join does both. The target is first synced
    to the updates' schema (columns added to the model appear as NULL on old rows, dropped ones
    disappear). NULL keys or two updates for one key raise when the result is read.
    """
    keys = list(keys)
    updates = unique_keys(updates, keys)
    if target is None:
        return updates
    cols = [c for c in updates.columns if c not in keys]
    t = sync_schema(target, updates.schema)
    t = t.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u"))
    j = t.join(u, keys, "full_outer")
    out = []
    for c in updates.columns:
        old, new = F.col(f"_t_{c}"), F.col(f"_u_{c}")
        if c in keys:
            out.append(F.col(c))
        elif c in exclude:
            out.append(F.when(F.col("_t"), old).otherwise(new).alias(c))
        elif c in carry:
            out.append(F.coalesce(old, new).alias(c))
        else:
            out.append(F.when(F.col("_u"), new).otherwise(old).alias(c))
    return j.select(*out)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row frame: NULL-key rows and rows beyond the first per key."""
    null_any = null_key(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(null_any, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.coalesce(F.sum(F.when(~null_any & (F.col("_n") > 1), F.col("_n") - 1)), F.lit(0))
        .cast("bigint").alias("duplicate_keys"))

"""Latest row / latest value per key.

``latest_per_key`` is ``row_number() = 1`` over a key window. Catalyst turns
that filter into a partial ``WindowGroupLimit`` before the shuffle, so each map
task forwards at most one row per key: a key holding a third of the input
still ships one row per map task, not its whole group.

``latest_value`` / ``latest_non_null`` are aggregate expressions built on
``max(struct(order..., value))``: they combine map-side (partial aggregation)
and are associative, so per-group partial results can be merged again after a
join (the customer profile relies on that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HOT_VERSIONS = 1_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_per_key(df: DataFrame, keys: Sequence, order: Sequence, rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (columns sort DESC, NULLs last)."""
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(
        *[_c(o).desc_nulls_last() for o in order])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def latest_version(df: DataFrame, key: str, order: Sequence[str], hot_versions: int = HOT_VERSIONS) -> DataFrame:
    """:func:`latest_per_key` of wide rows with a key that is not NULL; ``df`` is read twice.

    Of the versions that :func:`newest_versions` leaves to a key one stays.
    """
    newest = newest_versions(df, key, order, hot_versions).withColumn("_id", F.monotonically_increasing_id())
    # Without an order of its own: the rows lie sorted by key already, and are not sorted again.
    first = F.min("_id").over(Window.partitionBy(key))
    return newest.withColumn("_first", first).filter("_id = _first").drop("_id", "_first")


def newest_versions(df: DataFrame, key: str, order: Sequence[str], hot_versions: int = HOT_VERSIONS) -> DataFrame:
    """The rows with the greatest ``order`` of their key: one a key, or several alike in all order columns.

    The order columns alone tell the latest version of a key. The wide rows are then dealt out by key once and
    meet it there: the narrow side is held in memory and the wide rows pass by, so that only the rows kept are
    sorted by what comes after, and no wide row before the shuffle. Keys of
    more than ``hot_versions`` versions, of which there are few, are known to the tasks that read the wide rows,
    so that older versions of such a key are not sent. Of versions alike in all order columns one stays.
    """
    at = F.struct(*order)
    top = latest_per_key(df.select(key, *order), [key], order).select(F.col(key).alias("_key"), at.alias("_top"))
    many = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_versions)
    hot = many.join(top, F.col("_hot") == F.col("_key")).select("_hot", F.col("_top").alias("_hot_top"))
    rows = df.join(F.broadcast(hot), df[key] == F.col("_hot"), "left")
    rows = rows.filter(F.col("_hot").isNull() | (at >= F.col("_hot_top"))).drop("_hot", "_hot_top")
    # Not an equality, which would deal the rows out by the order columns as well.
    newest = rows.join(top.hint("shuffle_hash"), (F.col(key) == F.col("_key")) & (at >= F.col("_top")))
    return newest.drop("_key", "_top")


def latest_value(value, order: Sequence, when: Column | None = None) -> Column:
    """Aggregate: the ``(order..., value)`` struct of the most recent row, as a struct.

    Use ``.getField("v")`` on the result (or ``latest_non_null``) for the value.
    Rows with a NULL order key lose to rows with one.
    """
    fields = [_c(o).alias(f"o{i}") for i, o in enumerate(order)] + [_c(value).alias("v")]
    packed = F.struct(*fields)
    return F.max(packed if when is None else F.when(when, packed))


def latest_non_null(value, order: Sequence) -> Column:
    """Aggregate: most recent non-NULL ``value`` under ``order``."""
    return latest_value(value, order, when=_c(value).isNotNull()).getField("v")

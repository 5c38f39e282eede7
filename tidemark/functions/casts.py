"""Guarded casts: accept exactly the text forms the warehouse cast accepts.

Spark's own casts are more permissive (``'12.7'`` or ``'yes'``), so each cast
is gated by a pattern first (hazard H4). Hexadecimal integers are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import NUMERIC

# Accepted text shapes.
INT_PATTERN = r"^\s*[+-]?\d+\s*$"
BOOL_PATTERN = r"(?i)^(true|false)$"
TIMESTAMP_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}"
ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2})$"


def safe_bigint(text: Column) -> Column:
    return F.when(text.rlike(INT_PATTERN), text.try_cast(T.LongType()))


def safe_bool(text: Column) -> Column:
    return F.when(text.rlike(BOOL_PATTERN), F.lower(text) == F.lit("true"))


def safe_decimal(text: Column, dtype: T.DecimalType = NUMERIC) -> Column:
    return text.try_cast(dtype)


def safe_timestamp(text: Column, ts_type: T.DataType = T.TimestampNTZType()) -> Column:
    """Date-time text -> ``ts_type``: UTC wall-clock time (``timestamp_ntz``) or the instant (``timestamp``).

    Text with a zone (``Z`` or an offset) is read as an instant; text without one is taken as UTC.
    Time-only text such as ``'12:30'`` is rejected. Independent of the session time zone.
    """
    wall = text.try_cast(T.TimestampNTZType())
    instant = text.try_cast(T.TimestampType())
    if isinstance(ts_type, T.TimestampType):
        parsed = F.when(text.rlike(ZONE_SUFFIX), instant).otherwise(
            F.concat(wall.cast("string"), F.lit("Z")).try_cast(T.TimestampType()))
    else:
        # counted from the epoch: a way through local time would lose the hour that a zone repeats
        seconds = (F.unix_micros(instant).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        instant_utc = F.lit("1970-01-01").cast(T.TimestampNTZType()) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        parsed = F.when(text.rlike(ZONE_SUFFIX), instant_utc).otherwise(wall)
    return F.when(text.rlike(TIMESTAMP_PREFIX), parsed)

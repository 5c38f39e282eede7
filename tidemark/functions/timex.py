"""Timestamp literals of an explicit type, and interval arithmetic."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_literal(value: datetime | str, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """A timestamp literal of ``dtype``, built from its wall-clock text.

    Going through text keeps the Python process time zone out of the value. A
    datetime with a zone is converted to UTC first.
    """
    if isinstance(value, datetime) and value.tzinfo is not None:
        text = value.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        if isinstance(dtype, T.TimestampType):
            text += "Z"
    else:
        text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast(dtype)


def epoch(dtype: T.DataType = T.TimestampNTZType()) -> Column:
    return ts_literal("1970-01-01 00:00:00", dtype)


def hours_before(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(-int(hours)), ts)

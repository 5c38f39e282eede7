"""Deterministic surrogate ids (hazard H8: random ids are not repeatable)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SEPARATOR = "\x1f"


def key_uuid(*parts: Column) -> Column:
    """md5 of the parts joined by U+001F, laid out as 8-4-4-4-12 hex."""
    h = F.md5(F.concat_ws(UNIT_SEPARATOR, *parts))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))

"""Column-level helpers: JSON extraction, guarded casts, ids, time literals.

All of them build Catalyst expressions (no Python UDFs), so they stay inside
whole-stage code generation.
"""

from tidemark.functions.casts import safe_bigint, safe_bool, safe_decimal, safe_timestamp
from tidemark.functions.ids import key_uuid
from tidemark.functions.jsonx import (
    JsonRecord, json_array, json_array_length, json_scalar, json_subtree, object_scalar, parse_doc,
)
from tidemark.functions.timex import epoch, hours_before, ts_literal

__all__ = [
    "JsonRecord", "epoch", "hours_before", "json_array",
    "json_array_length", "json_scalar", "json_subtree", "key_uuid", "object_scalar", "parse_doc",
    "safe_bigint", "safe_bool", "safe_decimal", "safe_timestamp", "ts_literal",
]

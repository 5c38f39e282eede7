"""Table-level operators over DataFrames (no actions inside)."""

from tidemark.operators.checks import check_summary, not_null, unique, unique_combo
from tidemark.operators.incremental import RunContext, changed_keys, high_water_mark, incremental_filter
from tidemark.operators.latest import latest_non_null, latest_per_key, latest_value
from tidemark.operators.links import link_on_any
from tidemark.operators.upsert import sync_schema, upsert

__all__ = [
    "RunContext", "changed_keys", "check_summary", "high_water_mark", "incremental_filter",
    "latest_non_null", "latest_per_key", "latest_value", "link_on_any", "not_null", "sync_schema",
    "unique", "unique_combo", "upsert",
]

"""Sources and sinks: raw scans, derived test inputs, versioned snapshots."""

from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, fixture_inputs, fx_customers, fx_journey, fx_orders
from tidemark.sources.raw import land_raw, read_raw
from tidemark.sources.snapshots import SnapshotStore

__all__ = [
    "FIXTURE_EXTRACTED_COL", "SnapshotStore", "fixture_inputs", "fx_customers", "fx_journey",
    "fx_orders", "land_raw", "read_raw",
]

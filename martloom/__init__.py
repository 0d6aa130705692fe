"""martloom: incremental dimension and fact loading as Spark DataFrame operators.

The operators live in :mod:`martloom.operators`, column expressions shared by
them in :mod:`martloom.functions`, readers/writers and load state in
:mod:`martloom.sources`, the four composed loads in :mod:`martloom.plans`, and
a micro-batch driver in :mod:`martloom.streaming`.
"""

from martloom.functions.expressions import (
    DELETED,
    INSERTED,
    NOT_APPLICABLE,
    UNASSIGNED,
    UNKNOWN,
    UPDATED,
)
from martloom.operators.delta import incremental_delta, key_spine, new_keys
from martloom.operators.guards import (
    GuardError,
    check_counter,
    check_lookup_unique,
    check_surrogate_keys,
    delta_profile,
    duplicate_keys,
    orphan_report,
    split_null_keys,
)
from martloom.operators.keys import KeyAssignment, advance_high_water, assign_surrogate_keys
from martloom.operators.lookup import resolve_date_keys, resolve_key
from martloom.operators.merge import apply_changes, loopback_repair, merge_upsert
from martloom.operators.reference_index import ReferenceIndex
from martloom.operators.rollup import distinct_rollup
from martloom.operators.support import SupportCounts
from martloom.sources.control import LoadWindow, read_high_water, update_registry
from martloom.sources.lease import LeaseLost, WindowBusy
from martloom.sources.snapshot import SideChange, SnapshotStore, TableState, VersionConflict, publish_snapshot

__all__ = [
    "DELETED",
    "INSERTED",
    "NOT_APPLICABLE",
    "UNASSIGNED",
    "UNKNOWN",
    "UPDATED",
    "GuardError",
    "KeyAssignment",
    "LeaseLost",
    "LoadWindow",
    "ReferenceIndex",
    "SideChange",
    "SnapshotStore",
    "SupportCounts",
    "TableState",
    "VersionConflict",
    "WindowBusy",
    "advance_high_water",
    "apply_changes",
    "assign_surrogate_keys",
    "check_counter",
    "check_lookup_unique",
    "check_surrogate_keys",
    "delta_profile",
    "distinct_rollup",
    "duplicate_keys",
    "incremental_delta",
    "key_spine",
    "loopback_repair",
    "merge_upsert",
    "new_keys",
    "orphan_report",
    "publish_snapshot",
    "read_high_water",
    "resolve_date_keys",
    "resolve_key",
    "split_null_keys",
    "update_registry",
]

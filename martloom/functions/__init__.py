from martloom.functions.expressions import (
    CASE_BLIND_KEYS,
    DELETED,
    INSERTED,
    NOT_APPLICABLE,
    UNASSIGNED,
    UNKNOWN,
    UPDATED,
    collate_keys,
    differs,
    is_live,
    key_default,
    status_on_insert,
    status_on_update,
    ts_literal,
)

__all__ = [
    "CASE_BLIND_KEYS",
    "DELETED",
    "INSERTED",
    "NOT_APPLICABLE",
    "UNASSIGNED",
    "UNKNOWN",
    "UPDATED",
    "collate_keys",
    "differs",
    "is_live",
    "key_default",
    "status_on_insert",
    "status_on_update",
    "ts_literal",
]

"""Writers. These are the only functions (with ``catalog`` and ``jobs``)
that have effects."""

from refinery.sinks.files import (
    land_raw,
    replace_day,
    write_compact,
    write_csv,
    write_partitioned,
)
from refinery.sinks.audit import AUDIT_SCHEMA, land_with_audit, read_audit, record_audit

__all__ = [
    "AUDIT_SCHEMA", "land_raw", "land_with_audit", "read_audit", "record_audit", "replace_day",
    "write_compact", "write_csv", "write_partitioned",
]

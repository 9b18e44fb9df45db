"""Plan inspection: what a scan prunes and pushes down."""

from refinery.plans.inspect import (
    explain_text,
    files_read,
    rows_scanned,
    scan_filters,
)

__all__ = ["explain_text", "files_read", "rows_scanned", "scan_filters"]

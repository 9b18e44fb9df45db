"""DataFrame -> DataFrame steps. No effects, no collect."""

from refinery.operators.segmentation import customer_totals, segment_customers
from refinery.operators.refine import refine
from refinery.operators.quality import (
    compare_counts,
    run_checks,
    sample_rows,
    top_k,
    uppercase_counts,
    validate_columns,
    value_counts,
)
from refinery.operators.pruning import data_reduction, partition_counts

__all__ = [
    "compare_counts", "customer_totals", "data_reduction", "partition_counts",
    "refine", "run_checks", "sample_rows", "segment_customers", "top_k",
    "uppercase_counts", "validate_columns", "value_counts",
]

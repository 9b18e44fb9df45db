"""Partition-pruning report and per-partition statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import reduction_pct

# Row labels of the data-reduction report (fixed order).
SCENARIOS = ("no_filter", "partition_filter", "data_filter", "both_filters")


def data_reduction(df: DataFrame, partition_filter: Column, data_filter: Column) -> DataFrame:
    """Rows kept and percent removed for: no filter, the partition filter,
    the data filter, both.

    One scan with four conditional counts instead of four separate counts.
    A NULL predicate counts as not kept, as in ``filter``.
    """
    both = partition_filter & data_filter
    counts = df.agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(F.coalesce(partition_filter, F.lit(False))).alias("n1"),
        F.count_if(F.coalesce(data_filter, F.lit(False))).alias("n2"),
        F.count_if(F.coalesce(both, F.lit(False))).alias("n3"))
    rows = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(name).alias("scenario"),
                              F.col(f"n{i}").alias("row_count"),
                              reduction_pct(F.col(f"n{i}"), F.col("n0")).alias("reduction_pct"))
                     for i, name in enumerate(SCENARIOS)])
    return counts.select(F.inline(rows)).orderBy("ord").drop("ord")


def partition_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Rows per partition value, ascending.  Reads no data columns."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name)).orderBy(column)

"""Parquet laid out for filters on data columns.

Partition folders serve filters on the partition column only.  For the others, the rows
of a partition are put in Z-order: each of the columns becomes a rank among 2**bits
quantiles of its values, and the bits of the ranks are interleaved into one number.
Rows near in that order are near in every column, so the row groups of a file cover
small ranges of each, and a filter on any of them skips most by the footers' minima and
maxima.  Bloom filters do the same for equality on columns that are not in the order.

The rows are dealt by ranges of (partition columns, Z-number), so a hot day is cut into
several tasks and files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z = "__z"


def _number(column: Column, kind: T.DataType) -> Column:
    """A double in the order of the column's values (texts: of their first seven bytes)."""
    if isinstance(kind, T.StringType):
        head = F.substring(F.rpad(F.hex(F.encode(column, "UTF-8")), 14, "0"), 1, 14)
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _longs(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _rank(number: Column, quantiles: Sequence[float], bits: int) -> Column:
    """How many of the 2**bits - 1 quantiles are below ``number``, by binary search (NULL: none)."""
    # in Spark's order, NaN last; equal quantiles stay, so a column of few values uses all its bits as well
    edges = F.array(*[F.lit(float(x)) for x in sorted(quantiles, key=lambda x: (x != x, x))])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])

    def search(x: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda found, step: found + F.when(
            F.element_at(edges, found + step) < x, step).otherwise(0))

    # as an array's element the number is worked out once, not at every step
    return F.element_at(F.transform(F.array(number), search), 1)


def z_number(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """The Z-number of ``columns``; quantiles are taken over all rows in one aggregation
    of sketches.  NULL ranks first."""
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("bits times columns must be 1 to 62")
    numbers = [_number(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(n, shares, 10 << bits).alias(f"q{i}") for i, n in enumerate(numbers)]).first()

    z = F.lit(0).cast("long")
    for j, number in enumerate(numbers):
        if bounds[f"q{j}"] is not None:         # null: no value at all
            # each column is searched once a row: its rank's bits are looked up in their places
            spread = [sum((r >> bit & 1) << bit * len(numbers) + j for bit in range(bits)) for r in range(1 << bits)]
            z = z.bitwiseOR(F.element_at(_longs(spread), _rank(number, bounds[f"q{j}"], bits) + 1))
    return z


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], *, partition_by: Sequence[str] = (),
                    bloom: Sequence[str] = (), bits: int = 8, row_group_bytes: int = 16 << 20,
                    mode: str = "overwrite") -> str:
    """Parquet at ``path``, each partition in Z-order of ``columns``, with bloom filters on
    ``bloom``."""
    parts = [F.col(f"`{c}`") for c in partition_by]
    laid = (df.withColumn(Z, z_number(df, columns, bits)).repartitionByRange(*parts, F.col(Z))
            .sortWithinPartitions(*parts, F.col(Z)).drop(Z))
    w = laid.write.mode(mode).option("parquet.block.size", row_group_bytes)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path

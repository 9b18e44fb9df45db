"""Database extract through Spark's JDBC source.

A table is read by the executors in ``num_partitions`` parallel range slices
of ``partition_column``, never through one machine.  A caller's predicate is
applied with ``DataFrame.where``: Spark parses it as a single expression (so
it cannot carry a second statement) and pushes what it can to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Identifier quote per dialect (fixed values of the extract functions).
QUOTES = {"postgresql": '"', "mysql": "`", "derby": '"'}


def _quote(name: str, dialect: str) -> str:
    q = QUOTES.get(dialect, '"')
    if q in name:
        raise ValueError(f"identifier may not contain {q!r}: {name!r}")
    return f"{q}{name}{q}"


def jdbc_options(url: str, table: str, schema: str | None = None, *,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000, **extra: str) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``; identifiers quoted per dialect."""
    dialect = url.split(":")[1] if url.startswith("jdbc:") else ""
    qualified = _quote(table, dialect)
    if schema:
        qualified = f"{_quote(schema, dialect)}.{qualified}"
    opts = {"url": url, "dbtable": qualified, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, schema: str | None = None,
              where: str | None = None, *, single_task: bool = False, **kwargs) -> DataFrame:
    """Partitioned JDBC scan of ``schema.table``, optionally filtered by ``where``.

    Without a partition column one task would read the whole table: that is
    refused unless the caller asks for it (``single_task``, for small tables)."""
    if kwargs.get("partition_column") is None and not single_task:
        raise ValueError(f"reading {table} needs partition_column with bounds, or single_task=True")
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, schema, **kwargs)).load()
    return df.where(where) if where else df

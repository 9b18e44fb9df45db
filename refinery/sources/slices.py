"""Extracts in balanced slices that go on where a broken run stopped.

A plan cuts the range of a key column into slices of about equal row counts, by
quantile sketches, and is written once.  Each slice is read, landed in its own folder and
entered in a ledger.  A run reads only the slices of the plan that the ledger doesn't
have, so after a failure no finished slice is read again, and a slice that failed midway
leaves no rows behind.  The source is any function of a slice's bounds, e.g.
``read_jdbc`` with a predicate.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.sinks.audit import land_with_audit
from refinery.sinks.publish import exists, replace_folder, restore

PLAN = "slice int, low string, high string"
LEDGER = "slice int, rows long, content string, path string"


class Slice(NamedTuple):
    """Rows with low <= key < high; no low: from the start, no high: to the end, where
    NULL keys are too."""

    number: int
    low: str | None
    high: str | None

    def predicate(self, column: str) -> Column:
        """For a DataFrame source: compared in the column's own type."""
        key = F.col(f"`{column}`")
        above = key >= F.lit(self.low) if self.low is not None else F.lit(True)
        below = key < F.lit(self.high) if self.high is not None else F.lit(True)
        inside = above & below
        return inside | key.isNull() if self.high is None else inside


def plan_slices(keys: DataFrame, column: str, slices: int, path: str) -> list[Slice]:
    """The plan at ``path``; made from the key column of ``keys`` if there is none yet."""
    spark, path = keys.sparkSession, path.rstrip("/")
    restore(spark, path)
    if not exists(spark, path):
        shares = [i / slices for i in range(1, slices)]
        number = keys.select(F.col(f"`{column}`").alias("key"))
        found = number.agg(F.percentile_approx("key", shares, 10_000).alias("q")).first()["q"] if shares else []
        edges = sorted(set(found or []))            # a value of many rows is the edge of one slice
        bounds = [None, *map(str, edges), None]
        rows = [(i, low, high) for i, (low, high) in enumerate(zip(bounds, bounds[1:]))]
        with replace_folder(spark, path) as fresh:
            spark.createDataFrame(rows, PLAN).write.parquet(fresh)
    rows = spark.read.schema(PLAN).parquet(path).orderBy("slice").collect()      # one row a slice
    return [Slice(r["slice"], r["low"], r["high"]) for r in rows]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def pending(spark: SparkSession, planned: list[Slice], ledger_path: str) -> list[Slice]:
    """The planned slices that the ledger doesn't have."""
    plan = spark.createDataFrame([tuple(s) for s in planned], PLAN)
    left = plan.join(read_ledger(spark, ledger_path).select("slice"), "slice", "left_anti")
    missing = {r["slice"] for r in left.select("slice").collect()}
    return [s for s in planned if s.number in missing]


def extract_sliced(keys: DataFrame, read: Callable[[Slice], DataFrame], base: str, table: str, *, column: str,
                   slices: int, source: str, fmt: str = "parquet") -> DataFrame:
    """Land the missing slices below ``base/table`` and return the ledger: (slice, rows,
    content digest, path).  Raises what a slice raises; the next call goes on from there.
    The key must not change in the source between the runs of one extract."""
    spark, base = keys.sparkSession, base.rstrip("/")
    ledger = f"{base}/_ledger/{table}"
    planned = plan_slices(keys, column, slices, f"{base}/_plan/{table}")
    for s in pending(spark, planned, ledger):
        path, rows, content = land_with_audit(read(s), f"{base}/{table}", f"slice={s.number}", None, source=source,
                                              fmt=fmt, content=True)
        entry = spark.createDataFrame([(s.number, rows, content, path)], LEDGER)
        (entry.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("slice").parquet(ledger))
    return read_ledger(spark, ledger)


def read_sliced(spark: SparkSession, base: str, table: str, schema) -> DataFrame:
    """The landed rows of all slices in the ledger (Parquet landings)."""
    base = base.rstrip("/")
    paths = [r["path"] for r in read_ledger(spark, f"{base}/_ledger/{table}").where("path is not null").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

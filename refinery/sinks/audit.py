"""Extract audit: source, table, run date, row count and content digest of each landing.

Count and digest are observed on the landing write itself (``DataFrame.observe``),
so the extract is not scanned a second time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("database", T.StringType(), True),
    T.StructField("run_date", T.DateType(), True),
    T.StructField("extracted_rows", T.LongType(), False),
    T.StructField("path", T.StringType(), True),
    # null for landings recorded without a digest
    T.StructField("content", T.StringType(), True),
])


def land_with_audit(df: DataFrame, base: str, table: str, ds: str | None, *,
                    source: str, database: str | None = None,
                    fmt: str = "csv", content: bool = False) -> tuple:
    """Land ``df`` like :func:`land_raw`, counting rows during the write: (path, rows),
    and with ``content`` also the digest of what was written."""
    from refinery.sinks.files import land_raw

    obs = Observation(f"extract_{table}")
    path = land_raw(df, base, table, ds, fmt=fmt, observation=obs, content=content)
    rows = int(obs.get["rows"]) if path is not None else 0
    if not content:
        return path, rows
    return path, rows, obs.get["content"] if path is not None else None


def record_audit(spark: SparkSession, audit_path: str, *, source: str, table: str,
                 database: str | None, ds: str | None, rows: int,
                 path: str | None, content: str | None = None) -> None:
    """Write the audit row of one landing (a bounded, driver-built record).

    The table is partitioned by what identifies a landing, so landing a day
    again replaces its row."""
    run_date = dt.date.fromisoformat(ds) if ds else None
    row = [(source, table, database, run_date, rows, path, content)]
    (spark.createDataFrame(row, AUDIT_SCHEMA).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "table_name", "database", "run_date").parquet(audit_path))


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path).select(*AUDIT_SCHEMA.names)

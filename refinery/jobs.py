"""The data jobs a user runs, composed from sources, operators and sinks.

* :func:`segmentation_job`          CSV sales + customers -> segmented CSV
* :func:`segmentation_catalog_job`  catalog tables -> compact Parquet
* :func:`partition_job`             raw CSV -> date-partitioned Parquet
* :func:`extract_job`               source table -> raw landing + audit row
* :func:`refine_job`                raw day -> refined day (dynamic overwrite)
* :func:`validate_job`              checks; raises when one fails
* :func:`daily_job`                 extract -> register -> refine -> register -> validate

Every step's output is a written table that the next step reads, so a
lost executor or a failed step re-runs from the last written table, not
from the source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import catalog
from refinery.functions.columns import (
    DATE_FORMAT,
    DATE_PARTITION_COLUMN,
    DEFAULT_TIER_LABEL,
    DEFAULT_TIERS,
    RAW_TABLE_PREFIX,
    REFINED_TABLE_PREFIX,
    parse_date,
)
from refinery.operators.quality import run_checks
from refinery.operators.refine import refine
from refinery.operators.segmentation import segment_customers
from refinery.session import scratch_path
from refinery.sinks.audit import land_with_audit, record_audit
from refinery.sinks.files import replace_day, write_compact, write_csv, write_partitioned
from refinery.sinks.publish import publish_day
from refinery.sources.files import read_csv


class CheckFailed(RuntimeError):
    """A data-quality check returned ``passed = false``."""


def segmentation_job(spark: SparkSession, sales_path: str, customer_path: str,
                     output_path: str, *, tiers=DEFAULT_TIERS,
                     default_label: str = DEFAULT_TIER_LABEL,
                     sales_schema: T.StructType | str | None = None,
                     customer_schema: T.StructType | str | None = None,
                     header: bool = False) -> str:
    """Headered CSV in, segmented CSV out (no header line by default, as
    Spark writes it).  Files are read by as many tasks as they have splits.  Pass
    schemas to skip type inference (which reads each file in one task).
    Both aggregated sides are staged in the shared checkpoint folder before
    the join (see ``customer_totals``)."""
    sales = read_csv(spark, sales_path, schema=sales_schema, split=True)
    customers = read_csv(spark, customer_path, schema=customer_schema, split=True)
    result = segment_customers(sales, customers, tiers=tiers, default_label=default_label)
    return write_csv(result, output_path, header=header)


def segmentation_catalog_job(spark: SparkSession, sales_table: str, customer_table: str,
                             output_path: str, *, tiers=DEFAULT_TIERS,
                             default_label: str = DEFAULT_TIER_LABEL) -> str:
    """Catalog tables in, Parquet (snappy, as few files as the size allows)
    out; staged like :func:`segmentation_job`."""
    result = segment_customers(spark.table(sales_table), spark.table(customer_table),
                               tiers=tiers, default_label=default_label)
    return write_compact(result, output_path)


class Partitioned(NamedTuple):
    """What :func:`partition_job` wrote: the table, the rows without a date, their number."""

    path: str
    reject_path: str
    rejected: int


def partition_job(spark: SparkSession, raw_path: str, refined_path: str, *,
                  date_column: str = "Date", date_format: str = DATE_FORMAT,
                  partition_column: str = DATE_PARTITION_COLUMN,
                  schema: T.StructType | str | None = None,
                  reject_path: str | None = None, batch: str | None = None) -> Partitioned:
    """Raw CSV -> parse the text date -> Parquet partitioned by that date.

    Only the dates present in this batch are replaced.  Rows whose date does not
    parse (or is missing) are kept in the reject table (default: beside the
    refined one) under ``batch``, which names this input (default: a digest of
    ``raw_path``): the same batch again replaces its rejects, another batch keeps
    them.  The text is parsed once; both writes read the staged result."""
    refined_path = refined_path.rstrip("/")
    reject_path = (reject_path or f"{refined_path}_rejects").rstrip("/")
    batch = batch or hashlib.sha256(raw_path.encode()).hexdigest()[:16]
    parsed = read_csv(spark, raw_path, schema=schema, split=True).withColumn(partition_column, parse_date(date_column, date_format))
    stage = scratch_path(spark, "parsed_dates")
    parsed.write.parquet(stage)
    staged = spark.read.schema(parsed.schema).parquet(stage)
    dated = F.col(partition_column).isNotNull()
    write_partitioned(staged.where(dated), refined_path, [partition_column], dynamic=True)
    folder = replace_day(staged.where(~dated).drop(partition_column), reject_path, "batch", batch)
    rejected = spark.read.schema(staged.drop(partition_column).schema).parquet(folder).count()
    return Partitioned(refined_path, reject_path, rejected)


def extract_job(spark: SparkSession, source_df: DataFrame, raw_base: str, table: str,
                ds: str | None, *, source: str, database: str | None = None,
                audit_path: str | None = None) -> tuple[str | None, int]:
    """Land one extract at ``raw_base/table[/dt=ds]`` and record the audit row.
    Returns the folder written (``None`` for an empty extract) and the rows extracted."""
    path, rows, _ = _extract(spark, source_df, raw_base, table, ds, source=source, database=database,
                             audit_path=audit_path)
    return path, rows


def _extract(spark: SparkSession, source_df: DataFrame, raw_base: str, table: str, ds: str | None, *,
             source: str, database: str | None, audit_path: str | None) -> tuple[str | None, int, str | None]:
    path, rows, *content = land_with_audit(source_df, raw_base, table, ds, source=source,
                                           database=database, content=True)
    content = content[0] if content else None
    if audit_path is not None:
        record_audit(spark, audit_path, source=source, table=table, database=database,
                     ds=ds, rows=rows, path=path, content=content)
    return path, rows, content


def extract_many(spark: SparkSession, sources: dict[str, DataFrame], raw_base: str,
                 ds: str | None, *, source: str, audit_path: str | None = None,
                 workers: int = 4, attempts: int = 1, pool: str = "extract") -> DataFrame:
    """Extract several tables; a failing table is recorded and the rest go on.
    Returns (table_name, path, error, attempts) per table.

    ``workers`` tables are extracted at a time, each in a scheduler pool of its own
    (shares of the cluster are fair under ``spark.scheduler.mode=FAIR``), so a slow table
    doesn't hold the others; a failing one is tried ``attempts`` times."""
    def run(table: str) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{table}")
        error = None
        for n in range(1, attempts + 1):
            try:
                return *_extract(spark, sources[table], raw_base, table, ds, source=source, database=None,
                                 audit_path=None), None, n
            except Exception as exc:  # keep going, report it
                error = f"{type(exc).__name__}: {exc}"
        return None, 0, None, error, attempts

    results = {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as threads:
        waiting = {threads.submit(inheritable_thread_target(spark)(run), table): table for table in sources}
        for done in as_completed(waiting):          # audit rows are written by one thread
            table = waiting[done]
            path, rows, content, error, n = done.result()
            if audit_path is not None and error is None:
                record_audit(spark, audit_path, source=source, table=table, database=None, ds=ds, rows=rows, path=path,
                             content=content)
            results[table] = (table, path, error, n)
    return spark.createDataFrame([results[t] for t in sources],
                                 "table_name string, path string, error string, attempts int")


def refine_job(raw_day: DataFrame, refined_path: str, ds: str, *,
               keep: dict[str, Sequence[object]], upper: Sequence[str],
               drop: Sequence[str], partition_column: str = "dt", table: str | None = None) -> str:
    """Refine one day and make that day's partition hold exactly the result, also
    if no row is kept.  With ``table`` the day is published through the catalog: a fresh
    version, then one statement that points the partition at it."""
    out = refine(raw_day.drop(partition_column), keep=keep, upper=upper, drop=drop)
    if table is not None:
        return publish_day(out, table, refined_path, partition_column, ds)
    return replace_day(out, refined_path, partition_column, ds)


def validate_job(raw: DataFrame, refined: DataFrame, *, upper: Sequence[str] = (),
                 allowed: dict[str, Sequence[object]] | None = None,
                 absent: Sequence[str] = (), fail: bool = True,
                 landed_rows: int | None = None, landed_content: str | None = None,
                 landed_columns: Sequence[str] | None = None, content: bool = False) -> list:
    """Run all checks; the verdict (one row per check) is collected and the
    job fails when any check did not pass.  ``landed_*`` and ``content``: see
    ``run_checks``."""
    verdict = run_checks(raw, refined, upper=upper, allowed=allowed, absent=absent, landed_rows=landed_rows,
                         landed_content=landed_content, landed_columns=landed_columns,
                         content=content).collect()
    failed = [r for r in verdict if not r["passed"]]
    if failed and fail:
        raise CheckFailed("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
    return verdict


class SchemaChanged(RuntimeError):
    """A source column has another type than the raw table."""


def in_table_order(spark: SparkSession, source_df: DataFrame, table: str, partition_column: str) -> DataFrame:
    """``source_df`` as ``table`` has its columns: matched by name, in the table's
    order and under its names; columns the source no longer has are NULL."""
    fold = lambda name: catalog.same_name(spark, name)
    own = {fold(c): c for c in source_df.columns}
    return source_df.select(*[
        (F.col(f"`{own[fold(f.name)]}`") if fold(f.name) in own else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in spark.table(table).schema.fields if fold(f.name) != fold(partition_column)])


def daily_job(spark: SparkSession, ds: str, source_df: DataFrame, *, root: str,
              database: str, table: str, keep: dict[str, Sequence[object]],
              upper: Sequence[str], drop: Sequence[str], source: str = "database",
              raw_prefix: str = RAW_TABLE_PREFIX, refined_prefix: str = REFINED_TABLE_PREFIX,
              fail_on_check: bool = True) -> dict[str, object]:
    """One run for date ``ds``; running the same date again leaves the same tables
    and the same audit row.

    extract -> land ``raw/<table>/dt=ds`` (CSV) -> register / add the raw
    partition -> refine the day -> publish a fresh version of the refined day
    (Parquet) -> register / point the refined partition at it -> checks on the day,
    on the written tables (raw as read against the rows extracted, refined against
    raw, by counts and by content digests).

    Drift: columns are matched by name.  New ones are added to both tables, ones
    that are gone land as NULL, another order or case changes nothing, and a type
    that holds every value of the old one widens the column.  Any other type raises
    before anything is written or altered.  The catalog learns the one partition
    written; the first run's ``register`` recovers whatever folders already exist.
    """
    root = root.rstrip("/")
    raw_base, refined_path = f"{root}/raw", f"{root}/refined/{table}"
    catalog.create_database(spark, database, location=f"{root}/_catalog")
    raw_table, refined_table = f"{database}.{raw_prefix}{table}", f"{database}.{refined_prefix}{table}"

    drift = None
    if spark.catalog.tableExists(raw_table):
        drift = catalog.evolve(spark, raw_table, source_df.schema, widen=True)
        if drift["changed"]:
            raise SchemaChanged("; ".join(drift["changed"]))
        source_df = in_table_order(spark, source_df, raw_table, "dt")

    landed, rows, content = _extract(spark, source_df, raw_base, table, ds, source=source,
                                     database=database, audit_path=f"{root}/audit")
    if landed is None:
        return {"ds": ds, "landed": None, "verdict": [], "drift": drift}

    if not spark.catalog.tableExists(raw_table):
        raw_schema = T.StructType(source_df.schema.fields + [T.StructField("dt", T.DateType())])
        catalog.register(spark, raw_table, f"{raw_base}/{table}", fmt="csv",
                         schema=raw_schema, partition_by=("dt",))
    # Only the day just written is added: no listing of all earlier days.
    catalog.add_partition(spark, raw_table, {"dt": ds})

    # Read by the header: a landing whose columns are not the table's fails here.
    raw_day = read_csv(spark, landed, schema=source_df.schema, own=True, split=True, enforceSchema=False,
                       unpaired="keep")          # a corrupt landing is for the checks to tell
    refined = refine(raw_day, keep=keep, upper=upper, drop=drop)
    known = spark.catalog.tableExists(refined_table)
    if known:
        catalog.evolve(spark, refined_table, refined.schema, widen=True)
    folder = refine_job(raw_day, refined_path, ds, keep=keep, upper=upper, drop=drop, table=refined_table)
    if not known:
        catalog.register(spark, refined_table, refined_path, fmt="parquet",
                         schema=T.StructType(refined.schema.fields + [T.StructField("dt", T.DateType())]),
                         partition_by=("dt",))
        catalog.set_partition(spark, refined_table, {"dt": ds}, folder)

    day = F.col("dt") == F.lit(ds).cast("date")
    verdict = validate_job(spark.table(raw_table).where(day), spark.table(refined_table).where(day),
                           upper=upper, allowed=keep, absent=drop, fail=fail_on_check, landed_rows=rows,
                           landed_content=content, landed_columns=source_df.columns, content=True)
    return {"ds": ds, "landed": landed, "raw_table": raw_table,
            "refined_table": refined_table, "verdict": verdict, "drift": drift}

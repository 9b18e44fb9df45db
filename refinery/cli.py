"""Command-line entry points, for ``spark-submit``.

The cluster manager supplies master, executors and the shared
``spark.checkpoint.dir``; a command only reads its arguments, builds the
session and runs one job from :mod:`refinery.jobs`::

    spark-submit --py-files refinery.zip refinery/__main__.py segment SALES CUSTOMER OUTPUT
    ... segment-catalog --sales-table db.sales --customer-table db.customer --output PATH
    ... partition RAW_CSV OUTPUT [--date-column Date] [--date-format dd-MM-yyyy]
    ... refine --database db --raw-table raw2_customers --refined-table refined_customers \\
               --output PATH --run-date 2024-01-02 --keep customer_state=SP \\
               --upper customer_city --drop customer_unique_id
    ... validate --raw-table db.raw2_customers --refined-table db.refined_customers \\
               [--run-date 2024-01-02] [--content] --keep ... --upper ... --drop ...
    ... crawl customers=PATH orders=PATH --database db [--prefix raw2_] [--merge]
    ... refresh db.refined_customers [--new-folders | --ledger PATH]
    ... drop-old-versions db.refined_customers PATH
    ... daily --run-date 2024-01-02 (--source-table T | --source-path P | --jdbc-url U
               --jdbc-table T) --root PATH --database db --table customers --keep ...

CSV inputs given without a schema are read with type inference, as the
reference job does; that is an extra pass over the input, so pass
``--*-schema`` (a DDL string) for large inputs.  ``validate`` and ``daily``
exit with status 1 when a check fails.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery import catalog, jobs
from refinery.functions.columns import (
    DATE_FORMAT,
    DATE_PARTITION_COLUMN,
    DEFAULT_TIER_LABEL,
    DEFAULT_TIERS,
)
from refinery.session import get_session
from refinery.sinks.publish import drop_old_versions
from refinery.sources.files import read_csv, read_parquet
from refinery.sources.jdbc import read_jdbc


def _tier(text: str) -> tuple[float, str]:
    cut, sep, label = text.partition(":")
    if not sep or not label:
        raise argparse.ArgumentTypeError(f"tier must be CUT:LABEL, got {text!r}")
    value = float(cut)
    return (int(value) if value.is_integer() else value), label


def _keep(pairs: Sequence[str]) -> dict[str, list[str]]:
    """``col=v1,v2`` entries -> {col: [v1, v2]}."""
    out: dict[str, list[str]] = {}
    for pair in pairs:
        col, sep, values = pair.partition("=")
        if not sep:
            raise SystemExit(f"--keep needs COLUMN=VALUE[,VALUE...], got {pair!r}")
        out.setdefault(col, []).extend(v for v in values.split(",") if v)
    return out


def _target(text: str) -> tuple[str, str]:
    name, _, path = text.partition("=")
    if not name or not path:
        raise argparse.ArgumentTypeError(f"not NAME=PATH: {text!r}")
    return name, path


def _properties(path: str | None) -> dict[str, str]:
    """``key=value`` lines (JDBC user, password, driver ...) from a file."""
    if not path:
        return {}
    props = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                key, _, value = line.partition("=")
                props[key.strip()] = value.strip()
    return props


def _refine_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--keep", action="append", default=[], metavar="COL=V1[,V2]",
                   help="keep only rows whose COL is one of the values")
    p.add_argument("--upper", action="append", default=[], metavar="COL")
    p.add_argument("--drop", action="append", default=[], metavar="COL")


def _day(df: DataFrame, run_date: str | None, column: str = "dt") -> DataFrame:
    if run_date and column in df.columns:
        return df.where(F.col(column) == F.lit(run_date).cast("date"))
    return df


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="refinery", description=__doc__.split("\n\n")[0])
    parser.add_argument("--app-name", default="refinery")
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("segment", help="customer segmentation, CSV in, CSV out")
    p.add_argument("sales")
    p.add_argument("customer")
    p.add_argument("output")
    p.add_argument("--sales-schema")
    p.add_argument("--customer-schema")
    p.add_argument("--header", action="store_true", help="write a header line")
    p.add_argument("--tier", action="append", type=_tier, metavar="CUT:LABEL",
                   help="highest first; default 28000:High Value, 20000:Medium Value")
    p.add_argument("--default-label", default=DEFAULT_TIER_LABEL)

    p = sub.add_parser("segment-catalog", help="customer segmentation, catalog tables in, Parquet out")
    p.add_argument("--sales-table", required=True)
    p.add_argument("--customer-table", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--register-as", help="catalog name for the result table")
    p.add_argument("--tier", action="append", type=_tier, metavar="CUT:LABEL")
    p.add_argument("--default-label", default=DEFAULT_TIER_LABEL)

    p = sub.add_parser("partition", help="raw CSV -> Parquet partitioned by a parsed date")
    p.add_argument("raw")
    p.add_argument("output")
    p.add_argument("--schema")
    p.add_argument("--date-column", default="Date")
    p.add_argument("--date-format", default=DATE_FORMAT)
    p.add_argument("--partition-column", default=DATE_PARTITION_COLUMN)
    p.add_argument("--reject-path", help="folder of the rows without a date (default: OUTPUT_rejects)")
    p.add_argument("--batch", help="name of this input in the reject table")

    p = sub.add_parser("refine", help="refine one day of a raw table into a partitioned table")
    p.add_argument("--database", required=True)
    p.add_argument("--raw-table", help="raw catalog table (partitioned by dt)")
    p.add_argument("--input", help="raw CSV folder of the day, instead of --raw-table")
    p.add_argument("--input-schema")
    p.add_argument("--refined-table", required=True)
    p.add_argument("--output", required=True, help="refined table folder")
    p.add_argument("--run-date", required=True)
    _refine_args(p)

    p = sub.add_parser("validate", help="quality checks of a refined table against its raw table")
    p.add_argument("--raw-table", required=True)
    p.add_argument("--refined-table", required=True)
    p.add_argument("--run-date")
    p.add_argument("--content", action="store_true", help="also compare the values, by digests")
    _refine_args(p)

    p = sub.add_parser("crawl", help="register folders of Parquet files as tables")
    p.add_argument("target", nargs="+", type=_target, metavar="NAME=PATH")
    p.add_argument("--database", required=True)
    p.add_argument("--prefix", default="")
    p.add_argument("--merge", action="store_true", help="the columns of all folders, not of one")

    p = sub.add_parser("refresh", help="bring a table's partitions in line with its folders")
    p.add_argument("table")
    how = p.add_mutually_exclusive_group()
    how.add_argument("--new-folders", action="store_true", help="only add")
    how.add_argument("--ledger", help="only what differs from the ledger in this folder")

    p = sub.add_parser("drop-old-versions", help="remove versions of days that a table no longer points at")
    p.add_argument("table")
    p.add_argument("path")
    p.add_argument("--partition-column", default="dt")

    p = sub.add_parser("daily", help="extract -> raw -> refine -> register -> validate for one date")
    p.add_argument("--run-date", required=True)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--source-table")
    src.add_argument("--source-path")
    src.add_argument("--jdbc-url")
    p.add_argument("--source-format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--source-schema")
    p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-schema")
    p.add_argument("--jdbc-properties", help="file of key=value lines (user, password, driver)")
    p.add_argument("--jdbc-partition-column")
    p.add_argument("--jdbc-lower-bound", type=int)
    p.add_argument("--jdbc-upper-bound", type=int)
    p.add_argument("--jdbc-num-partitions", type=int)
    p.add_argument("--jdbc-single-task", action="store_true", help="read a small table without a partition column")
    p.add_argument("--where", help="SQL predicate applied to the extract")
    p.add_argument("--source-name", default="database")
    p.add_argument("--root", required=True, help="folder holding raw/, refined/, audit/")
    p.add_argument("--database", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--no-fail", action="store_true", help="report failed checks, exit 0")
    _refine_args(p)
    return parser


def _source(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.source_table:
        df = spark.table(a.source_table)
    elif a.source_path:
        df = (read_parquet(spark, a.source_path) if a.source_format == "parquet"
              else read_csv(spark, a.source_path, schema=a.source_schema, split=True))
    else:
        if not a.jdbc_table:
            raise SystemExit("--jdbc-url needs --jdbc-table")
        bounds = {}
        if a.jdbc_partition_column:
            bounds = dict(partition_column=a.jdbc_partition_column,
                          lower_bound=a.jdbc_lower_bound, upper_bound=a.jdbc_upper_bound,
                          num_partitions=a.jdbc_num_partitions)
        return read_jdbc(spark, a.jdbc_url, a.jdbc_table, a.jdbc_schema, where=a.where,
                         single_task=a.jdbc_single_task, **bounds, **_properties(a.jdbc_properties))
    return df.where(a.where) if a.where else df


def _print_verdict(rows) -> bool:
    ok = True
    for r in rows:
        ok &= bool(r["passed"])
        print(f"{'PASS' if r['passed'] else 'FAIL'}  {r['check']}: {r['detail']}")
    return ok


def run(spark: SparkSession, argv: Sequence[str]) -> int:
    a = _parser().parse_args(list(argv))
    # All arguments are checked before any Spark work starts.
    tiers = tuple(getattr(a, "tier", None) or DEFAULT_TIERS)
    keep = _keep(getattr(a, "keep", []))

    if a.command == "segment":
        jobs.segmentation_job(spark, a.sales, a.customer, a.output, tiers=tiers,
                              default_label=a.default_label, sales_schema=a.sales_schema,
                              customer_schema=a.customer_schema, header=a.header)
    elif a.command == "segment-catalog":
        jobs.segmentation_catalog_job(spark, a.sales_table, a.customer_table, a.output,
                                      tiers=tiers, default_label=a.default_label)
        if a.register_as:
            catalog.register(spark, a.register_as, a.output)
    elif a.command == "partition":
        done = jobs.partition_job(spark, a.raw, a.output, date_column=a.date_column,
                                  date_format=a.date_format, partition_column=a.partition_column,
                                  schema=a.schema, reject_path=a.reject_path, batch=a.batch)
        print(f"{done.rejected} rows without a date in {done.reject_path}")
    elif a.command == "refine":
        if bool(a.raw_table) == bool(a.input):
            raise SystemExit("give exactly one of --raw-table and --input")
        raw = (spark.table(f"{a.database}.{a.raw_table}") if a.raw_table
               else read_csv(spark, a.input, schema=a.input_schema, split=True))
        table = f"{a.database}.{a.refined_table}"
        catalog.create_database(spark, a.database)
        folder = jobs.refine_job(_day(raw, a.run_date), a.output, a.run_date, keep=keep,
                                 upper=a.upper, drop=a.drop, table=table)
        if not spark.catalog.tableExists(table):
            catalog.register(spark, table, a.output)
            catalog.set_partition(spark, table, {"dt": a.run_date}, folder)
    elif a.command == "validate":
        raw = _day(spark.table(a.raw_table), a.run_date)
        refined = _day(spark.table(a.refined_table), a.run_date)
        if a.content and "dt" not in raw.columns:       # a raw folder of one day
            refined = refined.drop("dt")
        verdict = jobs.validate_job(raw, refined, upper=a.upper, allowed=keep,
                                    absent=a.drop, fail=False, content=a.content)
        return 0 if _print_verdict(verdict) else 1
    elif a.command == "crawl":
        catalog.crawl(spark, dict(a.target), a.database, prefix=a.prefix, merge=a.merge)
    elif a.command == "refresh":
        if a.ledger:
            for r in catalog.refresh_by_ledger(spark, a.table, a.ledger).orderBy("folder").toLocalIterator():
                print(f"{r['change']}  {r['folder']}")
        else:
            catalog.refresh(spark, a.table, "new_folders" if a.new_folders else "everything")
    elif a.command == "drop-old-versions":
        for folder in drop_old_versions(spark, a.table, a.path, a.partition_column):
            print(f"removed  {folder}")
    elif a.command == "daily":
        out = jobs.daily_job(spark, a.run_date, _source(spark, a), root=a.root,
                             database=a.database, table=a.table, keep=keep,
                             upper=a.upper, drop=a.drop, source=a.source_name,
                             fail_on_check=False)
        if out["landed"] is None:
            print(f"empty extract for {a.run_date}: nothing written")
            return 0
        ok = _print_verdict(out["verdict"])
        return 0 if ok or a.no_fail else 1
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    args = list(sys.argv[1:] if argv is None else argv)
    app = _parser().parse_args(args).app_name     # --help and bad usage exit here, no JVM
    return run(get_session(app), args)

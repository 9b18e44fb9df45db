"""Registered queries: one per inventory item, each ``(spark, sf_dir) ->
DataFrame`` over the driver's test tables, plus the equivalent DuckDB SQL.

Queries that exercise a sink write below the session's shared checkpoint
folder (``refinery.session.scratch_path``) and return a DataFrame reading
the written data back.  Nothing is kept between queries: each builds its inputs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import catalog, jobs, standins
from refinery.operators import (
    compare_counts,
    data_reduction,
    partition_counts,
    refine,
    run_checks,
    sample_rows,
    segment_customers,
    top_k,
    uppercase_counts,
    validate_columns,
    value_counts,
)
from refinery.functions.columns import (
    DATE_PARTITION_COLUMN as PART,
    RAW_LABEL,
    RAW_TABLE_PREFIX,
    REFINED_LABEL,
    REFINED_TABLE_PREFIX,
    date_text,
    parse_date,
)
from refinery.operators.heavy_hitters import heavy_hitters
from refinery.operators.sql_checks import run_sql_check
from refinery.session import scratch_path
from refinery.sinks.audit import read_audit
from refinery.sinks.clustered import write_clustered
from refinery.sinks.files import land_raw, replace_day, write_csv, write_partitioned
from refinery.sinks.publish import remove
from refinery.sources.files import file_inventory, inventory_by_folder, read_csv, read_parquet, read_partition
from refinery.sources.slices import Slice, extract_sliced, read_sliced
from refinery.streaming.new_folders import refine_new_landings

# Parameters of the queries on the test tables (fixed, also used in the SQL).
DAY = "2024-01-15"              # partition filter / leaf / overwritten day
KIND = "click"                  # data filter (event_type stands in for Customer)
STATE = "LARGE"                 # kept state (p_type stands in for customer_state)
RUN_DATES = ("2024-01-01", "2024-01-02")
WIDE_DATES = (*RUN_DATES, "2024-01-03")
FILTER_SQL = "o_orderstatus = 'F' AND o_totalprice > 200000"
CSV_TASK_BYTES = 192 << 20      # of the table, written by one task: some splits of its CSV file
TEXT_TABLES = ("documents", "events", "conversations")     # landed besides the clean tables
REFINE_TEXT = dict(keep={"lang": ["en", "fr"]}, upper=["source"], drop=["n_chars"])
REFINE = dict(keep={"customer_state": [STATE]}, upper=["customer_city"],
              drop=["customer_unique_id"])


def _events_base(spark: SparkSession, sf_dir: str) -> str:
    """Events written as Parquet partitioned by ``date_partition``."""
    return write_partitioned(standins.events_with_date(spark, sf_dir),
                             scratch_path(spark, "events_by_day"), [PART])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, _events_base(spark, sf_dir))


def _refined_base(spark: SparkSession, sf_dir: str) -> str:
    """Store customers refined and written as Parquet."""
    path = scratch_path(spark, "refined_customers")
    refine(standins.store_customers(spark, sf_dir), **REFINE).write.parquet(path)
    return path


def _raw_refined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (standins.store_customers(spark, sf_dir),
            read_parquet(spark, _refined_base(spark, sf_dir)))


def _db(spark: SparkSession, stem: str) -> str:
    """A fresh database for one query run, located in the shared folder."""
    location = scratch_path(spark, f"db_{stem}")
    return catalog.create_database(spark, f"{stem}_{location[-12:]}", location=location)


def _catalog_pair(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw and refined store customers registered as catalog tables."""
    db = _db(spark, "checks")
    raw_path = scratch_path(spark, "raw_customers_tbl")
    standins.store_customers(spark, sf_dir).write.parquet(raw_path)
    catalog.register(spark, f"{db}.{RAW_TABLE_PREFIX}customers", raw_path)
    catalog.register(spark, f"{db}.{REFINED_TABLE_PREFIX}customers", _refined_base(spark, sf_dir))
    return f"{db}.{RAW_TABLE_PREFIX}customers", f"{db}.{REFINED_TABLE_PREFIX}customers"


# --- segmentation ------------------------------------------------------------

def customer_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segmentation operator, staged like the jobs."""
    return segment_customers(standins.sales(spark, sf_dir), standins.customers(spark, sf_dir),
                             tiers=standins.STANDIN_TIERS)


def segmentation_exact_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with three decimal places: nothing is rounded before the sum."""
    sales = standins.sales(spark, sf_dir)
    price = (F.col("Price").cast("decimal(18,2)")
             + (F.col("CustomerID") % 10 + 1).cast("decimal(4,0)") * F.lit(0.001).cast("decimal(4,3)"))
    return segment_customers(sales.withColumn("Price", price.cast("double")), standins.customers(spark, sf_dir),
                             tiers=standins.STANDIN_TIERS)


def _sales_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sales = standins.sales(spark, sf_dir).select("CustomerID", "Price", "Quantity", "Product")
    return sales, standins.customers(spark, sf_dir)


def _sales_csv(spark: SparkSession, sf_dir: str) -> str:
    """The job's inputs as headered CSV."""
    base = scratch_path(spark, "segmentation_csv_in")
    sales, customers = _sales_inputs(spark, sf_dir)
    write_csv(sales, f"{base}/sales", header=True)
    write_csv(customers, f"{base}/customer", header=True)
    return base


def _sales_tables(spark: SparkSession, sf_dir: str) -> str:
    """The job's inputs as catalog tables over Parquet."""
    db = _db(spark, "seg")
    for name, df in zip(("sales", "customer"), _sales_inputs(spark, sf_dir)):
        path = scratch_path(spark, f"catalog_{name}")
        df.write.parquet(path)
        catalog.register(spark, f"{db}.{name}", path)
    return db


def segmentation_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's main job end to end: headered CSV in, headerless CSV out."""
    base = _sales_csv(spark, sf_dir)
    sales, customers = _sales_inputs(spark, sf_dir)
    out = scratch_path(spark, "segmentation_csv_out")
    jobs.segmentation_job(spark, f"{base}/sales", f"{base}/customer", out,
                          tiers=standins.STANDIN_TIERS, sales_schema=sales.schema,
                          customer_schema=customers.schema)
    out_schema = ("CustomerID bigint, Name string, Age int, Gender string, "
                  "Total_sales double, Segmentation_column string")
    return read_csv(spark, out, header=False, schema=out_schema)


def segmentation_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and customers as catalog tables over Parquet, result as compact Parquet."""
    db = _sales_tables(spark, sf_dir)
    out = scratch_path(spark, "segmentation_parquet")
    jobs.segmentation_catalog_job(spark, f"{db}.sales", f"{db}.customer", out,
                                  tiers=standins.STANDIN_TIERS)
    catalog.register(spark, f"{db}.customer_segments", out)
    return spark.table(f"{db}.customer_segments")


# --- scans and sinks ---------------------------------------------------------

def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = standins.table(spark, sf_dir, "nation")
    path = land_raw(nation, scratch_path(spark, "landing"), "nation")
    return read_csv(spark, path, header=True, schema=nation.schema)


def _roundtrip(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A table through the headerless CSV sink and back."""
        df = standins.table(spark, sf_dir, name)
        return read_csv(spark, write_csv(df, scratch_path(spark, f"{name}_csv")), header=False, schema=df.schema, own=True)
    return query


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.table(spark, sf_dir, "supplier")


def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


def leaf_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_partition(spark, _events_base(spark, sf_dir), date_partition=DAY)


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as CSV with a ``dd-MM-yyyy`` text date, parsed back."""
    orders = standins.table(spark, sf_dir, "orders")
    text = orders.select("o_orderkey", date_text("o_orderdate").alias("Date"))
    path = land_raw(text, scratch_path(spark, "landing"), "orders_text")
    raw = read_csv(spark, path, schema="o_orderkey bigint, Date string")
    return raw.select("o_orderkey", parse_date("Date").alias("order_date"))


def date_parse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per parsed day, days without a readable date counted as NULL."""
    return partition_counts(date_parse(spark, sf_dir), "order_date")


def partition_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV in two batches -> Parquet by date; rows without a date end in the
    reject table of their batch.  Both tables, marked."""
    events = standins.table(spark, sf_dir, "events")
    text = events.select("event_id", F.when(F.col("event_id") % 50 == 0, "soon")
                         .when(F.col("event_id") % 77 != 0, date_text("ts")).alias("Date"))
    early = F.col("ts") < F.lit(DAY).cast("date")
    base = scratch_path(spark, "partition_job")
    rejected = 0
    for batch, rows in (("early", early), ("late", ~early)):
        path = land_raw(text.where(rows), f"{base}/raw", batch)
        done = jobs.partition_job(spark, path, f"{base}/refined", schema="event_id bigint, Date string", batch=batch)
        rejected += done.rejected
    bad = spark.read.schema("event_id bigint, Date string, batch string").parquet(done.reject_path)
    return (read_parquet(spark, done.path).select("event_id", "Date", PART, F.lit(None).cast("string").alias("batch"))
            .unionByName(bad.select("event_id", "Date", F.lit(None).cast("date").alias(PART), "batch"))
            .withColumn("rejected_in_all", F.lit(rejected).cast("bigint")))


def csv_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in few CSV files (one up to ``CSV_TASK_BYTES`` of input), each read by as
    many tasks as it has splits: texts hold line breaks, so most splits begin inside quotes."""
    docs = standins.table(spark, sf_dir, "documents")
    size = file_inventory(spark, f"{sf_dir.rstrip('/')}/documents.parquet").agg(F.sum("length")).first()[0]
    few = docs.coalesce(max(1, math.ceil(size / CSV_TASK_BYTES)))
    path = write_csv(few, scratch_path(spark, "few_csv"), header=True, quote_all=True)
    return read_csv(spark, path, schema=docs.schema, own=True, split=True, enforceSchema=False)


def partitioned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV by date, read back through the folders."""
    ev = standins.events_with_date(spark, sf_dir)
    path = write_partitioned(ev, scratch_path(spark, "events_csv"), [PART], fmt="csv")
    return read_csv(spark, path, schema=ev.schema, own=True)


def filter_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col(PART) == DAY)


def filter_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("event_type") == KIND)


def filter_data_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data filter over files in Z-order of the event type and the user."""
    path = write_clustered(standins.events_with_date(spark, sf_dir), scratch_path(spark, "events_z"),
                           ["event_type", "user_id"], partition_by=[PART], bloom=["user_id"])
    return read_parquet(spark, path).filter(F.col("event_type") == KIND)


def filter_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.filter((F.col(PART) == DAY) & (F.col("event_type") == KIND))


def filter_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.table(spark, sf_dir, "orders").where(FILTER_SQL)


def data_reduction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return data_reduction(ev, F.col(PART) == DAY, F.col("event_type") == KIND)


def partition_counts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_counts(_events(spark, sf_dir), PART)


def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all days, then rewrite one day with only its clicks."""
    path = write_partitioned(standins.events_with_date(spark, sf_dir),
                             scratch_path(spark, "events_overwrite"), [PART])
    day = read_parquet(spark, path).where((F.col(PART) == DAY)
                                          & (F.col("event_type") == KIND))
    # Materialise the subset before replacing the folder it is read from.
    staged = scratch_path(spark, "events_day_stage")
    day.write.parquet(staged)
    write_partitioned(read_parquet(spark, staged), path, [PART], dynamic=True)
    return read_parquet(spark, path)


def file_inventory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per partition folder of the events: whether it has files, all of them with bytes."""
    files = inventory_by_folder(spark, _events_base(spark, sf_dir), scratch_path(spark, "inventory"), glob="*.parquet")
    day = F.regexp_extract("folder", f"^{PART}=(.*)$", 1).cast("date")
    return files.groupBy(day.alias(PART)).agg(F.min(F.col("length") > 0).alias("all_filled"))


# --- refine and checks -------------------------------------------------------

def customer_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(standins.store_customers(spark, sf_dir), **REFINE)


def validate_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casing verdict counts of both tables: rows tagged by table, unioned,
    one aggregation (one shuffle of partial counts)."""
    raw, refined = _raw_refined(spark, sf_dir)
    both = (raw.select(F.lit("raw").alias("table_name"), "customer_city")
            .unionByName(refined.select(F.lit("refined").alias("table_name"), "customer_city")))
    return uppercase_counts(both, "customer_city", by=["table_name"])


def validate_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _raw_refined(spark, sf_dir)
    return value_counts(refined, "customer_state", allowed=[STATE])


def validate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, refined = _raw_refined(spark, sf_dir)
    return compare_counts([(RAW_LABEL, raw), (REFINED_LABEL, refined)])


def sample_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _raw_refined(spark, sf_dir)
    cols = ["customer_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    return sample_rows(refined, cols, 10, order_by=["customer_id"])


def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _raw_refined(spark, sf_dir)
    return top_k(refined, ["customer_city", "customer_state"], 10, count_name="customer_count")


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent words of all documents: a key of very many values."""
    words = F.explode(F.split("text", r"[ \n]+"))
    return heavy_hitters(standins.table(spark, sf_dir, "documents").select(words.alias("word")).where("word <> ''"),
                         ["word"], 10, count_name="word_count")


def content_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined against raw by content: the true refined table, and one of the same row
    count with one altered cell."""
    raw, refined = _raw_refined(spark, sf_dir)
    first = refined.agg(F.min("customer_id")).first()[0]
    altered = refined.withColumn(
        "customer_city", F.when(F.col("customer_id") == first, "ELSEWHERE").otherwise(F.col("customer_city")))
    parts = [run_checks(raw, table, allowed=REFINE["keep"], upper=REFINE["upper"], content=True)
             .select(F.lit(name).alias("table_name"), "check", "passed") for name, table in (("true", refined), ("altered", altered))]
    return parts[0].unionByName(parts[1])


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, refined = _raw_refined(spark, sf_dir)
    return run_checks(raw, refined, upper=REFINE["upper"], allowed=REFINE["keep"],
                      absent=REFINE["drop"])


def validate_columns_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dropped column is still in raw (fails) and gone from refined (passes)."""
    raw, refined = _raw_refined(spark, sf_dir)
    return validate_columns([(RAW_LABEL, raw), (REFINED_LABEL, refined)], REFINE["drop"])


def sql_validate_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, refined = _catalog_pair(spark, sf_dir)
    return (run_sql_check(spark, "uppercase", raw).select(F.lit("raw").alias("table_name"), "*")
            .unionByName(run_sql_check(spark, "uppercase", refined)
                         .select(F.lit("refined").alias("table_name"), "*")))


def sql_validate_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _catalog_pair(spark, sf_dir)
    return run_sql_check(spark, "state", refined)


def sql_validate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, refined = _catalog_pair(spark, sf_dir)
    return run_sql_check(spark, "row_counts", refined, raw=raw)


def sql_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _catalog_pair(spark, sf_dir)
    return run_sql_check(spark, "sample", refined)


def sql_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined = _catalog_pair(spark, sf_dir)
    return run_sql_check(spark, "top_cities", refined)


# --- catalog -----------------------------------------------------------------

def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standins.store_customers(spark, sf_dir).withColumn("dt", F.lit(RUN_DATES[0]).cast("date"))
    path = write_partitioned(raw, scratch_path(spark, "raw_customers"), ["dt"])
    db = _db(spark, "crawl")
    tables = catalog.crawl(spark, {"customers": path}, db, prefix=RAW_TABLE_PREFIX)
    assert tables.where(F.col("tableName") == f"{RAW_TABLE_PREFIX}customers").count() == 1
    return spark.table(f"{db}.{RAW_TABLE_PREFIX}customers")


def refresh_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = standins.events_with_date(spark, sf_dir)
    path = scratch_path(spark, "events_refresh")
    write_partitioned(ev.where(F.col(PART) <= DAY), path, [PART])
    table = catalog.register(spark, f"{_db(spark, 'refresh')}.events", path)
    write_partitioned(ev.where(F.col(PART) > DAY), path, [PART])
    catalog.refresh(spark, table, mode="new_folders")
    return spark.table(table)


def ledger_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days added, landed again and removed between two looks at the folders, as the
    ledger sees them, with the rows that the table then has."""
    ev = standins.events_with_date(spark, sf_dir)
    path = scratch_path(spark, "events_ledger")
    write_partitioned(ev.where(F.col(PART) <= DAY), path, [PART])
    table = catalog.register(spark, f"{_db(spark, 'ledger')}.events", path)
    ledger = scratch_path(spark, "ledger")
    catalog.refresh_by_ledger(spark, table, ledger)
    write_partitioned(ev.where(F.col(PART) > DAY), path, [PART])
    replace_day(ev.where((F.col(PART) == DAY) & (F.col("event_type") == KIND)), path, PART, DAY)
    remove(spark, f"{path}/{PART}=2024-01-02")
    found = catalog.refresh_by_ledger(spark, table, ledger)
    rows = spark.table(table).groupBy(PART).agg(F.count(F.lit(1)).alias("row_count"))
    day = F.regexp_extract("folder", "=(.*)$", 1).cast("date")
    return found.select(day.alias(PART), "change").join(rows, PART, "left")


def crawl_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl of folders whose files differ: early days lack a column and hold narrower
    numbers."""
    ev = standins.events_with_date(spark, sf_dir)
    path = scratch_path(spark, "events_differ")
    early = F.col(PART) <= DAY
    write_partitioned(ev.where(early).drop("props").withColumn("user_id", F.col("user_id").cast("int")), path, [PART])
    write_partitioned(ev.where(~early), path, [PART])
    db = _db(spark, "union")
    catalog.crawl(spark, {"events": path}, db, merge=True)
    return spark.table(f"{db}.events")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = standins.events_with_date(spark, sf_dir)
    path = scratch_path(spark, "events_drift")
    write_partitioned(ev.where(F.col(PART) <= DAY).drop("props"), path,
                      [PART])
    table = catalog.register(spark, f"{_db(spark, 'drift')}.events", path)
    newer = ev.where(F.col(PART) > DAY)
    write_partitioned(newer, path, [PART])
    catalog.evolve(spark, table, newer.schema)
    catalog.refresh(spark, table, mode="new_folders")
    return spark.table(table)


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _db(spark, "stats")
    parts = []
    for name in ("customer", "orders", "part"):
        catalog.register(spark, f"{db}.{name}", f"{sf_dir.rstrip('/')}/{name}.parquet")
        parts.append(catalog.table_stats(spark, f"{db}.{name}")
                     .select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- extract, landing, daily run ---------------------------------------------

def _landing(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A table extracted to the raw landing and read back."""
        df = standins.table(spark, sf_dir, name)
        base = scratch_path(spark, "raw")
        jobs.extract_job(spark, df, base, name, RUN_DATES[0], source="parquet")
        schema = T.StructType(df.schema.fields + [T.StructField("dt", T.DateType())])
        return read_csv(spark, f"{base}/{name}", schema=schema, own=True, basePath=f"{base}/{name}")
    return query


def extract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "raw")
    audit = f"{base}/_audit"
    for name in ("customer", "supplier"):
        jobs.extract_job(spark, standins.table(spark, sf_dir, name), base, name, RUN_DATES[0],
                         source="parquet", audit_path=audit)
    # landed again: the audit row is replaced
    jobs.extract_job(spark, standins.table(spark, sf_dir, "supplier"), base, "supplier", RUN_DATES[0],
                     source="parquet", audit_path=audit)
    return read_audit(spark, audit).select("source", "table_name", "run_date", "extracted_rows")


def extract_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables at a time; one fails (twice), an empty one lands nothing."""
    good = standins.table(spark, sf_dir, "supplier")
    fails = good.withColumn("s_name", F.raise_error(F.lit("source is down")).cast("string"))
    base = scratch_path(spark, "many")
    out = jobs.extract_many(spark, {"supplier": good, "down": fails, "none": good.limit(0),
                                    "nation": standins.table(spark, sf_dir, "nation")},
                            base, RUN_DATES[0], source="parquet", audit_path=f"{base}/_audit", attempts=2)
    rows = read_audit(spark, f"{base}/_audit").select("table_name", "extracted_rows")
    return (out.join(rows, "table_name", "left")
            .select("table_name", F.col("path").isNotNull().alias("landed"), F.col("error").isNotNull().alias("failed"),
                    "attempts", "extracted_rows"))


def extract_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in eight slices; the source breaks at the fifth, the next run goes on there."""
    orders = standins.table(spark, sf_dir, "orders")
    base = scratch_path(spark, "sliced")

    def breaks(s: Slice) -> DataFrame:
        if s.number == 4:
            raise ConnectionError("source is down")
        return orders.where(s.predicate("o_orderkey"))

    args = dict(base=base, table="orders", column="o_orderkey", slices=8, source="parquet")
    try:
        extract_sliced(orders, breaks, **args)
    except ConnectionError:
        extract_sliced(orders, lambda s: orders.where(s.predicate("o_orderkey")), **args)
    return read_sliced(spark, base, "orders", orders.schema)


def daily_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "daily")
    db = _db(spark, "daily")
    source = standins.store_customers(spark, sf_dir)
    for ds in (RUN_DATES[0], RUN_DATES[1], RUN_DATES[1]):   # second day twice
        jobs.daily_job(spark, ds, source, root=root, database=db, table="customers", **REFINE)
    return spark.table(f"{db}.{REFINED_TABLE_PREFIX}customers")


def daily_refine_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over a table whose texts hold line breaks, quotes and blanks."""
    root = scratch_path(spark, "daily_text")
    db = _db(spark, "daily_text")
    jobs.daily_job(spark, RUN_DATES[0], standins.table(spark, sf_dir, "documents"), root=root, database=db,
                   table="documents", **REFINE_TEXT)
    return spark.table(f"{db}.{REFINED_TABLE_PREFIX}documents")


def daily_refine_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2 has its columns in another order, one in another case, one new and one gone."""
    root = scratch_path(spark, "daily_drift")
    db = _db(spark, "daily_drift")
    day = standins.store_customers(spark, sf_dir)
    changed = day.select("customer_state", F.col("customer_city").alias("CUSTOMER_CITY"), "customer_unique_id",
                         "customer_id", F.concat(F.lit("store "), F.col("customer_id").cast("string")).alias("store_note"))
    for ds, source in zip(RUN_DATES, (day, changed)):
        jobs.daily_job(spark, ds, source, root=root, database=db, table="customers", **REFINE)
    return spark.table(f"{db}.{REFINED_TABLE_PREFIX}customers")


def daily_refine_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days on which a number is an int, a bigint, then a decimal."""
    root = scratch_path(spark, "daily_wide")
    db = _db(spark, "daily_wide")
    day = standins.store_customers(spark, sf_dir)
    for ds, kind in zip(WIDE_DATES, ("int", "bigint", "decimal(22,2)")):
        number = F.col("customer_zip_code_prefix").cast(kind)
        if kind.startswith("decimal"):
            number = (number + F.lit(0.25).cast("decimal(3,2)")).cast(kind)
        jobs.daily_job(spark, ds, day.withColumn("customer_zip_code_prefix", number), root=root, database=db,
                       table="customers", **REFINE)
    return spark.table(f"{db}.{REFINED_TABLE_PREFIX}customers")


def incremental_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "incremental")
    source = standins.store_customers(spark, sf_dir)
    schema = T.StructType(source.schema.fields + [T.StructField("dt", T.DateType())])
    # the second day is landed twice, and a last run finds nothing new
    for ds in (*RUN_DATES, RUN_DATES[1], None):
        if ds:
            land_raw(source, f"{root}/raw", "customers", ds)
        refine_new_landings(spark, f"{root}/raw/customers", schema, f"{root}/refined",
                            f"{root}/_checkpoint", **REFINE)
    return read_parquet(spark, f"{root}/refined")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer_segmentation": customer_segmentation,
    "segmentation_exact_money": segmentation_exact_money,
    "segmentation_csv_job": segmentation_csv_job,
    "segmentation_catalog": segmentation_catalog,
    "csv_scan": csv_scan,
    **{("csv_headerless_roundtrip" if t == "nation" else f"csv_headerless_roundtrip_{t}"): _roundtrip(t)
       for t in ("nation", *TEXT_TABLES)},
    "parquet_scan": parquet_scan,
    "partitioned_scan": partitioned_scan,
    "leaf_partition_scan": leaf_partition_scan,
    "date_parse": date_parse,
    "date_parse_counts": date_parse_counts,
    "csv_split_scan": csv_split_scan,
    "partitioned_csv": partitioned_csv,
    "partition_csv_job": partition_csv_job,
    "filter_partition": filter_partition,
    "filter_data": filter_data,
    "filter_data_clustered": filter_data_clustered,
    "filter_combined": filter_combined,
    "filter_expression": filter_expression,
    "data_reduction": data_reduction_report,
    "partition_counts": partition_counts_report,
    "dynamic_overwrite": dynamic_overwrite,
    "customer_refine": customer_refine,
    "validate_uppercase": validate_uppercase,
    "validate_state": validate_state,
    "validate_row_counts": validate_row_counts,
    "sample_rows": sample_refined,
    "top_cities": top_cities,
    "top_words": top_words,
    "content_report": content_report,
    "validation_report": validation_report,
    "validate_columns": validate_columns_report,
    "sql_validate_uppercase": sql_validate_uppercase,
    "sql_validate_state": sql_validate_state,
    "sql_validate_row_counts": sql_validate_row_counts,
    "sql_sample_rows": sql_sample_rows,
    "sql_top_cities": sql_top_cities,
    "register_table": register_table,
    "refresh_partitions": refresh_partitions,
    "ledger_refresh": ledger_refresh,
    "crawl_union": crawl_union,
    "schema_drift": schema_drift,
    "table_stats": table_stats,
    **{("raw_landing" if t == "customer" else f"raw_landing_{t}"): _landing(t) for t in ("customer", *TEXT_TABLES)},
    "extract_audit": extract_audit,
    "extract_many": extract_many_tables,
    "extract_resumed": extract_resumed,
    "daily_refine": daily_refine,
    "daily_refine_text": daily_refine_text,
    "daily_refine_drift": daily_refine_drift,
    "daily_refine_widening": daily_refine_widening,
    "incremental_refine": incremental_refine,
    "file_inventory": file_inventory_report,
}

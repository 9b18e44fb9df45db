"""Daily run idempotence, incremental refine, entry contract."""

import os

from pyspark.sql import functions as F

from refinery.jobs import daily_job, segmentation_job
from refinery.sources.files import file_inventory
from refinery.streaming.new_folders import refine_new_landings
from refinery.sinks.audit import read_audit
from refinery.sinks.files import land_raw, write_csv
from refinery.sources.files import read_parquet
from pyspark.sql import types as T

from test_quality import raw_customers

REFINE = dict(keep={"customer_state": ["SP"]}, upper=["customer_city"], drop=["customer_unique_id"])


def _files(spark, path):
    return {(r.path, r.length, r.modificationTime)
            for r in file_inventory(spark, path, glob="*.parquet").collect()}


def test_daily_job_idempotent_and_leaves_other_days(spark, tmp):
    src = raw_customers(spark)
    r1 = daily_job(spark, "2024-02-01", src, root=tmp, database="daily_t", table="customers",
                   fail_on_check=False, **REFINE)
    # the NULL city of customer 5 fails the casing check (NULL = UPPER(NULL) is unknown)
    assert {v.check: v.passed for v in r1["verdict"]} == {
        "uppercase:customer_city": False, "allowed:customer_state": True,
        "absent:customer_unique_id": True, "landed": True, "landed_content": True, "row_counts": True, "content": True}
    src = src.where(F.col("customer_city").isNotNull())
    day_a = _files(spark, f"{tmp}/refined/customers/dt=2024-02-01")
    daily_job(spark, "2024-02-02", src, root=tmp, database="daily_t", table="customers", **REFINE)
    assert _files(spark, f"{tmp}/refined/customers/dt=2024-02-01") == day_a
    before = sorted(map(tuple, spark.table("daily_t.refined_customers").collect()))
    daily_job(spark, "2024-02-02", src, root=tmp, database="daily_t", table="customers", **REFINE)
    after = sorted(map(tuple, spark.table("daily_t.refined_customers").collect()))
    assert before == after and len(after) == 7 + 6
    assert spark.table("daily_t.raw2_customers").count() == 9 + 8
    audit = read_audit(spark, f"{tmp}/audit")     # one row a day, also for the day run twice
    assert audit.count() == 2 and audit.agg(F.sum("extracted_rows")).first()[0] == 9 + 8


def test_daily_job_empty_extract_writes_nothing(spark, tmp):
    empty = raw_customers(spark).limit(0)
    out = daily_job(spark, "2024-02-03", empty, root=tmp, database="daily_e", table="c", **REFINE)
    assert out["landed"] is None and not os.path.exists(f"{tmp}/raw".replace("file:", ""))


def test_incremental_refine_processes_only_new_landings(spark, tmp):
    src = raw_customers(spark)
    schema = T.StructType(src.schema.fields + [T.StructField("dt", T.DateType())])
    args = (spark, f"{tmp}/raw/c", schema, f"{tmp}/refined", f"{tmp}/ckpt")
    land_raw(src, f"{tmp}/raw", "c", "2024-03-01")
    refine_new_landings(*args, **REFINE)
    assert read_parquet(spark, f"{tmp}/refined").count() == 7
    land_raw(src, f"{tmp}/raw", "c", "2024-03-02")
    refine_new_landings(*args, **REFINE)
    refine_new_landings(*args, **REFINE)          # nothing new
    out = read_parquet(spark, f"{tmp}/refined")
    assert out.count() == 14
    assert {str(r.dt) for r in out.select("dt").distinct().collect()} == {"2024-03-01", "2024-03-02"}
    land_raw(src.limit(2), f"{tmp}/raw", "c", "2024-03-02")          # landed again, with fewer rows
    refine_new_landings(*args, **REFINE)
    days = {str(r.dt): r["count"] for r in read_parquet(spark, f"{tmp}/refined").groupBy("dt").count().collect()}
    assert days == {"2024-03-01": 7, "2024-03-02": src.limit(2).where("customer_state = 'SP'").count()}
    land_raw(src.where("customer_state = 'RJ'"), f"{tmp}/raw", "c", "2024-03-01")   # nothing of it is kept
    refine_new_landings(*args, **REFINE)
    assert {str(r.dt) for r in read_parquet(spark, f"{tmp}/refined").select("dt").collect()} == {"2024-03-02"}


def test_corrupt_landing_fails_the_day(spark, tmp, monkeypatch):
    from refinery import jobs

    def corrupt(df, base, table, ds, **kw):          # Spark's own CSV defaults: a line break splits the row
        path = f"{base}/{table}/dt={ds}"
        df.write.mode("overwrite").option("header", True).csv(path)
        return path, df.count()

    src = spark.createDataFrame([(1, "u", "0", "SAO\nPAULO", "SP"), (2, "u", "0", "RIO", "SP")], raw_customers(spark).schema)
    good = daily_job(spark, "2024-04-01", src, root=f"{tmp}/a", database="daily_ok", table="c", **REFINE)
    assert all(v.passed for v in good["verdict"])
    assert {r.customer_city for r in spark.table("daily_ok.refined_c").collect()} == {"SAO\nPAULO", "RIO"}
    monkeypatch.setattr(jobs, "land_with_audit", corrupt)
    quotes = src.withColumn("customer_unique_id", F.lit('"'))
    bad = daily_job(spark, "2024-04-01", quotes, root=f"{tmp}/b", database="daily_bad", table="c", fail_on_check=False, **REFINE)
    assert {v.check: v.passed for v in bad["verdict"]}["landed"] is False


def test_day_without_kept_rows_replaces_the_old_answer(spark, tmp):
    src = raw_customers(spark).where("customer_city is not null")
    for rows in (src, src.where("customer_state = 'RJ'")):
        out = daily_job(spark, "2024-05-01", rows, root=tmp, database="daily_none", table="c", **REFINE)
    assert spark.table("daily_none.refined_c").count() == 0 and all(v.passed for v in out["verdict"])


def test_drift_in_the_daily_run(spark, tmp):
    import pytest
    from refinery.jobs import SchemaChanged
    cols = "id int, city string, st string"
    args = dict(root=tmp, database="daily_drift", table="c", keep={"st": ["SP"]}, upper=["city"], drop=[])
    daily_job(spark, "2024-06-01", spark.createDataFrame([(1, "rio", "SP")], cols), **args)
    two = spark.createDataFrame([("SP", "x", 2, "belo")], "st string, extra string, ID int, city string")
    out = daily_job(spark, "2024-06-02", two, **args)
    assert out["drift"] == {"added": ["extra"], "deprecated": [], "changed": []}
    daily_job(spark, "2024-06-03", spark.createDataFrame([(3, "SP", "y")], "id int, st string, extra string").withColumn(
        "city", F.lit("ita")), **args)
    rows = sorted((r.id, r.city, r.st, r.extra, str(r.dt)) for r in spark.table("daily_drift.refined_c").collect())
    assert rows == [(1, "RIO", "SP", None, "2024-06-01"), (2, "BELO", "SP", "x", "2024-06-02"),
                    (3, "ITA", "SP", "y", "2024-06-03")]
    assert sorted((r.id, r.extra) for r in spark.table("daily_drift.raw2_c").collect()) == [(1, None), (2, "x"), (3, "y")]
    with pytest.raises(SchemaChanged, match="id: int -> string"):
        daily_job(spark, "2024-06-04", spark.createDataFrame([("4", "a", "SP")], "id string, city string, st string"), **args)


def test_segmentation_job_csv_to_csv(spark, tmp):
    sales = spark.createDataFrame([("P", 100, 300, "C1"), ("P", 100, 1, "C2")],
                                  "Product string, Price int, Quantity int, CustomerID string")
    cust = spark.createDataFrame([("C1", "a", 1, "F"), ("C2", "b", 2, "M")],
                                 "CustomerID string, Name string, Age int, Gender string")
    write_csv(sales, f"{tmp}/s", header=True)
    write_csv(cust, f"{tmp}/c", header=True)
    out = segmentation_job(spark, f"{tmp}/s", f"{tmp}/c", f"{tmp}/o")
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["C1,a,1,F,30000,High Value", "C2,b,2,M,100,Low Value"]


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["CustomerID", "Name", "Age", "Gender", "Total_sales", "Segmentation_column"]
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    own = {k for k in q if not (k.startswith("op") and k[2].isdigit()) and k != "pipeline"}
    assert set(o) <= set(q) and own <= set(o)
    assert all(o[k].strip() for k in o)

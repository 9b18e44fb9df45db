"""spark-submit entry points, driven in-process on the test session."""

import pytest
from pyspark.sql import functions as F

from refinery.cli import run
from refinery.sinks.files import write_csv
from refinery.sources.files import read_parquet

from test_quality import raw_customers

REFINE_ARGS = ["--keep", "customer_state=SP", "--upper", "customer_city",
               "--drop", "customer_unique_id"]


def _sales(spark, tmp):
    sales = spark.createDataFrame([("P", 500, 56, "C1"), ("P", 100, 200, "C2"), ("P", 5, 1, "C3")],
                                  "Product string, Price int, Quantity int, CustomerID string")
    cust = spark.createDataFrame([("C1", "a", 1, "F"), ("C2", "b", 2, "M"), ("C3", "c", 3, "M")],
                                 "CustomerID string, Name string, Age int, Gender string")
    write_csv(sales, f"{tmp}/s", header=True)
    write_csv(cust, f"{tmp}/c", header=True)


def test_segment_command_default_and_custom_tiers(spark, tmp):
    _sales(spark, tmp)
    assert run(spark, ["segment", f"{tmp}/s", f"{tmp}/c", f"{tmp}/o"]) == 0
    lines = sorted(r.value for r in spark.read.text(f"{tmp}/o").collect())
    assert lines == ["C1,a,1,F,28000,High Value", "C2,b,2,M,20000,Medium Value",
                     "C3,c,3,M,5,Low Value"]
    run(spark, ["segment", f"{tmp}/s", f"{tmp}/c", f"{tmp}/o2", "--tier", "20000:Top",
                "--default-label", "Rest", "--sales-schema",
                "Product string, Price int, Quantity int, CustomerID string"])
    lines = sorted(r.value for r in spark.read.text(f"{tmp}/o2").collect())
    assert [line.rsplit(",", 1)[1] for line in lines] == ["Top", "Top", "Rest"]


def test_partition_refine_validate_commands(spark, tmp):
    orders = spark.createDataFrame([(1, "21-12-1999"), (2, "23-12-1999"), (3, "23-12-1999")],
                                   "OrderID int, Date string")
    write_csv(orders, f"{tmp}/orders", header=True)
    run(spark, ["partition", f"{tmp}/orders", f"{tmp}/by_day",
                "--schema", "OrderID int, Date string"])
    days = read_parquet(spark, f"{tmp}/by_day").groupBy("date_partition").count()
    assert {(str(r[0]), r[1]) for r in days.collect()} == {("1999-12-21", 1), ("1999-12-23", 2)}

    raw = raw_customers(spark).where(F.col("customer_city").isNotNull())
    write_csv(raw, f"{tmp}/raw_day", header=True)
    schema = ", ".join(f"{n} {t}" for n, t in raw.dtypes)
    run(spark, ["refine", "--database", "cli_db", "--input", f"{tmp}/raw_day",
                "--input-schema", schema, "--refined-table", "refined_customers",
                "--output", f"{tmp}/refined", "--run-date", "2024-05-01", *REFINE_ARGS])
    refined = spark.table("cli_db.refined_customers")
    assert refined.count() == 6 and "customer_unique_id" not in refined.columns
    raw.createOrReplaceTempView("cli_raw_customers")
    assert run(spark, ["validate", "--raw-table", "cli_raw_customers",
                       "--refined-table", "cli_db.refined_customers",
                       "--run-date", "2024-05-01", *REFINE_ARGS]) == 0
    # a check that cannot pass gives exit status 1
    assert run(spark, ["validate", "--raw-table", "cli_raw_customers",
                       "--refined-table", "cli_db.refined_customers",
                       "--keep", "customer_state=RJ"]) == 1


def test_daily_command_from_a_source_path(spark, tmp):
    src = f"{tmp}/src"
    raw_customers(spark).write.parquet(src)
    args = ["daily", "--run-date", "2024-06-01", "--source-path", src, "--root", f"{tmp}/d",
            "--database", "cli_daily", "--table", "customers", *REFINE_ARGS]
    assert run(spark, args) == 1                      # NULL city fails the casing check
    assert run(spark, args + ["--no-fail"]) == 0
    assert spark.table("cli_daily.refined_customers").count() == 7
    assert run(spark, args[:5] + ["--where", "customer_city IS NOT NULL"] + args[5:]) == 0


def test_bad_arguments_are_rejected(spark):
    with pytest.raises(SystemExit):
        run(spark, ["segment", "only-one-path"])
    with pytest.raises(SystemExit):
        run(spark, ["daily", "--run-date", "2024-01-01", "--root", "x", "--database", "d",
                    "--table", "t", "--keep", "no-equals-sign", "--source-table", "t"])


def test_segment_catalog_command(spark, tmp):
    from refinery import catalog
    sales = spark.createDataFrame([(500, 56, "C1"), (100, 200, "C2"), (5, 1, "C3")],
                                  "Price int, Quantity int, CustomerID string")
    cust = spark.createDataFrame([("C1", "a", 1, "F"), ("C2", "b", 2, "M"), ("C3", "c", 3, "M")],
                                 "CustomerID string, Name string, Age int, Gender string")
    catalog.create_database(spark, "cli_seg", location=f"{tmp}/db")
    for name, df in (("sales", sales), ("customer", cust)):
        df.write.parquet(f"{tmp}/{name}")
        catalog.register(spark, f"cli_seg.{name}", f"{tmp}/{name}")
    assert run(spark, ["segment-catalog", "--sales-table", "cli_seg.sales",
                       "--customer-table", "cli_seg.customer", "--output", f"{tmp}/out",
                       "--register-as", "cli_seg.segments"]) == 0
    got = {r.CustomerID: (r.Total_sales, r.Segmentation_column)
           for r in spark.table("cli_seg.segments").collect()}
    assert got == {"C1": (28000, "High Value"), "C2": (20000, "Medium Value"),
                   "C3": (5, "Low Value")}


def test_jdbc_arguments_without_a_connection(spark, tmp):
    from refinery.cli import _properties
    props = f"{tmp.replace('file:', '')}.properties"
    with open(props, "w", encoding="utf-8") as fh:
        fh.write("# credentials\nuser = etl\npassword=s3cr=t\n\n")
    assert _properties(props) == {"user": "etl", "password": "s3cr=t"}
    with pytest.raises(SystemExit):      # a JDBC source needs its table
        run(spark, ["daily", "--run-date", "2024-01-01", "--jdbc-url", "jdbc:postgresql://h/db",
                    "--root", tmp, "--database", "d", "--table", "t"])


def test_crawl_refresh_and_versions(spark, tmp, capsys):
    from refinery.sinks.files import write_partitioned
    day = lambda ds, n: spark.range(n).withColumn("dt", F.lit(ds).cast("date"))
    write_partitioned(day("2024-01-01", 3), f"{tmp}/t", ["dt"])
    write_partitioned(day("2024-01-02", 4).withColumn("note", F.lit("x")), f"{tmp}/t", ["dt"])
    assert run(spark, ["crawl", f"t={tmp}/t", "--database", "cli_crawl", "--prefix", "raw_", "--merge"]) == 0
    assert set(spark.table("cli_crawl.raw_t").columns) == {"id", "note", "dt"}
    ledger = ["refresh", "cli_crawl.raw_t", "--ledger", f"{tmp}/ledger"]
    run(spark, ledger)
    write_partitioned(day("2024-01-03", 5), f"{tmp}/t", ["dt"])
    capsys.readouterr()
    assert run(spark, ledger) == 0 and capsys.readouterr().out == "added  dt=2024-01-03\n"
    assert spark.table("cli_crawl.raw_t").count() == 12
    write_partitioned(day("2024-01-04", 1), f"{tmp}/t", ["dt"])
    run(spark, ["refresh", "cli_crawl.raw_t", "--new-folders"])
    assert spark.table("cli_crawl.raw_t").count() == 13
    with pytest.raises(SystemExit):
        run(spark, ["crawl", "no-path", "--database", "d"])


def test_refine_publishes_through_the_table(spark, tmp, capsys):
    raw = raw_customers(spark).where(F.col("customer_city").isNotNull())
    raw.createOrReplaceTempView("cli_raw_versions")
    schema = ", ".join(f"{n} {t}" for n, t in raw.dtypes)
    table = ["--raw-table", "cli_raw_versions", "--refined-table", "cli_ver.refined_customers", "--run-date", "2024-05-01"]
    for i, rows in enumerate((raw, raw.where("customer_state = 'RJ'"), raw)):
        write_csv(rows, f"{tmp}/raw_day{i}", header=True)
        assert run(spark, ["refine", "--database", "cli_ver", "--input", f"{tmp}/raw_day{i}", "--input-schema", schema,
                           "--refined-table", "refined_customers", "--output", f"{tmp}/refined", "--run-date", "2024-05-01",
                           *REFINE_ARGS]) == 0
        assert spark.table("cli_ver.refined_customers").count() == (0 if i == 1 else 6)
        assert run(spark, ["validate", "--content", *table, *REFINE_ARGS]) == (1 if i == 1 else 0)
    capsys.readouterr()
    assert run(spark, ["drop-old-versions", "cli_ver.refined_customers", f"{tmp}/refined"]) == 0
    assert capsys.readouterr().out.count("removed") == 2 and spark.table("cli_ver.refined_customers").count() == 6

"""CSV/Parquet sinks and sources, raw landing, audit, JDBC options,
file inventory."""

import pytest
from pyspark.sql import functions as F

from refinery.jobs import extract_many
from refinery.plans.inspect import files_read
from refinery.sinks.audit import land_with_audit
from refinery.sinks.files import land_raw, write_compact, write_csv
from refinery.sources.files import file_inventory, read_csv, read_parquet
from refinery.sources.jdbc import jdbc_options

SALES_CSV = "Date,Product,Category,Price,Quantity,CustomerID\n2023-10-01,P_A,Electronics,500,10,C1\n2023-10-02,P_B,Clothing,20,3,C2\n"


def test_csv_inference_types(spark, tmp):
    import os
    d = tmp.replace("file:", "")
    os.makedirs(d)
    with open(f"{d}/sales.csv", "w") as fh:
        fh.write(SALES_CSV)
    df = read_csv(spark, f"{tmp}/sales.csv")
    assert dict(df.dtypes) == {"Date": "date", "Product": "string", "Category": "string",
                               "Price": "int", "Quantity": "int", "CustomerID": "string"}


def test_headerless_default_write(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    path = write_csv(df, f"{tmp}/out")
    text = spark.read.text(path).collect()
    assert [r.value for r in text] == ["1,a"]


def test_land_raw_skips_empty_extract(spark, tmp):
    empty = spark.createDataFrame([], "k int")
    assert land_raw(empty, tmp, "t", "2024-01-01") is None
    assert file_inventory(spark, tmp.rsplit("/", 1)[0], glob="*.csv").where(
        F.col("path").contains(tmp.rsplit("/", 1)[1])).count() == 0


def test_land_raw_layout_and_audit_count(spark, tmp):
    df = spark.range(0, 1234).withColumn("v", F.col("id") * 2)
    path, rows = land_with_audit(df, tmp, "nums", "2024-01-02", source="test")
    assert path.endswith("/nums/dt=2024-01-02") and rows == 1234
    back = read_csv(spark, f"{tmp}/nums", schema="id bigint, v bigint, dt date")
    assert back.count() == 1234 and back.select("dt").distinct().count() == 1


def test_write_compact_small_result_is_one_snappy_file(spark, tmp):
    df = spark.range(0, 5000, numPartitions=8)
    path = write_compact(df.groupBy((F.col("id") % 10).alias("k")).count(), f"{tmp}/c")
    files = [r.file_path for r in files_read(read_parquet(spark, path)).collect()]
    assert len(files) == 1 and files[0].endswith(".snappy.parquet")


def test_extract_many_continues_after_failure(spark, tmp):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    out = {r.table_name: r for r in extract_many(spark, {"bad": bad, "good": good}, tmp,
                                                 "2024-01-01", source="t").collect()}
    assert out["good"].path.endswith("good/dt=2024-01-01") and out["good"].error is None
    assert out["bad"].path is None and "boom" in out["bad"].error


def test_extract_errors_are_kept_whole(spark, tmp):
    long = "x" * 2000
    bad = spark.range(3).select(F.raise_error(F.lit(f"{long}end")).cast("string").alias("x"))
    out = extract_many(spark, {"bad": bad}, tmp, "2024-01-01", source="t").collect()
    assert f"{long}end" in out[0].error


def test_file_inventory_lists_everything(spark, tmp):
    spark.range(100).repartition(4).write.parquet(f"{tmp}/p")
    inv = file_inventory(spark, f"{tmp}/p", glob="*.parquet")
    assert inv.columns == ["path", "length", "modificationTime"]
    assert inv.count() == 4 and inv.where("length <= 0").count() == 0


def test_jdbc_options_quote_and_partition():
    o = jdbc_options("jdbc:postgresql://h/db", "customers", "public", partition_column="id",
                     lower_bound=0, upper_bound=1000, num_partitions=8)
    assert o["dbtable"] == '"public"."customers"'
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "1000", "8")
    assert jdbc_options("jdbc:mysql://h/db", "t", "s")["dbtable"] == "`s`.`t`"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:mysql://h/db", "t`; drop table x", None)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://h/db", "t", partition_column="id")


def test_partitioned_csv_sink(spark, tmp):
    from refinery.sinks.files import write_partitioned
    df = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-02")],
                               "id int, v string, date_partition string")
    path = write_partitioned(df.withColumn("date_partition", F.col("date_partition").cast("date")),
                             f"{tmp}/csv", ["date_partition"], fmt="csv")
    back = read_csv(spark, path, schema="id int, v string, date_partition date")
    assert sorted((r.id, str(r.date_partition)) for r in back.collect()) == [
        (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")]


def test_csv_contract_keeps_every_value(spark, tmp):
    """Line breaks, blanks, quotes, commas, empty against NULL, microseconds."""
    import datetime as dt
    from refinery.sinks.files import write_partitioned
    texts = ["a\nb", "a\r\nb", "a\rb", " lead", "trail ", '"', 'say ""hi"', "x,y", "", None, "\\", "#c", "\t", "  ", "null",
             'end\\"', "\\n", "é漢😀"]
    rows = [(i, t, dt.datetime(2024, 1, 2, 3, 4, 5, 123456), dt.datetime(2024, 1, 2, 3, 4, 5, 7), 0.1 * i if i else None, "d")
            for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, t string, ts timestamp, n timestamp_ntz, x double, day string")
    want = sorted(map(tuple, df.collect()), key=repr)
    land_raw(df, tmp, "texts")
    for back in (read_csv(spark, f"{tmp}/texts", schema=df.schema, own=True),
                 read_csv(spark, write_csv(df, f"{tmp}/plain", quote_all=True), header=False, schema=df.schema, own=True),
                 read_csv(spark, write_partitioned(df, f"{tmp}/parted", ["day"], fmt="csv"), schema=df.schema, own=True)):
        assert sorted(map(tuple, back.collect()), key=repr) == want
    with pytest.raises(Exception, match="NULL mark"):
        write_csv(spark.createDataFrame([("\\N",)], "t string"), f"{tmp}/mark")
    with pytest.raises(Exception, match="carriage return"):
        write_csv(spark.createDataFrame([("a\rb",)], "t string"), f"{tmp}/cr")


def test_inventory_by_folder(spark, tmp):
    from refinery.sources.files import inventory_by_folder
    df = spark.range(50).withColumn("day", F.col("id") % 5)
    df.write.partitionBy("day").parquet(f"{tmp}/t")
    got = inventory_by_folder(spark, f"{tmp}/t", f"{tmp}/list", glob="*.parquet", folders=2)
    plain = file_inventory(spark, f"{tmp}/t", glob="*.parquet")
    assert sorted(r.path for r in got.collect()) == sorted(r.path for r in plain.collect())
    assert {r.folder for r in got.collect()} == {f"day={i}" for i in range(5)}
    assert all(f"/{r.folder}/" in r.path for r in got.collect())


def test_unpartitioned_jdbc_read_is_refused(spark):
    from refinery.sources.jdbc import read_jdbc
    with pytest.raises(ValueError, match="partition_column"):
        read_jdbc(spark, "jdbc:postgresql://h/db", "customers")


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace
    from refinery.session import checkpoint_root

    def session(master):
        conf = SimpleNamespace(get=lambda *a: None)
        sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master, setCheckpointDir=lambda p: None)
        return SimpleNamespace(sparkContext=sc, conf=conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session("spark://host:7077"))
    assert checkpoint_root(session("local[2]"))

"""CSV files read by splits give the rows of Spark's multi-line reader."""

import os
import random

import pytest

from refinery import queries
from refinery.csv_format import reader_options
from refinery.jobs import segmentation_job
from refinery.sinks.files import write_csv
from refinery.sources.csv_split import read_split_csv, records
from refinery.sources.files import file_inventory, read_csv

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def small_splits(spark):
    """Call it with the bytes of a split."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def use(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1")
    yield use
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_one_file_of_texts_is_read_by_many_tasks(spark, tmp, small_splits):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = write_csv(docs.coalesce(1), tmp, header=True)
    small_splits("200k")
    plain = read_csv(spark, path, schema=docs.schema, own=True)
    split = read_csv(spark, path, schema=docs.schema, own=True, split=True, enforceSchema=False)
    assert plain.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() >= 13
    assert _rows(split) == _rows(docs)


def test_query_writes_a_large_table_by_several_tasks(spark, tmp, small_splits, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.repartition(8).write.parquet(f"{tmp}/documents.parquet")
    size = sum(r.length for r in file_inventory(spark, f"{tmp}/documents.parquet").collect())
    small_splits("200k")
    for files in (1, 4):
        monkeypatch.setattr(queries, "CSV_TASK_BYTES", size // files + 1, raising=False)
        got = queries.csv_split_scan(spark, tmp)
        written = [f for f in got.inputFiles() if f.endswith(".csv")]
        assert len(written) == files and got.rdd.getNumPartitions() >= 13
        assert _rows(got) == _rows(docs)


@pytest.mark.parametrize("size", ["25", "300"])
def test_random_values_over_tiny_splits(spark, tmp, small_splits, size):
    rng = random.Random(int(size))
    marks = ["a", '"', "\n", "\r\n", ",", " ", '""', "é", "\\", "\r", '","', "\n\n"]
    rows = [(rng.choice([None, i]), None if rng.random() < .1 else "".join(rng.choice(marks) for _ in range(rng.randint(0, 30))))
            for i in range(10 if size == "25" else 50)] + [(7, "x\n" * 30), (8, None), (None, None)]
    df = spark.createDataFrame([r for r in rows if r[1] != "\\N"], "a int, t string")
    path = write_csv(df.coalesce(2), tmp, header=True, quote_all=True)
    small_splits(size)
    assert _rows(read_split_csv(spark, path, df.schema, own=True, enforceSchema=False)) == _rows(df)


FOREIGN = {
    "crlf": 'a,t\r\n1,"x\r\ny"\r\n2,"p ""q"" r"\r\n\r\n3,plain\r\n4,"a\nb\r\n\r\nc"\r\n5,',
    "lf": 'a,t\n1,"x\r\ny"\n2,"p ""q"" r"\n\n3,plain\n4,"a\nb\n\nc"\n5,z\n',
    "no end": 'a,t\n1,"x\ny"\n2,b',
    "header only": "a,t\n", "empty": "", "blanks": 'a,t\n  \n1,  x  \n7,""\n,\\N\n',
}


@pytest.mark.parametrize("kind", FOREIGN)
def test_foreign_files(spark, tmp, small_splits, kind):
    path = tmp.replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/f.csv", "w", newline="") as f:
        f.write(FOREIGN[kind])
    want = _rows(read_csv(spark, path, schema="a int, t string"))
    small_splits("20")
    assert _rows(read_csv(spark, path, schema="a int, t string", split=True)) == want


def test_what_fails(spark, tmp, small_splits):
    path = tmp.replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/f.csv", "w") as f:
        f.write('a,t\n1,"open\n2,x\n3,y\n')
    small_splits("6")
    with pytest.raises(ValueError, match="don't pair up"):
        read_split_csv(spark, path, "a int, t string")
    kept = records(spark, path, unpaired="keep").collect()
    assert sorted(r.record for r in kept) == ['1,"open\n2,x\n3,y', "a,t"]
    with pytest.raises(ValueError, match="escape"):
        read_split_csv(spark, path, "a int, t string", escape="\\")
    with open(f"{path}/f.csv", "w") as f:
        f.write("a,t\n1,x\n")
    assert _rows(read_split_csv(spark, path, "A int, T string", enforceSchema=False)) == ["Row(A=1, T='x')"]
    for schema in ("t string, a int", "a int", "a int, t string, u string"):
        with pytest.raises(Exception, match="CSV header differs"):
            read_split_csv(spark, path, schema, enforceSchema=False).collect()


def test_types_and_options_are_those_of_the_reader(spark, tmp, small_splits):
    df = spark.range(200).selectExpr(
        "id", "cast(id as decimal(12,3)) as d", "timestamp_micros(id * 1234567) as ts", "id % 2 = 0 as b", "id / 3 as x")
    path = write_csv(df.coalesce(1), tmp, header=True)
    small_splits("1500")
    got = read_csv(spark, path, schema=df.schema, own=True, split=True)
    assert got.schema.simpleString() == df.schema.simpleString() and _rows(got) == _rows(df)
    assert reader_options(True)["multiLine"] == "true"


def test_segmentation_over_one_large_file(spark, tmp, small_splits):
    sales = spark.range(1500).selectExpr("concat('line\n', id) as Product", "id % 50 as Price", "id % 3 as Quantity",
                                         "id % 40 as CustomerID")
    cust = spark.range(40).selectExpr("id as CustomerID", "concat('n', id) as Name", "int(id) as Age", "'F' as Gender")
    write_csv(sales.coalesce(1), f"{tmp}/s", header=True)
    write_csv(cust.coalesce(1), f"{tmp}/c", header=True)
    args = dict(sales_schema=sales.schema, customer_schema=cust.schema)
    whole = segmentation_job(spark, f"{tmp}/s", f"{tmp}/c", f"{tmp}/whole", **args)
    small_splits("2k")
    assert read_csv(spark, f"{tmp}/s", schema=sales.schema, split=True).rdd.getNumPartitions() >= 13
    split = segmentation_job(spark, f"{tmp}/s", f"{tmp}/c", f"{tmp}/split", **args)
    assert sorted(r.value for r in spark.read.text(split).collect()) == sorted(r.value for r in spark.read.text(whole).collect())

"""Type lattice, folder ledger, schema union of a crawl, streams that read names only."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import catalog
from refinery.catalog import ledger, types
from refinery.sinks.files import replace_day, write_partitioned


def _local(path):
    return path.replace("file:", "")


def _type(text):
    return T.StructType.fromDDL(f"c {text}")["c"].dataType


@pytest.mark.parametrize("a, b, want", [
    ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("bigint", "decimal(22,2)", "decimal(22,2)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("float", "double", "double"),
    ("int", "double", "double"), ("bigint", "double", None), ("int", "string", None), ("date", "timestamp", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("string", "string", "string"), ("boolean", "int", None),
    ("struct<x:int>", "struct<x:bigint>", "struct<x:bigint>"), ("struct<x:int>", "struct<y:int>", None)])
def test_lattice(spark, a, b, want):
    a, b = _type(a), _type(b)
    assert types.widest(a, b) == types.widest(b, a) == (_type(want) if want else None)
    if want and a != b:
        assert types.widens(a, b) == (b == _type(want)) and types.widens(b, a) == (a == _type(want))


def test_files_of_narrower_types_read_as_the_wider(spark, tmp):
    """What the lattice promises, by Spark's own Parquet reader."""
    kinds = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(7,2)", "decimal(12,4)", "decimal(12,0)", "decimal(24,2)"]
    for a in kinds:
        df = spark.range(5).select((F.col("id") - 2).cast(a).alias("c"), F.lit("x").alias("s"))
        df.write.parquet(f"{tmp}/{kinds.index(a)}")
        for b in kinds:
            if types.widens(_type(a), _type(b)):
                got = spark.read.schema(f"c {b}, s string").parquet(f"{tmp}/{kinds.index(a)}")
                assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.withColumn("c", F.col("c").cast(b)).collect()))


def _days(spark, days, kind="int"):
    return spark.range(4).select(F.col("id").cast(kind).alias("id"), F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("dt"))


def test_ledger_sees_what_changed(spark, tmp):
    path, book = f"{tmp}/t", f"{tmp}/book"
    write_partitioned(_days(spark, ["2024-01-01", "2024-01-02", "2024-01-03"]), path, ["dt"])
    catalog.create_database(spark, "up_a", location=f"{tmp}/db")
    table = catalog.register(spark, "up_a.t", path)
    look = lambda: {(r.folder, r.change) for r in catalog.refresh_by_ledger(spark, table, book).collect()}
    assert look() == {(f"dt=2024-01-0{i}", "added") for i in (1, 2, 3)} and look() == set()
    write_partitioned(_days(spark, ["2024-01-04"]), path, ["dt"])
    replace_day(_days(spark, ["2024-01-02"]), path, "dt", "2024-01-02")          # the same rows, landed again
    shutil.rmtree(_local(f"{path}/dt=2024-01-03"))
    (spark.range(1).write.parquet(f"{path}/_notes"))                              # not a partition
    assert look() == {("dt=2024-01-04", "added"), ("dt=2024-01-02", "changed"), ("dt=2024-01-03", "vanished")}
    assert {str(r.dt): r["count"] for r in spark.table(table).groupBy("dt").count().collect()} == {
        "2024-01-01": 4, "2024-01-02": 4, "2024-01-04": 4}
    catalog.refresh(spark, table, mode="ledger", ledger=book)
    with pytest.raises(ValueError):
        catalog.refresh(spark, table, mode="ledger")
    with pytest.raises(ValueError):
        catalog.refresh(spark, catalog.register(spark, "up_a.flat", f"{path}/dt=2024-01-01"), mode="ledger", ledger=f"{tmp}/b2")


def test_ledger_is_written_after_the_work(spark, tmp):
    path = write_partitioned(_days(spark, ["2024-01-01"]), f"{tmp}/t", ["dt"])
    listing = ledger.list_folders(spark, path)
    found = ledger.changes(listing, ledger.read_ledger(spark, f"{tmp}/book")).collect()
    assert [tuple(r) for r in found] == [("dt=2024-01-01", "added")]              # nothing written: found again
    assert ledger.changes(listing, ledger.read_ledger(spark, f"{tmp}/book")).count() == 1
    ledger.write_ledger(listing, f"{tmp}/book")
    assert ledger.changes(listing, ledger.read_ledger(spark, f"{tmp}/book")).count() == 0
    row = listing.first()
    assert row.files >= 1 and row.bytes > 0 and row.newest is not None


def test_crawl_merges_folders_that_differ(spark, tmp):
    path = f"{tmp}/t"
    days = {"2024-01-01": ("int", None), "2024-01-02": ("bigint", "note"), "2024-01-03": ("decimal(22,2)", "note"),
            "2024-01-04": ("int", "other")}
    for day, (kind, extra) in days.items():
        df = _days(spark, [day], kind).drop("dt")
        (df.withColumn(extra, F.lit("x")) if extra else df).write.parquet(f"{path}/dt={day}/part=a")
    columns, partitions, conflicts = catalog.union_schema(spark, path, width=3)
    assert conflicts == {} and {f.name: f.dataType.simpleString() for f in columns} == {
        "id": "decimal(22,2)", "note": "string", "other": "string"}
    assert partitions.names == ["dt", "part"]
    catalog.crawl(spark, {"t": path}, "up_b", location=f"{tmp}/db", merge=True)
    rows = {(str(r.dt), int(r.id), r.note, r.other) for r in spark.table("up_b.t").collect()}
    assert rows == {(d, i, "x" if e == "note" else None, "x" if e == "other" else None) for d, (_, e) in days.items() for i in range(4)}


def test_crawl_reports_conflicts(spark, tmp):
    path = f"{tmp}/t"
    for day, kind in (("2024-01-01", "int"), ("2024-01-02", "string")):
        _days(spark, [day], kind).drop("dt").write.parquet(f"{path}/dt={day}")
    with pytest.raises(catalog.SchemaConflict, match=r"id is .*2024-01-01: int, .*2024-01-02: string"):
        catalog.crawl(spark, {"t": path}, "up_c", location=f"{tmp}/db", merge=True)

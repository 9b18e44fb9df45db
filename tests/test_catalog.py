"""Catalog registration, partition refresh, schema evolution, stats."""

import shutil

from pyspark.sql import functions as F

from refinery import catalog
from refinery.sinks.files import write_partitioned
from refinery.sources.files import read_parquet


def _days(spark, days):
    rows = [(i, f"n{i}", d) for d in days for i in range(3)]
    return spark.createDataFrame(rows, "id int, name string, dt string").withColumn("dt", F.col("dt").cast("date"))


def test_register_recovers_partitions_and_lists(spark, tmp):
    path = write_partitioned(_days(spark, ["2024-01-01", "2024-01-02"]), f"{tmp}/t", ["dt"])
    tables = catalog.crawl(spark, {"things": path}, "cat_a", prefix="raw2_", location=f"{tmp}/db")
    assert [r.tableName for r in tables.collect()] == ["raw2_things"]
    t = spark.table("cat_a.raw2_things")
    assert t.count() == 6 and t.columns[-1] == "dt"


def test_refresh_new_folders_and_everything(spark, tmp):
    path = write_partitioned(_days(spark, ["2024-01-01"]), f"{tmp}/t", ["dt"])
    catalog.create_database(spark, "cat_b", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_b.t", path)
    write_partitioned(_days(spark, ["2024-01-02"]), path, ["dt"])
    assert spark.table(table).count() == 3          # not yet known to the catalog
    catalog.refresh(spark, table, mode="new_folders")
    assert spark.table(table).count() == 6
    shutil.rmtree(path.replace("file:", "") + "/dt=2024-01-01")
    catalog.refresh(spark, table, mode="new_folders")     # keeps the vanished entry
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    catalog.refresh(spark, table, mode="everything")      # drops it
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1
    assert spark.table(table).count() == 3


def test_add_partition_registers_only_the_named_day(spark, tmp):
    path = write_partitioned(_days(spark, ["2024-01-01"]), f"{tmp}/t", ["dt"])
    catalog.create_database(spark, "cat_p", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_p.t", path)
    write_partitioned(_days(spark, ["2024-01-02", "2024-01-03"]), path, ["dt"])
    catalog.add_partition(spark, table, {"dt": "2024-01-03"})
    catalog.add_partition(spark, table, {"dt": "2024-01-03"})     # again: no-op
    days = sorted(str(r.dt) for r in spark.table(table).select("dt").distinct().collect())
    assert days == ["2024-01-01", "2024-01-03"]                  # 01-02 not listed
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2


def test_evolve_adds_columns_and_deprecates(spark, tmp):
    old = _days(spark, ["2024-01-01"])
    path = write_partitioned(old, f"{tmp}/t", ["dt"])
    catalog.create_database(spark, "cat_c", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_c.t", path)
    new = _days(spark, ["2024-01-02"]).withColumn("extra", F.lit("x"))
    write_partitioned(new, path, ["dt"])
    change = catalog.evolve(spark, table, new.schema)
    catalog.refresh(spark, table)
    assert change == {"added": ["extra"], "deprecated": [], "changed": []}
    got = {(str(r.dt), r.extra) for r in spark.table(table).collect()}
    assert got == {("2024-01-01", None), ("2024-01-02", "x")}
    change = catalog.evolve(spark, table, new.drop("name").schema)
    assert change == {"added": [], "deprecated": ["name"], "changed": []}
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert props["deprecated"] == "true" and props["deprecated_columns"] == "name"
    assert "name" in spark.table(table).columns       # data left alone


def test_evolve_compares_names_as_spark_does_and_reports_types(spark, tmp):
    import pytest
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    df.write.parquet(f"{tmp}/t")
    catalog.create_database(spark, "cat_n", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_n.t", f"{tmp}/t")
    assert catalog.evolve(spark, table, df.withColumnRenamed("id", "Id").schema) == {
        "added": [], "deprecated": [], "changed": []}
    changed = catalog.evolve(spark, table, df.withColumn("id", F.col("id").cast("string")).schema)
    assert changed["changed"] == ["id: int -> string"]
    with pytest.raises(ValueError):
        catalog.list_tables(spark, "a`b")


def test_table_stats(spark, tmp):
    path = write_partitioned(_days(spark, ["2024-01-01", "2024-01-02"]), f"{tmp}/t", ["dt"])
    catalog.create_database(spark, "cat_d", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_d.t", path)
    r = catalog.table_stats(spark, table).collect()[0]
    assert r.row_count == 6 and r.size_bytes > 0
    assert r.size_pretty == _pg_size_pretty(r.size_bytes)


def test_register_csv_with_schema(spark, tmp):
    df = _days(spark, ["2024-01-03"])
    df.drop("dt").write.option("header", True).csv(f"{tmp}/raw/dt=2024-01-03")
    catalog.create_database(spark, "cat_e", location=f"{tmp}/db")
    table = catalog.register(spark, "cat_e.raw", f"{tmp}/raw", fmt="csv",
                             schema=df.schema, partition_by=("dt",))
    t = spark.table(table)
    assert dict(t.dtypes) == {"id": "int", "name": "string", "dt": "date"}
    assert t.count() == 3
    assert read_parquet  # imported for symmetry with other tests


def test_paths_and_values_with_quotes_are_escaped(spark, tmp):
    df = _days(spark, ["2024-01-04"])
    base = f"{tmp}/it's here"
    df.drop("dt").write.option("header", True).csv(f"{base}/dt=2024-01-04")
    catalog.create_database(spark, "cat_q", location=f"{tmp}/db'q")
    table = catalog.register(spark, "cat_q.raw", base, fmt="csv", schema=df.schema,
                             partition_by=("dt",))
    assert spark.table(table).count() == 3
    df.drop("dt").write.option("header", True).csv(f"{base}/dt=2024-01-05")
    catalog.add_partition(spark, table, {"dt": "2024-01-05"})
    assert spark.table(table).count() == 6


def _pg_size_pretty(size):
    # plain-Python statement of the same published rule, for comparison
    def tdiv(a, b):
        q = abs(a) // b
        return q if a >= 0 else -q
    if abs(size) < 10240:
        return f"{size} bytes"
    v = tdiv(size, 512)
    for unit in ("kB", "MB", "GB", "TB"):
        if abs(v) < 20479:
            return f"{tdiv(v + (1 if v >= 0 else -1), 2)} {unit}"
        v = tdiv(v, 1024)
    return f"{tdiv(v + (1 if v >= 0 else -1), 2)} PB"


def test_pretty_size_matches_the_rule(spark):
    from refinery.functions.columns import pretty_size
    values = [0, 1, 7403, 10239, 10240, 10751, 10752, 1_000_000, 10_485_759, 10_485_760,
              10_484_000_000, 1 << 40, (1 << 50) * 3, 123_456_789_012_345, -20_000]
    df = spark.createDataFrame([(v,) for v in values], "b bigint")
    got = [r.p for r in df.select(pretty_size("b").alias("p")).collect()]
    assert got == [_pg_size_pretty(v) for v in values]
    assert got[2] == "7403 bytes" and got[7] == "977 kB" and got[9] == "10 MB"

"""Partitioned write, pruning and pushdown (plan tests), leaf scans,
dynamic overwrite, the reduction report."""

import os

from pyspark.sql import functions as F

from refinery.jobs import partition_job
from refinery.operators.pruning import data_reduction, partition_counts
from refinery.plans.inspect import files_read, scan_filters
from refinery.sinks.files import write_csv, write_partitioned
from refinery.sources.files import read_parquet, read_partition

# Demo orders: customer and day both follow the id with the same period, so a
# customer only ever orders on one day.
PERIOD = 7
FIRST_DAY = 3                   # of June 2021


def demo_orders(spark):
    """84 orders: customer K0..K6 and day 03-06-2021 .. 09-06-2021 by id % 7."""
    turn = F.col("id") % PERIOD
    return spark.range(84).select(
        F.col("id").cast("int").alias("OrderID"),
        F.format_string("item-%03d", "id").alias("OrderName"),
        F.concat(F.lit("K"), turn.cast("string")).alias("Customer"),
        F.format_string("%02d-06-2021", turn + FIRST_DAY).alias("Date"))


def _demo_refined(spark, tmp):
    write_csv(demo_orders(spark), f"{tmp}/raw", header=True)
    return partition_job(spark, f"{tmp}/raw", f"{tmp}/refined").path


def test_demo_counts_and_reduction(spark, tmp):
    path = _demo_refined(spark, tmp)
    df = read_parquet(spark, path)
    assert df.columns[-1] == "date_partition"
    assert dict(df.dtypes)["date_partition"] == "date"
    rep = [tuple(r) for r in data_reduction(df, F.col("date_partition") == "2021-06-05",
                                            F.col("Customer") == "K0").collect()]
    # K0 orders on the 3rd only: none on the 5th
    assert rep == [("no_filter", 84, 0.0), ("partition_filter", 12, 85.7),
                   ("data_filter", 12, 85.7), ("both_filters", 0, 100.0)]
    counts = [tuple(r) for r in partition_counts(df, "date_partition").collect()]
    assert [c for _, c in counts] == [12] * 7
    assert str(counts[0][0]) == "2021-06-03"


def test_uneven_rule_counts(spark, tmp):
    """36 rows: the day is id % 4, the buyer id % 3, so each pair meets on a twelfth."""
    df = spark.range(36).select(
        "id", F.concat(F.lit("buyer"), (F.col("id") % 3).cast("string")).alias("Customer"),
        F.format_string("%02d-11-2022", F.col("id") % 4 + 10).alias("Date")).where("id <> 35")
    write_csv(df, f"{tmp}/raw", header=True)
    ref = read_parquet(spark, partition_job(spark, f"{tmp}/raw", f"{tmp}/refined").path)
    rep = {r.scenario: (r.row_count, r.reduction_pct) for r in data_reduction(
        ref, F.col("date_partition") == "2022-11-12", F.col("Customer") == "buyer2").collect()}
    assert rep == {"no_filter": (35, 0.0), "partition_filter": (9, 74.3),
                   "data_filter": (11, 68.6), "both_filters": (3, 91.4)}
    assert {str(d): n for d, n in partition_counts(ref, "date_partition").collect()} == {
        "2022-11-10": 9, "2022-11-11": 9, "2022-11-12": 9, "2022-11-13": 8}


def test_partition_filter_prunes_folders(spark, tmp):
    df = read_parquet(spark, _demo_refined(spark, tmp))
    q = df.filter(F.col("date_partition") == "2021-06-05")
    f = scan_filters(q)
    assert any("(date_partition = 2021-06-05)" in x for x in f["PartitionFilters"][0])
    paths = [r.file_path for r in files_read(q).collect()]
    assert paths and all("date_partition=2021-06-05" in p for p in paths)
    assert files_read(df).count() > len(paths)


def test_data_filter_is_pushed(spark, tmp):
    df = read_parquet(spark, _demo_refined(spark, tmp))
    f = scan_filters(df.filter(F.col("Customer") == "K0"))
    assert "EqualTo(Customer,K0)" in f["PushedFilters"][0]
    assert not any(f["PartitionFilters"])


def test_combined_filter_has_both(spark, tmp):
    df = read_parquet(spark, _demo_refined(spark, tmp))
    q = df.filter((F.col("date_partition") == "2021-06-05") & (F.col("Customer") == "K0"))
    f = scan_filters(q)
    assert any("date_partition = 2021-06-05" in x for x in f["PartitionFilters"][0])
    assert "EqualTo(Customer,K0)" in f["PushedFilters"][0]
    assert q.count() == 0


def test_projection_prunes_columns(spark, tmp):
    df = read_parquet(spark, _demo_refined(spark, tmp))
    f = scan_filters(df.select("OrderID"))
    assert f["ReadSchema"][0] == ["struct<OrderID:int>"]


def test_leaf_scan_loses_partition_column_unless_base_path(spark, tmp):
    path = _demo_refined(spark, tmp)
    leaf = read_partition(spark, path, date_partition="2021-06-05")
    assert "date_partition" not in leaf.columns and leaf.count() == 12
    kept = read_partition(spark, path, keep_partition_column=True, date_partition="2021-06-05")
    assert kept.columns[-1] == "date_partition" and kept.count() == 12


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmp):
    path = _demo_refined(spark, tmp)
    day = read_parquet(spark, path).where(F.col("date_partition") == "2021-06-05").limit(3)
    staged = f"{tmp}/stage"
    day.write.parquet(staged)
    write_partitioned(read_parquet(spark, staged), path, ["date_partition"], dynamic=True)
    counts = {str(d): n for d, n in partition_counts(read_parquet(spark, path), "date_partition").collect()}
    assert counts == {f"2021-06-{d:02d}": 3 if d == 5 else 12 for d in range(3, 10)}


def test_rows_without_a_date_are_kept_and_counted_by_batch(spark, tmp):
    schema = "OrderID int, Date string"
    write_csv(spark.createDataFrame([(1, "21-06-2021"), (2, "not a date"), (3, None)], schema), f"{tmp}/raw1", header=True)
    write_csv(spark.createDataFrame([(4, "22-06-2021"), (5, "31-02-2021")], schema), f"{tmp}/raw2", header=True)
    one = partition_job(spark, f"{tmp}/raw1", f"{tmp}/refined", schema=schema)
    two = partition_job(spark, f"{tmp}/raw2", f"{tmp}/refined", schema=schema)
    again = partition_job(spark, f"{tmp}/raw2", f"{tmp}/refined", schema=schema)
    assert (one.rejected, two.rejected, again.rejected) == (2, 1, 1)
    assert sorted(r.OrderID for r in read_parquet(spark, two.path).collect()) == [1, 4]
    bad = read_parquet(spark, two.reject_path)
    assert sorted(r.OrderID for r in bad.collect()) == [2, 3, 5] and bad.select("batch").distinct().count() == 2
    assert not os.path.isdir(two.path.replace("file:", "") + "/date_partition=__HIVE_DEFAULT_PARTITION__")


def test_rebalanced_write_makes_one_file_per_small_partition(spark, tmp):
    path = write_partitioned(demo_orders(spark).repartition(8), f"{tmp}/p", ["Customer"])
    files = [r.file_path for r in files_read(read_parquet(spark, path)).collect()]
    assert len(files) == PERIOD


def test_hot_partition_value_is_split_over_several_files(spark, tmp):
    """A day holding a third of all rows is not written by one task: the
    rebalance lets AQE split it by the advisory size; no row is lost."""
    n = 60_000
    df = spark.range(n, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 20).cast("string")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(256 << 10))
    try:
        path = write_partitioned(df, f"{tmp}/hot", ["day"])
    finally:
        spark.conf.set(key, old)
    out = read_parquet(spark, path)
    hot_files = [r.file_path for r in files_read(out.where(F.col("day") == "hot")).collect()]
    assert len(hot_files) > 1
    assert out.count() == n and out.where(F.col("day") == "hot").count() == n // 3


def test_data_reduction_matches_python_counts(spark):
    """Random rows with NULLs in both filtered columns: counts and percents
    equal a plain Python count (a NULL predicate keeps nothing)."""
    from hypothesis import given, settings, strategies as st

    day = st.one_of(st.none(), st.sampled_from(["2024-01-01", "2024-01-02", "2024-01-03"]))
    kind = st.one_of(st.none(), st.sampled_from(["click", "view"]))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(day, kind), min_size=1, max_size=60))
    def check(rows):
        df = spark.createDataFrame(rows, "d string, k string").withColumn("d", F.col("d").cast("date"))
        got = {r.scenario: (r.row_count, r.reduction_pct) for r in
               data_reduction(df, F.col("d") == "2024-01-02", F.col("k") == "click").collect()}
        n = len(rows)
        kept = {"no_filter": n,
                "partition_filter": sum(d == "2024-01-02" for d, _ in rows),
                "data_filter": sum(k == "click" for _, k in rows),
                "both_filters": sum(d == "2024-01-02" and k == "click" for d, k in rows)}
        assert got == {s: (c, round(100 * (n - c) / n, 1)) for s, c in kept.items()}

    check()

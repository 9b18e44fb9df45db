"""Z-order and bloom filters skip row groups; heavy hitters are those of the exact count."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.operators import heavy_hitters as hh
from refinery.operators.quality import top_k
from refinery.plans import rows_scanned
from refinery.sinks.clustered import write_clustered, z_number
from refinery.sinks.files import write_partitioned


@pytest.fixture()
def one_file(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_filters_read_under_half_of_the_rows(spark, tmp, one_file):
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet").withColumn("d", F.lit(1))
    plain = write_partitioned(ev, f"{tmp}/plain", ["d"], **{"parquet.block.size": 256 << 10})
    laid = write_clustered(ev, f"{tmp}/z", ["event_type", "user_id"], partition_by=["d"], row_group_bytes=256 << 10)
    n = ev.count()
    for cond in (F.col("event_type") == "click", F.col("user_id") == 77, F.col("user_id") < 100):
        wanted = ev.where(cond).count()
        got = spark.read.parquet(laid).where(cond)
        assert got.count() == wanted
        assert rows_scanned(got) < n / 2 and rows_scanned(spark.read.parquet(plain).where(cond)) > 0.9 * n
    assert spark.read.parquet(laid).count() == n


def test_bloom_filters_skip_for_equality(spark, tmp, one_file):
    df = spark.range(60_000).select(F.col("id"), F.xxhash64("id").alias("key"), F.lit("x" * 20).alias("pad"))
    keys = [r.key for r in df.where("id in (5, 31000)").collect()]
    paths = {bloom: write_clustered(df, f"{tmp}/{bool(bloom)}", ["id"], bloom=bloom, row_group_bytes=128 << 10) for bloom in ((), ("key",))}
    read = {bloom: sum(rows_scanned(spark.read.parquet(p).where(F.col("key") == k)) for k in keys) for bloom, p in paths.items()}
    assert read[("key",)] < read[()] / 2
    assert all(spark.read.parquet(p).where(F.col("key") == keys[0]).count() == 1 for p in paths.values())


def test_z_numbers_interleave_ranks(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).cast("int").alias("b"))
    rows = df.withColumn("z", z_number(df, ["a", "b"], bits=2)).collect()
    for r in rows:
        # the quantiles of 0..15 are 3, 7 and 11: a value's rank is how many are below it
        ra, rb = (sum(q < x for q in (3, 7, 11)) for x in (r.a, r.b))
        assert r.z == sum(((ra >> i & 1) << 2 * i) | ((rb >> i & 1) << 2 * i + 1) for i in range(2))
    odd = spark.createDataFrame([(None, None, "é"), (1, None, "a"), (2, None, None)], "n int, t timestamp, s string")
    assert odd.select(z_number(odd, ["n", "t", "s"], bits=3)).count() == 3
    with pytest.raises(ValueError):
        z_number(df, ["a", "b"], bits=40)


def test_each_column_is_ranked_once_a_row(spark):
    df = spark.range(3000).selectExpr("int(xxhash64(id) % 500) as a", "if(id % 7 = 0, null, if(id % 11 = 0, double('NaN'), id % 13)) as b")
    shares = [i / 256 for i in range(1, 256)]
    edges = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 2560).alias(c) for c in "ab"]).first()
    got = df.withColumn("z", z_number(df, ["a", "b"]))
    order = lambda x: (x != x, x)           # NaN is the greatest
    for r in got.collect():
        ranks = [0 if x is None else sum(order(e) < order(float(x)) for e in edges[c]) for c, x in (("a", r.a), ("b", r.b))]
        assert r.z == sum((rank >> i & 1) << 2 * i + j for i in range(8) for j, rank in enumerate(ranks))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("cast(a#") == 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=6), st.integers(1, 12))
def test_summaries_bound_every_count(parts, capacity):
    whole = hh.Summary(capacity)
    for part in parts:
        one = hh.Summary(capacity)
        for i in range(0, len(part), 7):
            one.add(np.array(part[i:i + 7], np.int64))
        whole.merge(one.values, one.counts, one.error)
    got = dict(zip(whole.values.tolist(), whole.counts.tolist()))
    true = {x: sum(p.count(x) for p in parts) for x in range(31)}
    assert len(got) <= capacity
    assert all(got.get(x, 0) <= true[x] <= got.get(x, 0) + whole.error for x in true)


@pytest.mark.parametrize("capacity", [16, 200, 4096])
def test_heavy_hitters_are_exact(spark, capacity, monkeypatch):
    rng = random.Random(3)
    rows = [(f"w{int(rng.paretovariate(0.7))}", rng.choice([None, "x"])) for _ in range(20_000)]
    rows += [(f"tie{i}", None) for i in range(6) for _ in range(500)] + [(None, None)] * 900
    df = spark.createDataFrame(rows, "w string, k string").repartition(5)
    want = [tuple(r) for r in top_k(df, ["w", "k"], 10).collect()]
    assert [tuple(r) for r in hh.heavy_hitters(df, ["w", "k"], 10, capacity=capacity).collect()] == want
    monkeypatch.setattr(hh, "MOST", 8)                              # no capacity is allowed: the exact count
    assert [tuple(r) for r in hh.heavy_hitters(df, ["w", "k"], 10, capacity=capacity).collect()] == want
    assert hh.heavy_hitters(df.limit(0), ["w"], 3).collect() == []
    assert len(hh.heavy_hitters(df.where("w = 'tie1'"), ["w"], 3).collect()) == 1


def test_only_summaries_and_candidates_are_shuffled(spark):
    df = spark.range(100_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.col("id") % 9).otherwise(F.col("id")).alias("x"))
    found = hh.heavy_hitters(df, ["x"], 3, capacity=64)
    assert {r.x for r in found.collect()} == {0, 3, 6}
    plan = found._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan

"""Many extracts at a time, and extracts that go on where they stopped."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from refinery import jobs
from refinery.sinks.audit import read_audit
from refinery.sources.slices import Slice, extract_sliced, pending, plan_slices, read_ledger, read_sliced


def test_a_slow_and_a_failing_table_do_not_hold_the_others(spark, tmp, monkeypatch):
    good = spark.range(10).select("id", F.lit("a").alias("t"))
    bad = good.withColumn("t", F.raise_error(F.lit("down")).cast("string"))
    done, real, release = [], jobs.land_with_audit, threading.Event()

    def watched(df, base, table, ds, **kw):
        if table == "slow":
            assert release.wait(60)
        out = real(df, base, table, ds, **kw)
        done.append((table, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        if len(done) == 3:
            release.set()
        return out

    monkeypatch.setattr(jobs, "land_with_audit", watched)
    began = time.time()
    out = {r.table_name: r for r in jobs.extract_many(
        spark, {"slow": good, "bad": bad, "a": good, "b": good, "c": good}, tmp, "2024-01-01", source="t",
        audit_path=f"{tmp}/audit", workers=2, attempts=3).collect()}
    assert time.time() - began < 60 and [t for t, _ in done] == ["a", "b", "c", "slow"] and dict(done)["a"] == "extract-a"
    assert out["bad"].attempts == 3 and "down" in out["bad"].error and out["bad"].path is None
    assert all(out[t].error is None and out[t].attempts == 1 for t in ("slow", "a", "b", "c"))
    audit = {r.table_name: r for r in read_audit(spark, f"{tmp}/audit").collect()}
    assert set(audit) == {"slow", "a", "b", "c"} and all(r.extracted_rows == 10 and r.content for r in audit.values())


def test_a_table_that_works_at_the_second_try(spark, tmp, monkeypatch):
    real, tries = jobs.land_with_audit, []

    def flaky(df, base, table, ds, **kw):
        tries.append(table)
        if len(tries) == 1:
            raise ConnectionError("reset")
        return real(df, base, table, ds, **kw)

    monkeypatch.setattr(jobs, "land_with_audit", flaky)
    row = jobs.extract_many(spark, {"t": spark.range(3)}, tmp, None, source="t", attempts=2).first()
    assert row.error is None and row.attempts == 2 and spark.read.option("header", True).csv(row.path).count() == 3


def _source(spark):
    return spark.range(1000).select(F.when(F.col("id") % 50 != 0, F.when(F.col("id") < 300, 7).otherwise(F.col("id"))).alias("k"),
                                    F.col("id").alias("v"))


def test_a_broken_extract_reads_only_what_is_missing(spark, tmp):
    source, asked = _source(spark), []

    def read(s: Slice, broken=()):
        asked.append(s.number)
        if s.number in broken:
            raise ConnectionError("down")
        return source.where(s.predicate("k"))

    args = dict(base=tmp, table="t", column="k", slices=6, source="parquet")
    for broken, want in (((2,), [0, 1, 2]), ((4,), [2, 3, 4])):
        with pytest.raises(ConnectionError):
            extract_sliced(source, lambda s, b=broken: read(s, b), **args)
        assert asked == want
        asked.clear()
    ledger = extract_sliced(source, read, **args)
    assert asked[0] == 4 and asked == sorted(set(asked)) and not {0, 1, 2, 3} & set(asked)
    assert ledger.agg(F.sum("rows")).first()[0] == 1000
    assert sorted(map(str, read_sliced(spark, tmp, "t", source.schema).collect())) == sorted(map(str, source.collect()))
    asked.clear()
    extract_sliced(source, read, **args)
    assert asked == []


def test_a_slice_that_fails_midway_leaves_no_rows(spark, tmp):
    source = _source(spark).repartition(4)
    bad = source.withColumn("v", F.when(F.col("k") == 901, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v")))
    args = dict(base=tmp, table="t", column="k", slices=3, source="parquet")
    with pytest.raises(Exception, match="broken"):
        extract_sliced(source, lambda s: bad.where(s.predicate("k")), **args)
    landed = read_sliced(spark, tmp, "t", source.schema).count()
    assert landed == read_ledger(spark, f"{tmp}/_ledger/t").agg(F.sum("rows")).first()[0] < 1000
    extract_sliced(source, lambda s: source.where(s.predicate("k")), **args)
    assert read_sliced(spark, tmp, "t", source.schema).count() == 1000


def test_slices_are_balanced_and_kept(spark, tmp):
    source = spark.range(10_000).select((F.col("id") * F.col("id")).alias("k"), F.timestamp_seconds("id").alias("ts"))
    planned = plan_slices(source, "k", 8, f"{tmp}/plan")
    assert planned == plan_slices(source.limit(0), "k", 3, f"{tmp}/plan")             # as written the first time
    sizes = [source.where(s.predicate("k")).count() for s in planned]
    assert sum(sizes) == 10_000 and max(sizes) < 2 * 10_000 / 8
    stamps = plan_slices(source, "ts", 4, f"{tmp}/plan_ts")
    assert sum(source.where(s.predicate("ts")).count() for s in stamps) == 10_000 and len(stamps) == 4
    assert pending(spark, planned, f"{tmp}/none") == planned
    assert len(plan_slices(source.limit(0), "k", 4, f"{tmp}/plan_empty")) == 1

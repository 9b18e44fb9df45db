"""A day is there, whole, whatever happens to the run that replaces it; contents are checked."""

import os

import pytest
from pyspark.sql import functions as F

from refinery import catalog, jobs
from refinery.functions.digest import content_digest
from refinery.jobs import CheckFailed, SchemaChanged, daily_job, validate_job
from refinery.operators.quality import run_checks
from refinery.sinks import publish
from refinery.sinks.audit import land_with_audit, read_audit
from refinery.sinks.files import land_raw, replace_day
from refinery.sources.files import read_csv

ARGS = dict(keep={"st": ["SP"]}, upper=["city"], drop=[])
COLS = "id int, city string, st string"


def _breaks(df):
    """``df`` that fails in its last rows, after some were written."""
    return df.withColumn("city", F.when(F.col("id") >= 900, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("city")))


def _day(spark, n=1000, city="rio"):
    return spark.range(n).select(F.col("id").cast("int"), F.lit(city).alias("city"), F.lit("SP").alias("st"))


def _local(path):
    return path.replace("file:", "")


def test_a_failed_write_leaves_the_day(spark, tmp):
    day = _day(spark).repartition(4)
    replace_day(day, f"{tmp}/t", "dt", "2024-01-01")
    land_raw(day, f"{tmp}/raw", "c", "2024-01-01")
    for write in (lambda: replace_day(_breaks(day), f"{tmp}/t", "dt", "2024-01-01"),
                  lambda: land_raw(_breaks(day), f"{tmp}/raw", "c", "2024-01-01")):
        with pytest.raises(Exception, match="broken"):
            write()
    assert spark.read.parquet(f"{tmp}/t").count() == 1000
    assert read_csv(spark, f"{tmp}/raw/c/dt=2024-01-01", schema=COLS).count() == 1000
    assert os.listdir(_local(f"{tmp}/t")) == ["dt=2024-01-01"] and os.listdir(_local(f"{tmp}/raw/c")) == ["dt=2024-01-01"]


def test_a_replacement_that_stopped_half_way_is_mended(spark, tmp):
    day = _day(spark, 10)
    folder = replace_day(day, f"{tmp}/t", "dt", "2024-01-01")
    os.rename(_local(folder), _local(f"{tmp}/t/.old-dt=2024-01-01"))      # the run stopped after the first rename
    publish.restore(spark, folder)
    assert spark.read.parquet(f"{tmp}/t").count() == 10
    os.makedirs(_local(f"{tmp}/t/.old-dt=2024-01-01"))                    # or before it cleaned up
    replace_day(_day(spark, 20), f"{tmp}/t", "dt", "2024-01-01")
    assert spark.read.parquet(f"{tmp}/t").count() == 20 and os.listdir(_local(f"{tmp}/t")) == ["dt=2024-01-01"]


def test_a_table_keeps_the_old_version_until_the_new_one_is_there(spark, tmp, monkeypatch):
    args = dict(root=tmp, database="pub_a", table="c", **ARGS)
    for ds in ("2024-01-01", "2024-01-02"):
        daily_job(spark, ds, _day(spark), **args)
    table, path = "pub_a.refined_c", f"{tmp}/refined/c"
    before = catalog.partition_location(spark, table, {"dt": "2024-01-01"})
    monkeypatch.setattr(jobs, "refine", lambda df, **kw: _breaks(df))
    with pytest.raises(Exception, match="broken"):
        daily_job(spark, "2024-01-01", _day(spark), **args)
    monkeypatch.undo()
    assert spark.table(table).count() == 2000 and catalog.partition_location(spark, table, {"dt": "2024-01-01"}) == before
    reading = spark.table(table).where("dt = '2024-01-01'")
    daily_job(spark, "2024-01-01", _day(spark, 10, "belo"), **args)
    assert spark.table(table).where("dt = '2024-01-01'").count() == 10 and spark.table(table).count() == 1010
    assert reading.count() in (10, 1000)                                  # the old files are still there
    gone = publish.drop_old_versions(spark, table, path, "dt")
    assert len(gone) == 1 and gone[0].endswith("/dt=2024-01-01") and spark.table(table).count() == 1010
    assert publish.drop_old_versions(spark, table, path, "dt") == []
    daily_job(spark, "2024-01-01", _day(spark, 5), **args)                # the natural folder is free again
    assert spark.table(table).count() == 1005


def test_narrowing_or_another_type_changes_nothing(spark, tmp):
    args = dict(root=tmp, database="pub_b", table="c", **ARGS)
    daily_job(spark, "2024-01-01", _day(spark, 5).withColumn("id", F.col("id").cast("bigint")), **args)
    before = {t: spark.table(f"pub_b.{t}").schema for t in ("raw2_c", "refined_c")}
    for kind in ("int", "string"):
        with pytest.raises(SchemaChanged, match=f"id: bigint -> {kind}"):
            daily_job(spark, "2024-01-02", _day(spark, 5).withColumn("id", F.col("id").cast(kind)).withColumn("note", F.lit("x")), **args)
    assert {t: spark.table(f"pub_b.{t}").schema for t in before} == before
    assert not os.path.exists(_local(f"{tmp}/raw/c/dt=2024-01-02"))


def test_wider_types_reach_old_days(spark, tmp):
    args = dict(root=tmp, database="pub_c", table="c", **ARGS)
    for i, kind in enumerate(("int", "bigint", "decimal(22,2)"), 1):
        out = daily_job(spark, f"2024-01-0{i}", _day(spark, 3).withColumn("id", F.col("id").cast(kind)), **args)
        assert all(v.passed for v in out["verdict"])
    assert out["drift"]["widened"] == ["id: bigint -> decimal(22,2)"]
    for t in ("raw2_c", "refined_c"):
        rows = spark.table(f"pub_c.{t}")
        assert rows.schema["id"].dataType.simpleString() == "decimal(22,2)"
        assert sorted(map(int, (r.id for r in rows.collect()))) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    daily_job(spark, "2024-01-02", _day(spark, 1).withColumn("id", F.col("id").cast("decimal(22,2)")), **args)
    assert spark.table("pub_c.refined_c").count() == 7                    # partitions kept their places


def test_digest(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, "b"), (3, "", "x")], "a int, b string, c string")
    digest = lambda d: d.agg(content_digest([F.col(c) for c in d.columns]).alias("d")).first().d
    assert digest(df) == digest(df.repartition(7).orderBy(F.desc("a")))
    others = [df.union(df.limit(1)), df.where("a <> 2").union(spark.createDataFrame([(2, "b", None)], df.schema)),
              df.withColumn("b", F.when(F.col("a") == 3, F.lit(None)).otherwise(F.col("b"))), df.limit(0), df.dropDuplicates()]
    assert len({digest(d) for d in [df, *others]}) == 6


def test_one_altered_cell_fails(spark, tmp):
    source = _day(spark, 50)
    path, rows, content = land_with_audit(source, f"{tmp}/raw", "c", "2024-01-01", source="t", content=True)
    check = lambda raw: {v.check: v.passed for v in run_checks(
        raw, raw, landed_rows=rows, landed_content=content).collect()}
    raw = read_csv(spark, path, schema=source.schema, own=True)
    assert all(check(raw).values())
    file = next(f for f in os.listdir(_local(path)) if f.endswith(".csv"))
    with open(f"{_local(path)}/{file}") as f:
        text = f.read()
    with open(f"{_local(path)}/{file}", "w") as f:
        f.write(text.replace('"rio"', '"RIO"', 1))
    os.remove(f"{_local(path)}/.{file}.crc")
    found = check(read_csv(spark, path, schema=source.schema, own=True))
    assert found["landed"] and found["row_counts"] and not found["landed_content"]
    other = source.withColumn("city", F.when(F.col("id") == 7, "x").otherwise(F.col("city")))
    validate_job(source, source, content=True)
    with pytest.raises(CheckFailed, match="content"):
        validate_job(source, other, content=True)


def test_the_audit_keeps_the_digest(spark, tmp):
    jobs.extract_job(spark, _day(spark, 5), tmp, "c", "2024-01-01", source="t", audit_path=f"{tmp}/audit")
    row = read_audit(spark, f"{tmp}/audit").first()
    want = _day(spark, 5).agg(content_digest([F.col(c) for c in ("id", "city", "st")]).alias("d")).first().d
    assert row.content == want and row.extracted_rows == 5

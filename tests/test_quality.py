"""Quality checks: casing, allowed values, absent column, counts, sample,
top-k, one-pass verdicts."""

import pytest
from pyspark.sql import functions as F

from refinery.jobs import CheckFailed, validate_job
from refinery.operators.quality import (
    compare_counts, run_checks, sample_rows, top_k, uppercase_counts, validate_columns, value_counts)
from refinery.operators.refine import refine

COLS = ("customer_id int, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string")


def raw_customers(spark):
    rows = [(1, "u1", "01001", "sao paulo", "SP"), (2, "u2", "01002", "campinas", "SP"),
            (3, "u3", "20000", "rio", "RJ"), (4, "u4", "01003", "SANTOS", "SP"),
            (5, "u5", "01004", None, "SP"), (6, "u6", "30000", "belo", None),
            (7, "u7", "01005", "campinas", "SP"), (8, "u8", "01006", "sao paulo", "SP"),
            (9, "u9", "01007", "osasco", "SP")]
    return spark.createDataFrame(rows, COLS)


def refined_customers(spark):
    return refine(raw_customers(spark), keep={"customer_state": ["SP"]},
                  upper=["customer_city"], drop=["customer_unique_id"])


def test_refine_keeps_order_and_effects(spark):
    out = refined_customers(spark)
    assert out.columns == ["customer_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    rows = {r.customer_id: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 4, 5, 7, 8, 9]          # NULL state dropped
    assert rows[1].customer_city == "SAO PAULO" and rows[5].customer_city is None
    assert rows[1].customer_zip_code_prefix == "01001"    # leading zero kept


def test_uppercase_null_counts_as_fail(spark):
    df = spark.createDataFrame([("A",), ("b",), (None,)], "customer_city string")
    got = {r.uppercase_validation: r["count"] for r in uppercase_counts(df, "customer_city").collect()}
    assert got == {"PASS - All Uppercase": 1, "FAIL - Not Uppercase": 2}


def test_value_counts_with_allowed_flag(spark):
    got = [tuple(r) for r in value_counts(raw_customers(spark), "customer_state",
                                          allowed=["SP"]).collect()]
    assert got == [("SP", 7, True), ("RJ", 1, False), (None, 1, False)]


def test_compare_counts_is_union_all(spark):
    raw, ref = raw_customers(spark), refined_customers(spark)
    got = [tuple(r) for r in compare_counts([("Raw Table", raw), ("Refined Table", ref),
                                             ("Raw Table", raw)]).collect()]
    assert got == [("Raw Table", 9), ("Refined Table", 7), ("Raw Table", 9)]


def test_sample_and_top_k_are_deterministic(spark):
    ref = refined_customers(spark)
    assert [r.customer_id for r in sample_rows(ref, ["customer_id"], 3, ["customer_id"]).collect()] == [1, 2, 4]
    assert sample_rows(ref, ["customer_id", "customer_city"], 4).count() == 4
    top = [tuple(r) for r in top_k(ref, ["customer_city", "customer_state"], 3,
                                   count_name="customer_count").collect()]
    assert top == [("CAMPINAS", "SP", 2), ("SAO PAULO", "SP", 2), ("OSASCO", "SP", 1)]


def test_run_checks_flags_failures(spark):
    raw = raw_customers(spark)
    good = refined_customers(spark).where(F.col("customer_city").isNotNull())
    verdict = {r.check: r.passed for r in run_checks(
        raw, good, upper=["customer_city"], allowed={"customer_state": ["SP"]},
        absent=["customer_unique_id"]).collect()}
    # a row was lost on the way: the count check fails, the rest pass
    assert verdict == {"uppercase:customer_city": True, "allowed:customer_state": True,
                       "absent:customer_unique_id": True, "row_counts": False}
    bad = raw.where(F.col("customer_state") == "SP")   # not refined at all
    verdict = {r.check: r.passed for r in run_checks(
        raw, bad, upper=["customer_city"], allowed={"customer_state": ["SP"]},
        absent=["customer_unique_id"]).collect()}
    assert verdict == {"uppercase:customer_city": False, "allowed:customer_state": True,
                       "absent:customer_unique_id": False, "row_counts": True}


def test_validate_job_raises_on_failure(spark):
    raw = raw_customers(spark)
    with pytest.raises(CheckFailed):
        validate_job(raw, raw, upper=["customer_city"], allowed={"customer_state": ["SP"]})
    ref = refined_customers(spark)
    verdict = validate_job(raw, ref, allowed={"customer_state": ["SP"]}, absent=["customer_unique_id"])
    assert all(r.passed for r in verdict)


def test_every_refined_row_passes_each_check(spark):
    ref = refined_customers(spark)
    assert ref.where(~F.coalesce(F.col("customer_state").isin("SP"), F.lit(False))).count() == 0
    # refined is a subset of raw (by key)
    assert ref.select("customer_id").subtract(raw_customers(spark).select("customer_id")).count() == 0


def test_allowed_values_compare_in_the_column_type(spark):
    raw = spark.createDataFrame([(1, True, 2), (2, False, 2), (3, True, 3)],
                                "id int, active boolean, tier int")
    refined = raw.where(F.col("active") & (F.col("tier") == 2))
    verdict = {r.check: r.passed for r in run_checks(
        raw, refined, allowed={"active": [True], "tier": [2]}).collect()}
    assert verdict == {"allowed:active": True, "allowed:tier": True, "row_counts": True}


def test_decimal_keep_agrees_with_refine(spark):
    raw = spark.createDataFrame([("1.00", "A"), ("2.00", "B")], "p string, c string").select(F.col("p").cast("decimal(9,2)").alias("p"), "c")
    refined = refine(raw, keep={"p": [1]})
    assert refined.count() == 1
    verdict = run_checks(raw, refined, allowed={"p": [1]}, landed_rows=2).collect()
    assert [r.passed for r in verdict] == [True, True, True]
    assert not {r.check: r.passed for r in run_checks(raw, refined, landed_rows=3).collect()}["landed"]


def test_names_resolve_as_spark_does(spark):
    df = spark.createDataFrame([("rio", "SP")], "City string, st string")
    out = refine(df, keep={"ST": ["SP"]}, upper=["city"], drop=["ST"])
    assert out.columns == ["City"] and out.first().City == "RIO"
    for bad in (dict(upper=["town"]), dict(drop=["town"]), dict(keep={"town": [1]})):
        with pytest.raises(ValueError, match="town"):
            refine(df, **bad)
    verdict = {r.check: r.passed for r in run_checks(df, df, absent=["CITY", "town"]).collect()}
    assert verdict["absent:CITY"] is False and verdict["absent:town"] is True


def test_validate_columns(spark):
    got = [tuple(r) for r in validate_columns([("Raw", raw_customers(spark)), ("Refined", refined_customers(spark))],
                                              ["customer_unique_id"]).collect()]
    assert got == [("Raw", "customer_unique_id", 9, False, "column present"),
                   ("Refined", "customer_unique_id", 7, True, "column absent")]

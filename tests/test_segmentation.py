"""Customer segmentation: golden fixture, edges, equivalence with the
plain join-then-group plan, plan shape."""

import random

from pyspark.sql import functions as F

from refinery.functions.columns import DEFAULT_TIERS
from refinery.operators.segmentation import segment_customers
from refinery.sources.files import read_csv

SALES_COLS = "Date string, Product string, Category string, Price int, Quantity int, CustomerID string"
CUST_COLS = "CustomerID string, Name string, Age int, Gender string"


def _fixture(spark):
    # Authored rows: 4 customers, one without sales, one sale for an unknown id.
    sales = [
        ("2023-10-01", "P_A", "Electronics", 500, 40, "C1"),   # 20000
        ("2023-10-02", "P_B", "Clothing", 100, 80, "C1"),      # 8000  -> 28000 High (equality)
        ("2023-10-03", "P_A", "Electronics", 500, 40, "C2"),   # 20000 Medium (equality)
        ("2023-10-04", "P_C", "Clothing", 50, 10, "C3"),       # 500   Low
        ("2023-10-05", "P_C", "Clothing", 50, 10, "C9"),       # unknown customer: dropped
        ("2023-10-06", "P_C", "Clothing", None, 10, "C5"),     # null total -> Low
        ("2023-10-07", "P_C", "Clothing", 50, 10, None),       # null key: dropped
    ]
    customers = [("C1", "Ann", 31, "Female"), ("C2", "Bo", 45, "Male"),
                 ("C3", "Cy", 22, "Male"), ("C4", "Di", 50, "Female"),
                 ("C5", "Ed", 60, "Male")]
    return spark.createDataFrame(sales, SALES_COLS), spark.createDataFrame(customers, CUST_COLS)


def test_golden_fixture(spark):
    sales, customers = _fixture(spark)
    out = segment_customers(sales, customers)
    assert out.columns == ["CustomerID", "Name", "Age", "Gender", "Total_sales", "Segmentation_column"]
    assert dict(out.dtypes)["Total_sales"] == "bigint"
    got = {r.CustomerID: (r.Total_sales, r.Segmentation_column) for r in out.collect()}
    assert got == {"C1": (28000, "High Value"), "C2": (20000, "Medium Value"),
                   "C3": (500, "Low Value"), "C5": (None, "Low Value")}


def test_custom_tiers_and_labels(spark):
    sales, customers = _fixture(spark)
    out = segment_customers(sales, customers, tiers=[(10000, "High Value"), (5000, "Mid Value")])
    got = {r.CustomerID: r.Segmentation_column for r in out.collect()}
    assert got == {"C1": "High Value", "C2": "High Value", "C3": "Low Value", "C5": "Low Value"}


def _naive(sales, customers, tiers=DEFAULT_TIERS):
    # The reference's plan: join, product, group by four keys, CASE.
    j = sales.join(customers, on="CustomerID", how="inner")
    g = (j.withColumn("t", F.col("Price").cast("bigint") * F.col("Quantity").cast("bigint"))
          .groupBy("CustomerID", "Name", "Age", "Gender").agg(F.sum("t").alias("Total_sales")))
    (c1, l1), (c2, l2) = tiers
    return g.withColumn("Segmentation_column", F.when(F.col("Total_sales") >= c1, l1)
                        .when(F.col("Total_sales") >= c2, l2).otherwise("Low Value"))


def test_matches_naive_plan_on_random_data_with_duplicate_customers(spark):
    rng = random.Random(7)
    ids = [f"C{i}" for i in range(40)]
    hot = ids[0]   # a third of all sales on one customer
    sales = [("d", "p", "c", rng.randint(1, 900), rng.randint(1, 60),
              hot if i % 3 == 0 else rng.choice(ids + ["X1", None]))
             for i in range(3000)]
    customers = [(c, f"n{c}", rng.randint(18, 80), rng.choice(["Male", "Female"])) for c in ids]
    customers += [customers[5], (ids[6], "other name", 30, "Male")]   # repeated keys
    s = spark.createDataFrame(sales, SALES_COLS)
    c = spark.createDataFrame(customers, CUST_COLS)
    tiers = [(300000, "High Value"), (100000, "Medium Value")]
    ours = sorted(segment_customers(s, c, tiers=tiers).collect())
    ref = sorted(_naive(s, c, tiers).select(*ours[0].__fields__).collect())
    assert ours == ref


def test_money_is_exact_decimal(spark):
    s = spark.createDataFrame([(0.1, 3.0, 1), (0.2, 3.0, 1), (1e-2, 1.0, 1)],
                              "Price double, Quantity double, CustomerID int")
    c = spark.createDataFrame([(1, "a", 1, "x")], "CustomerID int, Name string, Age int, Gender string")
    out = segment_customers(s, c, tiers=[(0.91, "High Value"), (0.5, "Medium Value")]).collect()[0]
    assert out.Total_sales == 0.91 and out.Segmentation_column == "High Value"


def test_join_meets_one_row_per_customer(spark, tmp):
    """Sales are summed before the join: the staged side has a row per key."""
    sales, customers = _fixture(spark)
    segment_customers(sales, customers, stage=f"{tmp}/s")
    per_key = spark.read.parquet(f"{tmp}/s/per_key")
    assert sorted(r.CustomerID for r in per_key.collect()) == ["C1", "C2", "C3", "C5", "C9"]
    assert spark.read.parquet(f"{tmp}/s/customer_groups").count() == 5


def test_properties_on_test_tables(spark):
    """Totals over all segments equal the total over joined sales, and the
    tier is monotone in the total."""
    from conftest import SF001
    from refinery import standins
    from refinery.functions.columns import money
    seg = segment_customers(standins.sales(spark, SF001), standins.customers(spark, SF001),
                            tiers=standins.STANDIN_TIERS)
    joined = standins.sales(spark, SF001).join(standins.customers(spark, SF001), "CustomerID")
    want = joined.agg(F.sum(money("Price") * money("Quantity"))).first()[0]
    got = seg.agg(F.sum(F.col("Total_sales").cast("decimal(38,4)"))).first()[0]
    assert abs(float(got) - float(want)) < 1e-6 * float(want)
    rank = {"High Value": 0, "Medium Value": 1, "Low Value": 2}
    rows = sorted(((r.Total_sales, rank[r.Segmentation_column]) for r in seg.collect()), reverse=True)
    assert [t for _, t in rows] == sorted(t for _, t in rows)
    assert seg.count() == seg.select("CustomerID").distinct().count()


def test_tier_label_matches_python(spark):
    from hypothesis import given, settings, strategies as st
    from refinery.functions.columns import tier_label

    def python_label(v, tiers, default="Low Value"):
        if v is None:
            return default
        for cut, label in tiers:
            if v >= cut:
                return label
        return default

    tiers = [(28000, "High Value"), (20000, "Medium Value")]

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.integers(0, 40000),
                              st.sampled_from([19999, 20000, 27999, 28000])), min_size=1, max_size=40))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v long")
        got = {r.i: r.l for r in df.select("i", tier_label("v", tiers).alias("l")).collect()}
        assert got == {i: python_label(v, tiers) for i, v in enumerate(values)}

    check()


def test_staged_join_lets_aqe_split_a_hot_customer_key(spark, tmp):
    """A key holding a third of the customer rows (distinct names), the customers in
    one gzip file: AQE splits the skewed join partition; rows as by the plain plan."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        cust = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("CustomerID"),
            F.concat(F.lit("n"), F.col("id").cast("string")).alias("Name"),
            (F.col("id") % 50).cast("int").alias("Age"), F.lit("M").alias("Gender"))
        cust.coalesce(1).write.option("header", True).option("compression", "gzip").csv(f"{tmp}/customers")
        cust = read_csv(spark, f"{tmp}/customers", schema=cust.schema)
        sales = spark.range(3 * n).select((F.col("id") % n).alias("CustomerID"),
                                          F.lit(3).alias("Price"), F.lit(2).alias("Quantity"))
        staged = segment_customers(sales, cust, stage=f"{tmp}/stage")
        rows = staged.collect()
        assert "skew=true" in staged._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows) == sorted(_naive(sales, cust).select(*rows[0].__fields__).collect())
        assert len(rows) == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_money_keeps_small_parts_and_refuses_what_does_not_fit(spark):
    import pytest
    cust = spark.createDataFrame([(1, "a", 1, "x")], "CustomerID int, Name string, Age int, Gender string")
    tiers = [(1.5, "High Value")]
    for kind in ("double", "decimal(12,6)", "string"):
        s = (spark.createDataFrame([("0.125", 8), ("0.001", 1000)], "Price string, Quantity int")
             .select(F.col("Price").cast(kind).alias("Price"), "Quantity", F.lit(1).alias("CustomerID")))
        row = segment_customers(s, cust, tiers=tiers).collect()[0]
        assert row.Total_sales == 2.0 and row.Segmentation_column == "High Value", kind
    fine = spark.createDataFrame([(0.0000001, 1, 1)], "Price double, Quantity int, CustomerID int")
    for df, scale in ((fine, 6), (spark.createDataFrame([(0.125, 1, 1)], fine.schema), 2)):
        with pytest.raises(Exception, match="money scale"):
            segment_customers(df, cust, scale=scale).collect()


def test_grouped_join_equals_join_then_group_on_random_tables(spark, tmp):
    """Repeated customer rows, NULL attributes, NULL prices, unknown keys:
    the staged form equals the plain join-then-group."""
    from hypothesis import given, settings, strategies as st

    key = st.sampled_from(["A", "B", "C", "D", None])
    name = st.one_of(st.none(), st.sampled_from(["x", "y"]))
    sale = st.tuples(st.one_of(st.none(), st.decimals("0.01", "999.99", places=2)),
                     st.integers(1, 50), key)
    cust = st.tuples(key, name, st.one_of(st.none(), st.integers(18, 20)), st.sampled_from(["M", "F"]))
    runs = iter(range(1000))

    @settings(max_examples=6, deadline=None)
    @given(st.lists(sale, min_size=1, max_size=30), st.lists(cust, min_size=1, max_size=12))
    def check(sales_rows, cust_rows):
        s = spark.createDataFrame([(float(p) if p is not None else None, q, k) for p, q, k in sales_rows],
                                  "Price double, Quantity int, CustomerID string")
        c = spark.createDataFrame(cust_rows, "CustomerID string, Name string, Age int, Gender string")
        tiers = [(5000, "High Value"), (1000, "Medium Value")]
        plain = (s.join(c, "CustomerID")
                 .groupBy("CustomerID", "Name", "Age", "Gender")
                 .agg(F.sum(F.col("Price").cast("decimal(18,2)") * F.col("Quantity").cast("decimal(18,2)"))
                      .cast("double").alias("Total_sales")))
        want = sorted(map(tuple, plain.collect()), key=repr)
        got = segment_customers(s, c, tiers=tiers, stage=f"{tmp}/stage{next(runs)}").drop("Segmentation_column")
        assert sorted(map(tuple, got.collect()), key=repr) == want

    check()

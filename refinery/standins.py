"""The driver's test tables dressed as the reference's inputs.

* sales     = lineitem |><| orders |><| part  (Date, Product, Category,
              Price, Quantity, CustomerID)
* customer  = customer as (CustomerID, Name, Age, Gender) with
              c_nationkey / c_mktsegment standing in for Age / Gender
* orders demo (partition demo) = events, partitioned by the event date,
              event_type standing in for the customer name
* store customers (raw -> refined) = part as (customer_id,
              customer_unique_id, customer_zip_code_prefix, customer_city,
              customer_state)

Only the columns a query uses are read: Catalyst prunes the rest from
``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions.columns import DATE_PARTITION_COLUMN
from refinery.sources.files import read_parquet

# Segment cut-offs used on the test tables (spend there is ~50x the
# reference's sample data).
STANDIN_TIERS = ((1500000, "High Value"), (900000, "Medium Value"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    joined = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .join(p, li.l_partkey == p.p_partkey, "inner"))
    return joined.select(
        o.o_orderdate.alias("Date"), p.p_name.alias("Product"), p.p_brand.alias("Category"),
        p.p_retailprice.alias("Price"), li.l_quantity.alias("Quantity"),
        o.o_custkey.alias("CustomerID"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(c.c_custkey.alias("CustomerID"), c.c_name.alias("Name"),
                    c.c_nationkey.alias("Age"), c.c_mktsegment.alias("Gender"))


def events_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.withColumn(DATE_PARTITION_COLUMN, F.to_date("ts"))


def store_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(p.p_partkey.alias("customer_id"), p.p_brand.alias("customer_unique_id"),
                    p.p_size.alias("customer_zip_code_prefix"), p.p_name.alias("customer_city"),
                    p.p_type.alias("customer_state"))

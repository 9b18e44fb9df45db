"""Customer segmentation: total spend per customer and a tier label.

Semantics are those of the reference job: inner join of sales and
customers on the key, ``sum(price * quantity)`` grouped by the key and the
customer attributes, then a first-match-wins tier label.

Plan shape.  Sales are aggregated to one row per key *before* the customer
join (a partial + final hash aggregate: a hot customer holding a third of
all sales is combined map-side, it is never shuffled row by row).  Customer
rows are counted per (key, attributes) the same way, so the join meets one
row per key on the sales side and one per (key, attributes) on the other;
its output is the result, with no aggregate above it.  Both sides are written
in the shared checkpoint folder first and the join reads what was written:
its inputs are then plain shuffles, and AQE splits a skewed join partition
(its skew-join rule does not look through an aggregate).  A repeated customer key still gives the reference's
answer: the key's total times the number of matching rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import (
    DEFAULT_TIER_LABEL,
    DEFAULT_TIERS,
    MONEY_SCALE,
    is_integral,
    line_total,
    tier_label,
)
from refinery.session import scratch_path


def sales_per_key(sales: DataFrame, key: str, price: str, quantity: str, total: str,
                  scale: int = MONEY_SCALE) -> DataFrame:
    """(key, total): sales summed per key, rows without a key left out."""
    integral = is_integral(sales, price) and is_integral(sales, quantity)
    return (sales.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum(line_total(price, quantity, integral, scale)).alias(total)))


def customer_groups(customers: DataFrame, key: str, attributes: Sequence[str], rows: str) -> DataFrame:
    """(key, attributes..., rows): customer rows counted per key and attributes.

    Repeated rows collapse map-side, so a key that fills a third of the customer
    table is combined before any shuffle.  A sale joins every matching customer
    row, so a group's total is the key's total times its row count -- the
    reference's join-then-sum, without re-grouping after the join (which would
    pin a skewed key to one task)."""
    return customers.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias(rows))


def customer_totals(sales: DataFrame, customers: DataFrame, *, key: str = "CustomerID",
                    price: str = "Price", quantity: str = "Quantity",
                    attributes: Sequence[str] = ("Name", "Age", "Gender"),
                    total: str = "Total_sales", stage: str | None = None,
                    scale: int = MONEY_SCALE) -> DataFrame:
    """(key, attributes..., total) with total = exact sum of price * quantity.

    Integral price and quantity give a bigint total (as the reference's
    ``int * int`` sum); other inputs are summed as DECIMAL and returned as
    a decimal column (see :func:`segment_customers` for the output cast).

    Both pre-aggregated sides are written to ``stage`` (default: a fresh
    folder in the shared checkpoint location) in two jobs right away,
    whatever their size.  That also cuts the lineage: a lost executor during
    the join does not re-run the sales aggregation.  ``scale``: decimal places
    of price and quantity; more of them fail the job (see ``money``).
    """
    rows = "__customer_rows"
    per_key = sales_per_key(sales, key, price, quantity, total, scale)
    groups = customer_groups(customers, key, attributes, rows)
    spark = sales.sparkSession
    stage = (stage or scratch_path(spark, "segmentation_stage")).rstrip("/")
    per_key.write.mode("overwrite").parquet(f"{stage}/per_key")
    groups.write.mode("overwrite").parquet(f"{stage}/customer_groups")
    per_key = spark.read.schema(per_key.schema).parquet(f"{stage}/per_key")
    groups = spark.read.schema(groups.schema).parquet(f"{stage}/customer_groups")
    joined = per_key.join(groups, on=key, how="inner")
    return joined.select(key, *attributes, (F.col(total) * F.col(rows)).alias(total))


def segment_customers(sales: DataFrame, customers: DataFrame, *,
                      tiers: Sequence[tuple[float, str]] = DEFAULT_TIERS,
                      default_label: str = DEFAULT_TIER_LABEL,
                      key: str = "CustomerID", price: str = "Price",
                      quantity: str = "Quantity",
                      attributes: Sequence[str] = ("Name", "Age", "Gender"),
                      total: str = "Total_sales",
                      label: str = "Segmentation_column",
                      total_as_double: bool = True,
                      stage: str | None = None, scale: int = MONEY_SCALE) -> DataFrame:
    """Totals plus the tier label.  The label is decided on the exact total;
    a decimal total is then cast to DOUBLE for output (``total_as_double``).
    ``stage``, ``scale``: see :func:`customer_totals`."""
    totals = customer_totals(sales, customers, key=key, price=price, quantity=quantity,
                             attributes=attributes, total=total, stage=stage, scale=scale)
    labelled = totals.withColumn(label, tier_label(total, tiers, default_label))
    if total_as_double and not is_integral(labelled, total):
        labelled = labelled.withColumn(total, F.col(total).cast("double"))
    return labelled.select(key, *attributes, total, label)

"""Column-level building blocks.

Everything here returns a ``Column`` made of built-in functions so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the reference job's) --------------------------
# Segment cut-offs of the customer segmentation job, first match wins, compared
# with >=; anything else (including a null total) gets the default label.  The
# labels are defaults of this package; every job takes its own.
DEFAULT_TIERS: tuple[tuple[int, str], ...] = ((28000, "High Value"), (20000, "Medium Value"))
DEFAULT_TIER_LABEL = "Low Value"
# Verdict labels of the uppercase check.
UPPERCASE_PASS = "PASS - All Uppercase"
UPPERCASE_FAIL = "FAIL - Not Uppercase"
# Source labels of the raw-against-refined row-count check.
RAW_LABEL = "Raw Table"
REFINED_LABEL = "Refined Table"
# Text date format of the raw orders, and the partition column it becomes.
DATE_FORMAT = "dd-MM-yyyy"
DATE_PARTITION_COLUMN = "date_partition"
# Catalog table-name prefixes of the raw and refined tables.
RAW_TABLE_PREFIX = "raw2_"
REFINED_TABLE_PREFIX = "refined_"
# -----------------------------------------------------------------------------

# Money is multiplied and summed as an exact decimal so the result does not
# depend on partition order (a double sum does).  Amounts hold up to MONEY_SCALE
# decimal places; products then have twice as many and still fit 38 digits.
MONEY_SCALE = 6
MONEY_DIGITS = 18


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType,
                      (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def money(c: str | Column, scale: int = MONEY_SCALE) -> Column:
    """The amount as DECIMAL(18, ``scale``), exactly: an amount with more decimal
    places (or too many digits) fails the job instead of being rounded.

    A double counts as the decimal it prints as (0.1 is 0.1)."""
    v = _col(c)
    kind = T.DecimalType(MONEY_DIGITS, scale)
    exact = v.try_cast(kind)
    failed = F.raise_error(F.concat(F.lit("amount does not fit the money scale: "), v.cast("string")))
    return F.when(v.isNull() | F.coalesce(exact == v, F.lit(False)), exact).otherwise(failed.cast(kind))


def line_total(price: str | Column, quantity: str | Column, integral: bool = False,
               scale: int = MONEY_SCALE) -> Column:
    """``price * quantity``.

    Integral inputs are widened to bigint first (int * int overflows under
    ANSI); anything else is multiplied as exact decimals (see :func:`money`).
    """
    if integral:
        return _col(price).cast("bigint") * _col(quantity).cast("bigint")
    return money(price, scale) * money(quantity, scale)


def tier_label(value: str | Column,
               tiers: Sequence[tuple[float, str]] = DEFAULT_TIERS,
               default: str = DEFAULT_TIER_LABEL) -> Column:
    """``CASE WHEN v >= t1 THEN l1 WHEN v >= t2 THEN l2 ... ELSE default``.

    Tiers are tried in the given order, so pass them highest first.
    """
    v = _col(value)
    if not tiers:
        return F.lit(default)
    (first_cut, first_label), *rest = tiers
    expr = F.when(v >= F.lit(first_cut), F.lit(first_label))
    for cut, label in rest:
        expr = expr.when(v >= F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(default))


def parse_date(text: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to DATE; unparseable text becomes NULL instead of failing the job."""
    return F.try_to_date(_col(text), fmt)


def date_text(value: str | Column, fmt: str = DATE_FORMAT) -> Column:
    return F.date_format(_col(value), fmt)


def uppercase_verdict(c: str | Column) -> Column:
    """PASS when the value equals its upper-case form; NULL compares unknown -> FAIL."""
    v = _col(c)
    return F.when(v == F.upper(v), F.lit(UPPERCASE_PASS)).otherwise(F.lit(UPPERCASE_FAIL))


# --- fixed values (PostgreSQL's pg_size_pretty format) -----------------------
# Sizes below 10240 bytes print as "N bytes".  Larger ones use the first unit
# of kB, MB, GB, TB, PB in which the size, counted in halves of that unit
# (divisions truncate), is below 2 * 10240 - 1; it prints rounded half away
# from zero.
SIZE_UNITS = ("kB", "MB", "GB", "TB", "PB")
SIZE_LIMIT = 10 * 1024
# -----------------------------------------------------------------------------


def pretty_size(size: str | Column) -> Column:
    """Byte count as PostgreSQL's ``pg_size_pretty`` prints it ("7403 bytes",
    "977 kB", "10 MB").  Built-in integer arithmetic only, so it stays in
    codegen."""
    b = _col(size).cast("bigint")

    def tdiv(x: Column, d: int) -> Column:
        # integer division rounding toward zero (as C does), exact via decimals
        return (x.cast("decimal(20,0)") / F.lit(d).cast("decimal(20,0)")).cast("bigint")

    def half_rounded(x: Column) -> Column:
        return tdiv(x + F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)), 2)

    expr = F.when(F.abs(b) < SIZE_LIMIT, F.concat(b.cast("string"), F.lit(" bytes")))
    for i, unit in enumerate(SIZE_UNITS):
        v = tdiv(b, 512 * 1024 ** i)          # one extra bit kept for rounding
        text = F.concat(half_rounded(v).cast("string"), F.lit(f" {unit}"))
        if i < len(SIZE_UNITS) - 1:
            expr = expr.when(F.abs(v) < 2 * SIZE_LIMIT - 1, text)
        else:
            expr = expr.otherwise(text)
    return expr


def reduction_pct(kept: str | Column, total: str | Column) -> Column:
    """Share of rows a filter removed, in percent, one decimal."""
    k, n = _col(kept), _col(total)
    return F.round(F.try_divide((F.lit(100) * (n - k)).cast("double"), n), 1)

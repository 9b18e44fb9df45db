"""Data-quality checks on a refined table (and its raw source).

Each check is a small aggregate; :func:`run_checks` evaluates all of them
with one scan of each table and one global aggregate, and returns
``(check, passed, detail)`` rows -- a bounded verdict the caller may collect.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import uppercase_verdict
from refinery.functions.digest import SALTS, hash_sum, row_hash
from refinery.operators.refine import among, has_column, resolve


def uppercase_counts(df: DataFrame, column: str, label: str = "uppercase_validation",
                     count_name: str = "count", by: Sequence[str] = ()) -> DataFrame:
    """``SELECT CASE WHEN c = UPPER(c) THEN 'PASS…' ELSE 'FAIL…' END, COUNT(*) GROUP BY 1``,
    optionally per ``by`` columns (several tables tagged and unioned are
    then checked with one aggregation)."""
    return df.groupBy(*by, uppercase_verdict(column).alias(label)).agg(
        F.count(F.lit(1)).alias(count_name))


def value_counts(df: DataFrame, column: str, count_name: str = "count",
                 allowed: Sequence[object] | None = None) -> DataFrame:
    """Rows per value, most frequent first (ties by value).  With ``allowed``
    each value also gets an ``allowed`` flag (NULL is never allowed)."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    if allowed is not None:
        out = out.withColumn("allowed", F.coalesce(F.col(column).isin(list(allowed)), F.lit(False)))
    return out.orderBy(F.desc(count_name), F.asc_nulls_last(column))


def compare_counts(labelled: Sequence[tuple[str, DataFrame]], label: str = "source",
                   count_name: str = "row_count") -> DataFrame:
    """``SELECT 'a' AS source, COUNT(*) FROM a UNION ALL SELECT 'b', COUNT(*) FROM b``."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_name))
               .select(F.lit(name).alias(label), count_name) for name, df in labelled]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sample_rows(df: DataFrame, columns: Sequence[str], n: int = 10,
                order_by: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows of ``columns``.  Without ``order_by`` any ``n`` rows (as a
    bare LIMIT); with it, the first ``n`` in that order (a top-k, not a
    global sort)."""
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*[F.asc_nulls_last(c) for c in order_by])
    return out.limit(n)


def top_k(df: DataFrame, keys: Sequence[str], k: int = 10,
          count_name: str = "count", tie_break: Sequence[str] | None = None) -> DataFrame:
    """Most frequent ``keys`` combinations: count desc, then ``tie_break``
    (default: the keys) ascending so the answer is unique."""
    ties = list(tie_break if tie_break is not None else keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.desc(count_name), *[F.asc_nulls_last(c) for c in ties])
              .limit(k))


def _failed_upper(c: Column) -> Column:
    # NULL = UPPER(NULL) is unknown, which the reference counts as FAIL.
    return ~F.coalesce(c == F.upper(c), F.lit(False))


def validate_columns(tables: Sequence[tuple[str, DataFrame]], absent: Iterable[str]) -> DataFrame:
    """(table_name, column_name, row_count, passed, detail): whether each column is
    gone from each table, with the rows of the table."""
    parts = []
    for name, df in tables:
        rows = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                         F.col("row_count"), F.lit(not has_column(df, c)).alias("passed"),
                         F.lit("column present" if has_column(df, c) else "column absent").alias("detail"))
                for c in absent]
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(F.array(*rows))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_checks(raw: DataFrame, refined: DataFrame, *, upper: Iterable[str] = (),
               allowed: dict[str, Sequence[object]] | None = None,
               absent: Iterable[str] = (), landed_rows: int | None = None,
               landed_content: str | None = None, landed_columns: Sequence[str] | None = None,
               content: bool = False) -> DataFrame:
    """All checks in one pass over each table.

    * ``uppercase:<c>``   every refined value of ``c`` is upper case
    * ``allowed:<c>``     every refined value of ``c`` is in the allowed list
    * ``absent:<c>``      column ``c`` is not in the refined table (schema only)
    * ``landed``          raw rows as read == ``landed_rows``, the rows the extract
                          counted (only when given)
    * ``landed_content``  digest of the raw rows as read == the digest that the extract
                          took while it was written (only when given), over
                          ``landed_columns`` (default: all raw columns)
    * ``row_counts``      refined rows == raw rows passing the allowed lists
    * ``content``         digest of the refined rows == digest of the raw rows passing the
                          allowed lists, refined (only with ``content``): equal counts of
                          other values fail

    Values are compared in the columns' own types, as ``refine`` does.
    """
    upper, absent = list(upper), list(absent)
    allowed = dict(allowed or {})
    kept = F.lit(True)
    for c, values in allowed.items():
        kept = kept & among(raw, c, values)
    flags = {"is_ref": F.lit(True),
             **{f"bad_upper_{i}": _failed_upper(F.col(f"`{resolve(refined, c)}`")) for i, c in enumerate(upper)},
             **{f"bad_allowed_{i}": ~among(refined, c, v) for i, (c, v) in enumerate(allowed.items())}}
    # Rows' hashes as columns: what was landed, and what the refined rows should be / are.
    landed, wanted, got = [], [], []
    if landed_content is not None:
        own = [F.col(f"`{resolve(raw, c)}`") for c in (landed_columns or raw.columns)]
        landed = [row_hash(own, salt) for salt in SALTS]
    if content:
        raised = {resolve(raw, c) for c in upper if has_column(raw, c)}
        names = [resolve(raw, c) for c in refined.columns]
        made = [(F.upper(F.col(f"`{n}`")) if n in raised else F.col(f"`{n}`")).cast(refined.schema[c].dataType)
                for n, c in zip(names, refined.columns)]
        wanted = [F.when(kept, row_hash(made, salt)) for salt in SALTS]
        got = [row_hash([F.col(f"`{c}`") for c in refined.columns], salt) for salt in SALTS]
    nothing = F.lit(None).cast("long")
    # Only flags and hashes leave the scans; rows of the two tables are told apart by is_ref.
    both = (raw.select(F.lit(False).alias("is_ref"), kept.alias("kept"),
                       *[F.lit(False).alias(f) for f in flags if f != "is_ref"],
                       *[h.alias(f"landed_{i}") for i, h in enumerate(landed)],
                       *[h.alias(f"refined_{i}") for i, h in enumerate(wanted)])
            .unionByName(refined.select(*[c.alias(f) for f, c in flags.items()], F.lit(False).alias("kept"),
                                        *[nothing.alias(f"landed_{i}") for i in range(len(landed))],
                                        *[h.alias(f"refined_{i}") for i, h in enumerate(got)])))
    side = {False: ~F.col("is_ref"), True: F.col("is_ref")}
    sums = [hash_sum([F.col(f"landed_{i}") for i in range(len(landed))], side[False]).alias("landed_digest")] if landed else []
    if content:
        sums += [hash_sum([F.col(f"refined_{i}") for i in range(len(got))], side[k]).alias(n)
                 for k, n in ((False, "wanted_digest"), (True, "refined_digest"))]
    stats = both.agg(F.count_if(~F.col("is_ref")).alias("raw_rows"), F.count_if("is_ref").alias("refined_rows"),
                     F.count_if("kept").alias("raw_kept"), *[F.count_if(f).alias(f) for f in flags if f != "is_ref"], *sums)

    def verdict(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                        detail.alias("detail"))

    refined_rows = F.col("refined_rows").cast("string")
    rows = []
    for i, c in enumerate(upper):
        bad = F.col(f"bad_upper_{i}")
        rows.append(verdict(f"uppercase:{c}", bad == 0,
                            F.concat(bad.cast("string"), F.lit(" of "), refined_rows,
                                     F.lit(" rows not upper case"))))
    for i, c in enumerate(allowed):
        bad = F.col(f"bad_allowed_{i}")
        rows.append(verdict(f"allowed:{c}", bad == 0,
                            F.concat(bad.cast("string"), F.lit(" of "), refined_rows,
                                     F.lit(" rows outside the allowed values"))))
    for c in absent:
        present = has_column(refined, c)
        rows.append(verdict(f"absent:{c}", F.lit(not present),
                            F.lit("column present" if present else "column absent")))
    if landed_rows is not None:
        rows.append(verdict("landed", F.col("raw_rows") == F.lit(int(landed_rows)),
                            F.concat(F.lit(f"extracted {int(landed_rows)}, raw "), F.col("raw_rows").cast("string"))))
    if landed_content is not None:
        same = F.col("landed_digest") == F.lit(landed_content)
        rows.append(verdict("landed_content", same, F.when(same, F.lit("raw rows are those extracted"))
                            .otherwise(F.lit("raw rows differ from those extracted"))))
    rows.append(verdict("row_counts", F.col("refined_rows") == F.col("raw_kept"),
                        F.concat(F.lit("raw "), F.col("raw_rows").cast("string"),
                                 F.lit(", expected refined "), F.col("raw_kept").cast("string"),
                                 F.lit(", refined "), refined_rows)))
    if content:
        same = F.col("wanted_digest") == F.col("refined_digest")
        rows.append(verdict("content", same, F.when(same, F.lit("refined rows follow from raw"))
                            .otherwise(F.lit("refined rows differ from raw rows refined"))))
    return stats.select(F.inline(F.array(*rows)))

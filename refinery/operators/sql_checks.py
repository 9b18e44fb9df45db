"""The refined-table checks as SQL text run by ``spark.sql`` against catalog
tables -- the form in which the checks are written by their users.

Table and column names are substituted as back-quoted identifiers, the
fixed labels as quoted literals; nothing else is interpolated.  Catalyst
plans the text exactly like the DataFrame form in
:mod:`refinery.operators.quality`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refinery.functions.columns import RAW_LABEL, REFINED_LABEL, UPPERCASE_FAIL, UPPERCASE_PASS

SQL_CHECKS: dict[str, str] = {
    # casing verdict per row, grouped by the verdict (GROUP BY ordinal)
    "uppercase": """
        SELECT CASE WHEN {city} = UPPER({city}) THEN {pass_label}
                    ELSE {fail_label} END AS uppercase_validation,
               COUNT(*) AS `count`
        FROM {table}
        GROUP BY 1""",
    # rows per state, most frequent first
    "state": """
        SELECT {state}, COUNT(*) AS `count`
        FROM {table}
        GROUP BY {state}
        ORDER BY `count` DESC, {state} NULLS LAST""",
    # raw against refined row counts
    "row_counts": """
        SELECT {raw_label} AS source, COUNT(*) AS row_count FROM {raw}
        UNION ALL
        SELECT {refined_label} AS source, COUNT(*) AS row_count FROM {table}""",
    # first rows by id
    "sample": """
        SELECT {id}, {zip}, {city}, {state}
        FROM {table}
        ORDER BY {id} NULLS LAST
        LIMIT {n}""",
    # most frequent (city, state), ties by name
    "top_cities": """
        SELECT {city}, {state}, COUNT(*) AS customer_count
        FROM {table}
        GROUP BY {city}, {state}
        ORDER BY customer_count DESC, {city} NULLS LAST, {state} NULLS LAST
        LIMIT {n}""",
}

DEFAULT_NAMES = {"city": "customer_city", "state": "customer_state", "id": "customer_id",
                 "zip": "customer_zip_code_prefix"}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_LABELS = {"pass_label": _text(UPPERCASE_PASS), "fail_label": _text(UPPERCASE_FAIL),
           "raw_label": _text(RAW_LABEL), "refined_label": _text(REFINED_LABEL)}


def _ident(name: str) -> str:
    if "`" in name:
        raise ValueError(f"identifier may not contain a back-quote: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def run_sql_check(spark: SparkSession, check: str, table: str, *, raw: str | None = None,
                  n: int = 10, **names: str) -> DataFrame:
    """Run one of :data:`SQL_CHECKS` on catalog table ``table`` (and ``raw``)."""
    cols = {k: _ident(v) for k, v in {**DEFAULT_NAMES, **names}.items()}
    text = SQL_CHECKS[check].format(table=_ident(table), raw=_ident(raw) if raw else "",
                                    n=int(n), **cols, **_LABELS)
    return spark.sql(text)

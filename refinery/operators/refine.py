"""Raw -> refined: keep some values of a column, upper-case text columns,
drop columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` that Spark would take ``name`` for; raises if there is
    none or more than one."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    found = [c for c in df.columns if c == name or not sensitive and c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"column {name!r} {'is ambiguous' if found else 'not found'} in {df.columns}")
    return found[0]


def has_column(df: DataFrame, name: str) -> bool:
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return any(c == name or not sensitive and c.lower() == name.lower() for c in df.columns)


def among(df: DataFrame, name: str, values: Sequence[object]) -> Column:
    """Whether a column's value is one of ``values``, compared in the column's own
    type (a DECIMAL 1.00 is 1); NULL is none of them."""
    return F.coalesce(F.col(f"`{resolve(df, name)}`").isin(list(values)), F.lit(False))


def refine(df: DataFrame, *, keep: dict[str, Sequence[object]] | None = None,
           upper: Iterable[str] = (), drop: Iterable[str] = ()) -> DataFrame:
    """Filter ``col IN values`` for each entry of ``keep`` (pushed to the
    scan), apply ``upper()`` to ``upper`` columns, drop ``drop`` columns.
    Column order is kept.  Names are resolved as Spark does; an unknown one
    raises."""
    upper = {resolve(df, c) for c in upper}
    drop = {resolve(df, c) for c in drop}
    for column, values in (keep or {}).items():
        values, c = list(values), F.col(f"`{resolve(df, column)}`")
        df = df.where(c == F.lit(values[0]) if len(values) == 1 else c.isin(values))
    return df.select(*[(F.upper(F.col(f"`{c}`")).alias(c) if c in upper else F.col(f"`{c}`"))
                       for c in df.columns if c not in drop])

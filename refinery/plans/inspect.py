"""Read the physical plan the way a user reads ``explain()``.

``scan_filters`` pulls the ``PartitionFilters`` (folders skipped by the
driver) and ``PushedFilters`` (row groups skipped by the reader) out of the
formatted plan.  ``files_read`` counts the files a query really opens, via
the hidden ``_metadata.file_path`` column -- ``df.inputFiles()`` is not
pruned and would list every file.  ``rows_scanned`` tells how much of the files
their statistics let a query skip.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _bracket_list(text: str) -> list[str]:
    # Split "[a, f(b, c), d]" on top-level commas.
    inner = text.strip()[1:-1]
    out, depth, cur = [], 0, []
    for ch in inner:
        if ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def scan_filters(df: DataFrame) -> dict[str, list[list[str]]]:
    """``{"PartitionFilters": [...per scan...], "PushedFilters": [...]}``
    with expression ids (``#12``) removed."""
    plan = explain_text(df, "formatted")
    result: dict[str, list[list[str]]] = {"PartitionFilters": [], "PushedFilters": [],
                                          "ReadSchema": []}
    for key in result:
        for match in re.finditer(rf"^{key}: (.*)$", plan, flags=re.MULTILINE):
            value = re.sub(r"#\d+L?", "", match.group(1))
            result[key].append(_bracket_list(value) if value.startswith("[") else [value])
    return result


def files_read(df: DataFrame) -> DataFrame:
    """Distinct files a query scans (one row per file)."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).distinct()


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of ``df`` hand on: after whole row groups are skipped by
    their statistics, before the filter itself.  Runs the query (of a scan with
    filters, without a shuffle)."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    leaves = run.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))

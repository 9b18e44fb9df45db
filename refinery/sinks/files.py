"""File sinks.

Writes go through Spark's commit protocol, so a lost executor only re-runs
its tasks.  Overwrites are scoped (one landing folder, or only the
partitions present in the batch), so re-running a day is idempotent.  A folder that
is replaced as a whole is written beside the old one first (``publish``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.csv_format import writable, writer_options
from refinery.functions.digest import content_digest
from refinery.sinks.publish import replace_folder


def write_csv(df: DataFrame, path: str, *, header: bool = False,
              mode: str = "overwrite", partition_by: Sequence[str] = (),
              quote_all: bool = False) -> str:
    """CSV folder of part files (see ``refinery.csv_format``).  Spark's default
    is no header line."""
    w = writable(df, quote_all).write.mode(mode).options(**writer_options(header, quote_all))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def land_raw(df: DataFrame, base: str, table: str, ds: str | None = None,
             *, fmt: str = "csv", observation=None, content: bool = False) -> str | None:
    """Raw landing at ``base/table[/dt=ds]`` with a header line.

    Returns the folder written, or ``None`` (and writes nothing) when the
    extract is empty.  Only that folder is replaced, so other days stay.
    The emptiness probe stops at the first row: a split of a file scan, or a
    ``LIMIT 1`` pushed to the database.  For an extract that is itself a join
    or aggregate, the probe would run that plan's shuffle, so land such an
    extract from a table written first.
    ``observation`` (a ``pyspark.sql.Observation``) is attached to the write
    only, so it sees every row exactly once; with ``content`` it also gets the digest
    of the rows.  The folder is written beside the old one and then takes its place
    (``publish.replace_folder``), so a write that fails leaves what was there.
    """
    if df.isEmpty():
        return None
    path = f"{base.rstrip('/')}/{table}" + (f"/dt={ds}" if ds else "")
    if observation is not None:
        seen = [F.count(F.lit(1)).alias("rows")]
        if content:
            seen.append(content_digest([F.col(f"`{c}`") for c in df.columns]).alias("content"))
        df = df.observe(observation, *seen)
    with replace_folder(df.sparkSession, path) as fresh:
        if fmt == "csv":
            write_csv(df, fresh, header=True, quote_all=True)
        else:
            df.write.mode("overwrite").format(fmt).save(fresh)
    return path


def replace_day(df: DataFrame, path: str, column: str, value: str, *, fmt: str = "parquet") -> str:
    """Make ``path/column=value`` hold exactly the rows of ``df`` -- also when
    there are none, where a dynamic overwrite would leave the old rows.

    The new folder is written beside the old one and then takes its place, so a
    write that fails leaves the old day.  Returns the folder."""
    folder = f"{path.rstrip('/')}/{column}={value}"
    with replace_folder(df.sparkSession, folder) as fresh:
        write_day(df.drop(column), fresh, fmt=fmt)
    return folder


def write_day(df: DataFrame, folder: str, *, fmt: str = "parquet") -> str:
    """The rows of one day as one folder.  A plain REBALANCE sizes its files from the
    real bytes (hashing by the constant day would send all rows to one task)."""
    out = df.hint("rebalance")
    if fmt == "csv":
        return write_csv(out, folder, header=True, quote_all=True)
    out.write.mode("overwrite").format(fmt).save(folder)
    return folder


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], *,
                      fmt: str = "parquet", mode: str = "overwrite",
                      dynamic: bool = True, rebalance: bool = True,
                      max_records_per_file: int | None = None,
                      **options: str) -> str:
    """Hive-style ``col=value/`` folders.

    ``dynamic`` replaces only the partitions present in ``df`` (set on the
    writer, so it does not depend on session state).  ``rebalance`` adds a
    REBALANCE on the partition columns: rows of a value are gathered into
    few files instead of one small file per task and value, and AQE splits
    a value that is too big for one task (a hot day) into several files and
    merges small ones.
    """
    cols = list(partition_by)
    if rebalance and cols:
        df = df.hint("rebalance", *cols)
    w = (writable(df, True) if fmt == "csv" else df).write.mode(mode).format(fmt).partitionBy(*cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.options(**writer_options(header=True, quote_all=True))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    for key, value in options.items():
        w = w.option(key, value)
    w.save(path)
    return path


def write_compact(df: DataFrame, path: str, *, fmt: str = "parquet",
                  mode: str = "overwrite", compression: str = "snappy",
                  max_records_per_file: int | None = None) -> str:
    """Few, well-sized output files (one when the result is small).

    Instead of ``coalesce(1)`` -- which would also run the upstream
    aggregation in a single task -- a REBALANCE lets AQE size the output
    partitions from the actual shuffle bytes: a small result becomes one
    file, a large one stays spread over many tasks.
    """
    w = df.hint("rebalance").write.mode(mode).format(fmt).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)
    return path

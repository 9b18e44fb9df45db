"""Publishing a day in one step: readers see the old day or the new one.

Two forms, for two kinds of reader:

* :func:`publish_day`, for tables of the catalog.  The day is written to a fresh version
  folder; then ``ALTER TABLE ... SET LOCATION`` points the partition at it.  The old
  version stays where it is until :func:`drop_old_versions`, so a write that fails, or a
  query that is still reading, loses nothing.
* :func:`replace_folder`, for folders that are read by path.  The new folder is written
  beside the old one, and two renames put it in its place.  A run that stops between
  them is mended by the next one.  A rename is one step on HDFS and on a local disk;
  object stores copy, so prefer tables of the catalog there.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path`` (none if there is no such folder)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    if not fs.rename(a, b):
        raise RuntimeError(f"can't rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _aside(folder: str) -> tuple[str, str]:
    """Where the new folder is written and where the old one waits, both hidden from
    readers of the folder above."""
    base, _, name = folder.rstrip("/").rpartition("/")
    return f"{base}/.new-{name}-{uuid.uuid4().hex[:12]}", f"{base}/.old-{name}"


def put_in_place(spark: SparkSession, fresh: str | None, folder: str) -> None:
    """Make ``folder`` the folder ``fresh``, or none; both are below one parent."""
    _, old = _aside(folder)
    restore(spark, folder)
    if exists(spark, folder):
        _move(spark, folder, old)
    if fresh is not None:
        fs, p = _fs(spark, folder)
        fs.mkdirs(p.getParent())
        _move(spark, fresh, folder)
    remove(spark, old)


def restore(spark: SparkSession, folder: str) -> None:
    """Mend a replacement that stopped between its two renames."""
    _, old = _aside(folder)
    if exists(spark, old):
        if exists(spark, folder):
            remove(spark, old)
        else:
            _move(spark, old, folder)


@contextmanager
def replace_folder(spark: SparkSession, folder: str) -> Iterator[str]:
    """Yields a path to write to; what was written there then takes the place of
    ``folder``.  If the block raises, ``folder`` stays as it was."""
    fresh, _ = _aside(folder)
    restore(spark, folder)
    try:
        yield fresh
    except BaseException:
        remove(spark, fresh)
        raise
    put_in_place(spark, fresh, folder)


def version_folder(spark: SparkSession, path: str, column: str, value: str) -> str:
    """A fresh folder for a day: its natural one where that is free (so that a crawl of
    the files finds it), else a hidden version."""
    path = path.rstrip("/")
    natural = f"{path}/{column}={value}"
    if not exists(spark, natural):
        return natural
    return f"{path}/{VERSIONS}/{column}={value}/{uuid.uuid4().hex[:12]}"


def publish_day(df: DataFrame, table: str, path: str, column: str, value: str) -> str:
    """Write ``df`` (without ``column``) as a fresh version of a day and point the
    table's partition at it.  Returns the folder."""
    from refinery import catalog
    from refinery.sinks.files import write_day

    spark = df.sparkSession
    folder = version_folder(spark, path, column, value)
    try:
        write_day(df, folder)
    except BaseException:
        remove(spark, folder)
        raise
    if spark.catalog.tableExists(table):
        catalog.set_partition(spark, table, {column: value}, folder)
    return folder


def drop_old_versions(spark: SparkSession, table: str, path: str, column: str) -> list[str]:
    """Remove the versions of days that ``table`` no longer points at; returns them.
    Call it when no query that began before the last publication is still running."""
    from refinery import catalog

    path, gone = path.rstrip("/"), []
    for day in child_folders(spark, f"{path}/{VERSIONS}"):
        value = unquote(day.split("=", 1)[1])
        used = _plain(catalog.partition_location(spark, table, {column: value}))
        found = [f"{path}/{day}"] + [f"{path}/{VERSIONS}/{day}/{v}" for v in child_folders(spark, f"{path}/{VERSIONS}/{day}")]
        gone += [f for f in found if _plain(f) != used and exists(spark, f)]
    for folder in gone:
        remove(spark, folder)
    return gone


def _plain(path: str) -> str:
    """A path without scheme and slashes at its ends, for comparison."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:", "", path).strip("/")

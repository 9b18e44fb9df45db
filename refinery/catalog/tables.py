"""Register files as catalog tables and keep them current.

Everything is expressed with ``spark.catalog`` and Spark SQL DDL, so it
works on the in-memory catalog and on a Hive metastore alike.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from refinery.catalog import ledger as folder_ledger
from refinery.catalog import types
from refinery.csv_format import reader_options
from refinery.functions.columns import pretty_size
from refinery.session import scratch_path
from refinery.sinks.publish import child_folders


def _q(name: str) -> str:
    if "`" in name:
        raise ValueError(f"identifier may not contain a back-quote: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def _q_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(value: object) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    ddl = f"CREATE DATABASE IF NOT EXISTS {_q(name)}"
    if location:
        ddl += f" LOCATION {_lit(location)}"
    spark.sql(ddl)
    return name


def register(spark: SparkSession, table: str, path: str, *, fmt: str = "parquet",
             schema: StructType | None = None, partition_by: tuple[str, ...] = (),
             replace: bool = True, **options: str) -> str:
    """Catalog table over existing files.

    Without ``schema`` it is inferred from the files (and partition folders).
    A table over partition folders reads nothing until its partitions are in
    the catalog, so they are recovered right away.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_q(table)}")
    if fmt == "csv":
        options = {**reader_options(header=True), **options}
    if schema is not None:
        cols = ", ".join(f"{_q_column(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        opts = ", ".join(f"{_lit(k)} {_lit(v)}" for k, v in {**options, "path": path}.items())
        part = f" PARTITIONED BY ({', '.join(map(_q_column, partition_by))})" if partition_by else ""
        spark.sql(f"CREATE TABLE {_q(table)} ({cols}) USING {fmt} OPTIONS ({opts}){part}")
    else:
        spark.catalog.createTable(table, path=path, source=fmt, **options)
    if spark.catalog.getTable(table) and _partition_columns(spark, table):
        spark.catalog.recoverPartitions(table)
    return table


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


class SchemaConflict(ValueError):
    """Folders of one table hold a column in types that have no common one."""


def union_schema(spark: SparkSession, path: str, *, width: int = 256) -> tuple[StructType, StructType, dict[str, list[str]]]:
    """(columns, partition columns, conflicts) of a Parquet tree whose folders may differ.

    The footers are read in tasks, ``width`` folders a job, and merged there.  A group
    whose folders don't agree is halved until the parts do; their schemas are then merged
    pairwise up the tree, each column to the narrowest type that holds all (``types``)."""
    folders = [f for f in child_folders(spark, path) if "=" in f and not f.startswith((".", "_"))]
    parts = [f"{path.rstrip('/')}/{f}" for f in folders] or [path]
    names = {n.lower() for f in folders for n in _folder_spec(f)}

    def read(group: list[str]) -> list[tuple[str, StructType]]:
        try:
            reader = spark.read.option("mergeSchema", "true").option("basePath", path)
            return [(group[0], reader.parquet(*group).schema)]
        except Exception:       # the folders of the group, or the files of one, don't merge
            if len(group) == 1:
                raise
        half = len(group) // 2
        return read(group[:half]) + read(group[half:])

    found = [x for i in range(0, len(parts), width) for x in read(parts[i:i + width])]
    # partition columns below the first level are in the folders' names as well
    trees = spark.read.option("basePath", path).parquet(parts[0]).schema
    data = {f.name.lower() for f in spark.read.parquet(_leaf(spark, parts[0])).schema.fields}
    names |= {f.name.lower() for f in trees.fields if f.name.lower() not in data}
    fields, conflicts = types.union(found)
    inside = [f for f in fields if f.name.lower() not in names]
    return StructType(inside), StructType([f for f in fields if f.name.lower() in names]), conflicts


def _leaf(spark: SparkSession, folder: str) -> str:
    while True:
        below = [f for f in child_folders(spark, folder) if "=" in f and not f.startswith((".", "_"))]
        if not below:
            return folder
        folder = f"{folder}/{below[0]}"


def crawl(spark: SparkSession, targets: Mapping[str, str], database: str, *,
          prefix: str = "", fmt: str = "parquet", location: str | None = None,
          merge: bool = False, **options) -> DataFrame:
    """Register one table per ``{name: path}`` target as ``database.<prefix><name>``
    (schema and partitions inferred) and return the database's table list.

    With ``merge`` a Parquet table gets the columns of all its folders; types that
    can't be merged raise :class:`SchemaConflict`, which names the folders."""
    create_database(spark, database, location)
    for name, path in targets.items():
        if merge:
            columns, partitions, conflicts = union_schema(spark, path)
            if conflicts:
                raise SchemaConflict(f"{name}: " + "; ".join(f"{c} is {', '.join(v)}" for c, v in conflicts.items()))
            options = {**options, "schema": StructType(columns.fields + partitions.fields),
                       "partition_by": tuple(partitions.names)}
        register(spark, f"{database}.{prefix}{name}", path, fmt=fmt, **options)
    return list_tables(spark, database)


def refresh(spark: SparkSession, table: str, mode: str = "everything", *, ledger: str | None = None) -> None:
    """Bring the catalog's partitions in line with the folders.

    ``everything``: add new partition folders and drop vanished ones.
    ``new_folders``: only add new ones.
    ``ledger``: like ``everything``, but only for the folders that differ from the
    ledger at that path (see :func:`refresh_by_ledger`).
    """
    if mode not in ("everything", "new_folders", "ledger"):
        raise ValueError(f"unknown refresh mode {mode!r}")
    if (mode == "ledger") != (ledger is not None):
        raise ValueError("the mode ledger needs a ledger path, the others take none")
    if mode == "ledger":
        refresh_by_ledger(spark, table, ledger)
        return
    if _partition_columns(spark, table):
        what = "SYNC" if mode == "everything" else "ADD"
        spark.sql(f"MSCK REPAIR TABLE {_q(table)} {what} PARTITIONS")
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def refresh_by_ledger(spark: SparkSession, table: str, ledger_path: str) -> DataFrame:
    """Add, refresh or drop the partitions whose top-level folders were added, landed
    again or removed since the ledger was written; returns (folder, change).

    For tables partitioned by one column.  The ledger is written last."""
    columns = _partition_columns(spark, table)
    if len(columns) != 1:
        raise ValueError(f"{table} is not partitioned by one column")
    # written, so that the ledger below is the listing that was compared
    listing = folder_ledger.list_folders(spark, table_location(spark, table))
    found = folder_ledger.changes(listing.where(F.startswith("folder", F.lit(f"{columns[0]}="))),
                                  folder_ledger.read_ledger(spark, ledger_path))
    path = scratch_path(spark, "ledger_changes")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    for change, verb in (("added", "ADD IF NOT EXISTS"), ("vanished", "DROP IF EXISTS")):
        names = [r[0] for r in found.where(F.col("change") == change).select("folder").orderBy("folder").toLocalIterator()]
        for i in range(0, len(names), 100):
            specs = [f"PARTITION ({_spec(_folder_spec(n))})" for n in names[i:i + 100]]
            spark.sql(f"ALTER TABLE {_q(table)} {verb} {(' ' if change == 'added' else ', ').join(specs)}")
    spark.catalog.refreshTable(table)
    folder_ledger.write_ledger(listing.where(F.startswith("folder", F.lit(f"{columns[0]}="))), ledger_path)
    return found


def _folder_spec(folder: str) -> dict[str, str | None]:
    key, value = folder.split("=", 1)
    return {unquote(key): None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)}


def add_partition(spark: SparkSession, table: str, spec: Mapping[str, object],
                  location: str | None = None) -> None:
    """Register one known partition (``{"dt": "2024-01-02"}``).

    A job that has just written a partition knows its folder, so it adds
    that one entry instead of listing every partition folder of the table
    (``refresh``); the cost stays the same however many days the table
    holds.  Adding a partition that is already there is a no-op.
    """
    values = ", ".join(f"{_q_column(k)} = {_lit(v)}" for k, v in spec.items())
    ddl = f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS PARTITION ({values})"
    if location:
        ddl += f" LOCATION {_lit(location)}"
    spark.sql(ddl)
    spark.catalog.refreshTable(table)


def same_name(spark: SparkSession, name: str) -> str:
    """The form in which Spark compares column names."""
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def compare(spark: SparkSession, table: str, new_schema: StructType) -> dict[str, list]:
    """How ``new_schema`` differs from the table's, without changing anything: fields
    ``added``, names ``gone``, ``widened`` (name, old, new) where the new type holds all
    values of the old one, ``changed`` (same form) for any other change of type."""
    fold = lambda name: same_name(spark, name)
    current = {fold(f.name): f for f in spark.table(table).schema.fields}
    partitions = set(map(fold, _partition_columns(spark, table)))
    incoming = {fold(f.name): f for f in new_schema.fields}
    differs = [(current[name].name, current[name].dataType, f.dataType)
               for name, f in incoming.items() if name in current and current[name].dataType != f.dataType]
    return {"added": [f for name, f in incoming.items() if name not in current],
            "gone": [f.name for name, f in current.items() if name not in incoming and name not in partitions],
            "widened": [d for d in differs if types.widens(d[1], d[2])],
            "changed": [d for d in differs if not types.widens(d[1], d[2])]}


def evolve(spark: SparkSession, table: str, new_schema: StructType, *, widen: bool = False) -> dict[str, list[str]]:
    """Schema drift policy.  Names are compared as Spark compares them.

    Columns in ``new_schema`` but not in the table are added (old files read
    them as NULL).  Columns missing from ``new_schema`` are not dropped: the
    table is marked ``deprecated`` with the names in a property, and the data
    is left alone.  With ``widen``, a column whose new type holds every value of the old
    one gets it (old files are cast as they are read).  Any other change of type is
    reported, and then nothing at all is altered.  Returns
    ``{"added": [...], "deprecated": [...], "changed": ["name: old -> new", ...]}``, and
    ``"widened"`` in the same form if there are any.
    """
    found = compare(spark, table, new_schema)
    changed = found["changed"] if widen else found["changed"] + found["widened"]
    told = lambda xs: [f"{n}: {old.simpleString()} -> {new.simpleString()}" for n, old, new in xs]
    out = {"added": [f.name for f in found["added"]], "deprecated": found["gone"], "changed": told(changed)}
    if changed:
        return out
    if found["widened"]:
        _with_types(spark, table, {n: new for n, _, new in found["widened"]})
        out["widened"] = told(found["widened"])
    if found["added"]:
        cols = ", ".join(f"{_q_column(f.name)} {f.dataType.simpleString()}" for f in found["added"])
        spark.sql(f"ALTER TABLE {_q(table)} ADD COLUMNS ({cols})")
    if found["gone"]:
        spark.sql(f"ALTER TABLE {_q(table)} SET TBLPROPERTIES "
                  f"('deprecated' = 'true', 'deprecated_columns' = {_lit(','.join(found['gone']))})")
    spark.catalog.refreshTable(table)
    return out


def partition_specs(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """The partitions of ``table`` as {column: value}; None stands for NULL."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {_q(table)}").collect():
        out.append({k: v for x in row[0].split("/") for k, v in _folder_spec(x).items()})
    return out


def _spec(spec: Mapping[str, object]) -> str:
    return ", ".join(f"{_q_column(k)} = {'NULL' if v is None else _lit(v)}" for k, v in spec.items())


def partition_location(spark: SparkSession, table: str, spec: Mapping[str, object]) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)} PARTITION ({_spec(spec)})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _with_types(spark: SparkSession, table: str, changes: Mapping[str, DataType]) -> None:
    """Give columns other types: the definition is written anew beside the old one, with
    all partitions, and takes its name.  No file is touched."""
    schema = spark.table(table).schema
    cols = ", ".join(f"{_q_column(f.name)} {changes.get(f.name, f.dataType).simpleString()}" for f in schema.fields)
    ddl = spark.sql(f"SHOW CREATE TABLE {_q(table)}").first()[0]
    rest = re.search(r"\)\s*(USING .*)$", ddl, re.DOTALL).group(1)
    fresh, old = f"{table}__wider", f"{table}__before"
    spark.sql(f"DROP TABLE IF EXISTS {_q(fresh)}")
    spark.sql(f"CREATE TABLE {_q(fresh)} ({cols}) {rest}")
    if _partition_columns(spark, table):
        specs = partition_specs(spark, table)
        for i in range(0, len(specs), 100):
            added = " ".join(f"PARTITION ({_spec(s)}) LOCATION {_lit(partition_location(spark, table, s))}"
                             for s in specs[i:i + 100])
            spark.sql(f"ALTER TABLE {_q(fresh)} ADD IF NOT EXISTS {added}")
    spark.sql(f"ALTER TABLE {_q(table)} RENAME TO {_q(old)}")
    try:
        spark.sql(f"ALTER TABLE {_q(fresh)} RENAME TO {_q(table)}")
    except BaseException:
        spark.sql(f"ALTER TABLE {_q(old)} RENAME TO {_q(table)}")
        raise
    spark.sql(f"DROP TABLE {_q(old)}")


def set_partition(spark: SparkSession, table: str, spec: Mapping[str, object], location: str) -> None:
    """Point one partition at ``location``: readers see the old folder until this
    statement and the new one after it."""
    spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS PARTITION ({_spec(spec)}) LOCATION {_lit(location)}")
    spark.sql(f"ALTER TABLE {_q(table)} PARTITION ({_spec(spec)}) SET LOCATION {_lit(location)}")
    spark.catalog.refreshTable(table)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """(namespace, tableName, isTemporary) rows of ``database``."""
    return spark.sql(f"SHOW TABLES IN {_q(database)}")


def table_stats(spark: SparkSession, table: str) -> DataFrame:
    """Row count and total size (bytes, and as ``pg_size_pretty`` prints
    it), computed by ``ANALYZE TABLE`` (a distributed scan) and read back
    from the catalog."""
    spark.sql(f"ANALYZE TABLE {_q(table)} COMPUTE STATISTICS")
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").where(F.col("col_name") == "Statistics")
    size = F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("bigint")
    return stats.select(
        F.lit(table).alias("table_name"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"),
        size.alias("size_bytes"), pretty_size(size).alias("size_pretty"))

"""File scans: CSV, Parquet (flat or hive-partitioned), one leaf partition,
and a file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery.csv_format import reader_options
from refinery.sources.csv_split import read_split_csv


def read_csv(spark: SparkSession, path: str | list[str], *, header: bool = True,
             schema: StructType | str | None = None, own: bool = False, split: bool = False,
             **options) -> DataFrame:
    """CSV scan by the package's CSV contract (``refinery.csv_format``); ``own``
    says that the package's own writers made the files.

    Values may hold line breaks.  Spark's own reader then takes a file in one task;
    with ``split`` a file is read by as many tasks as it has splits, with the same rows
    (``csv_split``).  ``enforceSchema=False`` makes a header that differs from the
    schema an error.

    With ``schema`` the file is read once.  Without it the column types are
    inferred, which costs an extra pass over the input (a task a file): fine for a
    small landing file, avoid it at scale.
    """
    reader = spark.read.options(**reader_options(header, typed=schema is not None, own=own))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    for key, value in options.items():
        reader = reader.option(key, value)
    if not split:
        return reader.csv(path)
    inferred = schema is None
    return read_split_csv(spark, path, reader.csv(path).schema if inferred else schema, header=header, own=own,
                          typed=not inferred, **options)


def read_parquet(spark: SparkSession, path: str | list[str], *,
                 base_path: str | None = None,
                 columns: list[str] | None = None,
                 schema: StructType | None = None) -> DataFrame:
    """Parquet scan of a file, a flat folder or a ``col=value/`` tree.

    Partition folders become typed trailing columns.  ``base_path`` keeps
    them when ``path`` points below the table root.  Selecting ``columns``
    here only documents intent: Catalyst prunes unused columns anyway.
    A known ``schema`` skips the schema-inference job of the scan.
    """
    reader = spark.read
    if schema is not None:        # known schema: no footer-reading job
        reader = reader.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def read_partition(spark: SparkSession, root: str, keep_partition_column: bool = False,
                   **partition: object) -> DataFrame:
    """Scan one leaf folder ``root/k1=v1/k2=v2``.

    Read plainly, a leaf folder loses its partition columns (they live in the
    folder names above it).  ``keep_partition_column=True`` reads with
    ``basePath=root`` so they are kept.
    """
    leaf = "/".join(f"{k}={v}" for k, v in partition.items())
    path = f"{root.rstrip('/')}/{leaf}"
    return read_parquet(spark, path, base_path=root if keep_partition_column else None)


def file_inventory(spark: SparkSession, root: str | list[str], glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of every file under ``root``.

    Uses the ``binaryFile`` source; selecting only the metadata columns means
    file contents are never read.  No page cap: every file is listed.  The
    driver holds the listing of one call; for a very large tree use
    :func:`inventory_by_folder`.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def inventory_by_folder(spark: SparkSession, root: str, out: str, glob: str | None = None,
                        folders: int = 64) -> DataFrame:
    """The inventory of ``root`` as a Parquet table at ``out``, listed ``folders``
    top-level folders at a time: the driver holds the files of so many folders,
    not of the whole tree.  Adds ``folder``, the top-level folder's name ("" for
    files right under ``root``)."""
    root = root.rstrip("/")
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    entries = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)
    names = sorted(e.getPath().getName() for e in entries
                   if e.isDirectory() and not e.getPath().getName().startswith(("_", ".")))
    schema = "folder string, path string, length long, modificationTime timestamp"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(out)
    loose = [e.getPath().toString() for e in entries
             if e.isFile() and not e.getPath().getName().startswith(("_", "."))]
    if loose:
        (file_inventory(spark, loose, glob).select(F.lit("").alias("folder"), "*")
         .write.mode("append").parquet(out))
    # paths come back with the scheme and authority of the file system
    depth = len([p for p in top.toUri().getPath().split("/") if p])
    parts = F.split(F.regexp_replace("path", "^[^:/]+:(//[^/]*)?", ""), "/+")
    for i in range(0, len(names), folders):
        part = [f"{root}/{name}" for name in names[i:i + folders]]
        (file_inventory(spark, part, glob).select(F.get(parts, F.lit(depth + 1)).alias("folder"), "*")
         .write.mode("append").parquet(out))
    return spark.read.schema(schema).parquet(out)

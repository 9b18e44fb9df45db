"""Folder ledger: what a table's folders held when they were last looked at.

The ledger is a table of (folder, files, bytes, newest file time).  A new listing joined
with it gives the folders that were added, landed again or removed since, so upkeep
touches those and not every folder of the table.  The listing is made ``folders`` at a
time (``inventory_by_folder``) and is never held whole by the driver; only the names of
folders that differ come to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import scratch_path
from refinery.sinks.publish import exists, replace_folder, restore
from refinery.sources.files import inventory_by_folder

SCHEMA = "folder string, files long, bytes long, newest timestamp"


def list_folders(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(folder, files, bytes, newest) of the top-level folders of ``root`` now, written."""
    files = inventory_by_folder(spark, root, scratch_path(spark, "ledger_files"), glob=glob)
    summed = files.where("folder <> ''").groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))
    path = scratch_path(spark, "ledger_now")
    summed.write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if there is none yet."""
    path = path.rstrip("/")
    restore(spark, path)
    return spark.read.schema(SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], SCHEMA)


def write_ledger(listing: DataFrame, path: str) -> None:
    """Make ``listing`` the ledger.  Do it after the work that the changes asked for: a
    run that fails before finds the same changes again."""
    with replace_folder(listing.sparkSession, path.rstrip("/")) as fresh:
        listing.write.parquet(fresh)


def changes(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """(folder, change): ``added``, ``changed`` (other files, bytes or times) or ``vanished``."""
    old = ledger.select(F.col("folder").alias("of_folder"), F.struct("files", "bytes", "newest").alias("was"))
    both = listing.select("folder", F.struct("files", "bytes", "newest").alias("now")).join(
        old, F.col("folder") == F.col("of_folder"), "full_outer")
    change = (F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "vanished")
              .when(F.col("now") != F.col("was"), "changed"))
    return both.select(F.coalesce("folder", "of_folder").alias("folder"), change.alias("change")).where("change is not null")

"""Refine only raw landings that arrived since the last run.

This is the "new folders only" refresh mode applied to the refine step:
the file stream source remembers in its checkpoint which files it has
processed, and ``trigger(availableNow=True)`` processes everything new and
stops, so a daily run costs only the new days.  A new file says that its day
was landed (again): the whole day is then read as it stands, refined, and
replaces that day of the output, so a day landed twice, or a batch replayed
after a failure, is there once.  Checkpoint and output live in the shared
folder passed in by the caller.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.csv_format import reader_options
from refinery.operators.refine import refine
from refinery.sinks.files import replace_day, write_partitioned
from refinery.sinks.publish import child_folders, put_in_place, remove


def refine_new_landings(spark: SparkSession, raw_table_path: str, schema: T.StructType,
                        refined_path: str, checkpoint: str, *,
                        keep: dict[str, Sequence[object]], upper: Sequence[str],
                        drop: Sequence[str], partition_column: str = "dt",
                        max_files_per_trigger: int | None = None) -> None:
    """Process all days with new CSV files under ``raw_table_path/<partition>=*/``.

    ``schema`` must include the partition column (filled from folder
    names).  The stream itself reads file names only.  A batch's days are read once,
    refined and written once, beside the output; each then takes its day's place.
    """
    raw_table_path, refined_path = raw_table_path.rstrip("/"), refined_path.rstrip("/")
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    folder = F.regexp_extract("path", f"/({re.escape(partition_column)}=[^/]+)/[^/]*$", 1)
    landed = reader.load(f"{raw_table_path}/{partition_column}=*").select(folder.alias("folder"))

    def replace_days(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # the days landed since the last run: folder names, not rows
        days = sorted(r[0] for r in batch.distinct().collect())
        if not days:
            return
        raw = (session.read.schema(schema).options(**reader_options(header=True), basePath=raw_table_path)
               .csv([f"{raw_table_path}/{day}" for day in days]))
        refined = refine(raw, keep=keep, upper=upper, drop=drop)
        stage = f"{refined_path}/.stage-{uuid.uuid4().hex[:12]}"
        write_partitioned(refined, stage, [partition_column], dynamic=False)
        kept = [f for f in child_folders(session, stage) if f.startswith(f"{partition_column}=")]
        for day in kept:
            put_in_place(session, f"{stage}/{day}", f"{refined_path}/{day}")
        remove(session, stage)
        for day in sorted(set(days) - set(kept)):        # a day of which no row is kept
            replace_day(refined.limit(0), refined_path, partition_column, day.split("=", 1)[1])

    query = (landed.writeStream.foreachBatch(replace_days)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

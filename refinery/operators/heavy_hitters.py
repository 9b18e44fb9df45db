"""The most frequent values of a key with very many values, without a shuffle of them.

Each task keeps a summary of at most ``capacity`` counters (Space-Saving in its mergeable
form): when there are more, the largest that has to go is taken off every counter and
added to the task's error.  Summaries merge by adding counters and errors.  A value's
true count lies between its counter and its counter plus the error E, and a value
without a counter has at most E.

So with L the kth largest counter, only values whose counter plus E reaches L can be
among the first k; these candidates are counted exactly, by their own rows.  If E is
below L, no value without a counter can be among them, which proves the answer.  If not,
the capacity is raised; beyond ``MOST`` the exact count over all values is taken.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.operators.quality import top_k
from refinery.session import scratch_path

MOST = 1 << 22


class Summary:
    """Counters of 64-bit values with an error bound."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.values = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        found, counts = np.unique(values, return_counts=True)
        self.merge(found, counts, 0)

    def merge(self, values: np.ndarray, counts: np.ndarray, error: int) -> None:
        self.error += error
        values, place = np.unique(np.concatenate([self.values, values]), return_inverse=True)
        total = np.zeros(len(values), np.int64)
        np.add.at(total, place, np.concatenate([self.counts, counts]))
        if len(values) > self.capacity:
            # the largest counter that has to go comes off all of them
            cut = int(np.partition(total, len(total) - self.capacity - 1)[len(total) - self.capacity - 1])
            self.error += cut
            total -= cut
            values, total = values[total > 0], total[total > 0]
        self.values, self.counts = values, total


def _summaries(capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity)
        for batch in batches:
            if batch.num_rows:
                summary.add(batch.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *summary.values.tolist()], pa.int64()), pa.array([summary.error, *summary.counts.tolist()], pa.int64())],
            names=["h", "n"])
    return run


def heavy_hitters(df: DataFrame, keys: Sequence[str], k: int = 10, *, capacity: int = 4096,
                  count_name: str = "count") -> DataFrame:
    """The rows of ``top_k(df, keys, k)``: the ``k`` most frequent combinations, ties by the
    keys.  Values are told apart by a hash in the summaries only; what is counted are
    the values themselves."""
    h = F.xxhash64(*[x for c in keys for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    spark = df.sparkSession
    while capacity <= MOST:
        path = scratch_path(spark, "summaries")
        (df.select(h.alias("h")).mapInArrow(_summaries(capacity), "h long, n long")
         .groupBy("h").agg(F.sum("n").alias("n")).write.parquet(path))
        merged = spark.read.schema("h long, n long").parquet(path)
        first = merged.where("h is not null").orderBy(F.desc("n")).limit(k).agg(F.min("n").alias("l"), F.count("*").alias("k")).first()
        error = merged.where("h is null").agg(F.sum("n")).first()[0] or 0
        least = (first["l"] or 0) if first["k"] == k else 0
        if error < least or error == 0:
            # written, so that its size is known: a few candidates are broadcast and no row is
            # shuffled, many are joined by a shuffle
            chosen = scratch_path(spark, "candidates")
            merged.where(F.col("h").isNotNull() & (F.col("n") + error >= least)).select("h").coalesce(1).write.parquet(chosen)
            asked = spark.read.schema("h long").parquet(chosen)
            return top_k(df.withColumn("__h", h).join(asked, F.col("__h") == F.col("h"), "left_semi"),
                         keys, k, count_name=count_name)
        capacity *= 8
    return top_k(df, keys, k, count_name=count_name)

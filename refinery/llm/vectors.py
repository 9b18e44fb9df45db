"""A stated query set against all vectors, in cells of bounded size.

``cells`` deals query rows and candidate rows to cells: every query block meets
every candidate range in exactly one cell.  A cell arrives in one task with its
queries first (at most about ``QUERY_CELL``, held in memory) and its candidates
after them as a stream, so a task never holds a candidate range.  Candidate ranges
are runs of ``RUN`` consecutive stored rows, dealt round robin, so neither a
repeated id nor a repeated vector makes a range larger.

Vectors are whole numbers: ``floor(scale * x)`` with x as double.  Rows with a null
id, a null vector, or a null, NaN or infinite component take no part.  Vectors of
different length are padded with zeros.  A score that might not fit 64 bits fails
the job (``check_reach``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_CELL = 1 << 15
CANDIDATE_CELL = 1 << 17
RUN = 64
TILE = 4096
#: stands for "no entry" in a heap
NO_SCORE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole(df: DataFrame, scale: int, *, id: str, vector: str, **more: Column) -> DataFrame:
    """(id, vec, more...) of the rows that take part."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(f"`{id}`").isNotNull() & v.isNotNull() & finite).select(
        F.col(f"`{id}`").cast("long").alias("id"), *[c.alias(n) for n, c in more.items()],
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("vec"))


def one_per_id(queries: DataFrame) -> DataFrame:
    """Of query rows that share an id, the one with the smallest other columns."""
    rest = [c for c in queries.columns if c != "id"]
    return (queries.groupBy("id").agg(F.min(F.struct(*rest)).alias("first")).select("id", "first.*"))


def cells(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of ``queries`` (one per id) and ``candidates`` dealt to cells, sorted for :func:`runs`: (cell, kind 0 query / 1 candidate, run, columns)."""
    session = queries.sparkSession
    blocks = max(1, -(-queries.count() // QUERY_CELL))
    at_least = -(-2 * session.sparkContext.defaultParallelism // blocks)
    ranges = max(1, at_least, -(-candidates.count() // CANDIDATE_CELL))
    # the number of the run goes up by one every RUN rows of a task
    run = F.shiftright(F.monotonically_increasing_id(), RUN.bit_length() - 1)
    dealt = (candidates.withColumn("run", run)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .withColumn("cell", F.col("block") * ranges + F.pmod("run", F.lit(ranges))).withColumn("kind", F.lit(1)))
    asked = (queries.withColumn("run", F.lit(0).cast("long"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
             .withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))))
             .withColumn("cell", F.col("block") * ranges + F.col("range")).withColumn("kind", F.lit(0)))

    def laid(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select(F.col("cell").cast("long").alias("cell"), "kind", "run", *names)

    # what only the queries have is null in the candidates
    both = laid(dealt, candidates.columns).unionByName(laid(asked, queries.columns), allowMissingColumns=True)
    return both.repartition(blocks * ranges, "cell").sortWithinPartitions("cell", "kind", "run", "id")


class Rows(NamedTuple):
    """Rows of one cell: ids, runs, a matrix of whole numbers, and the other columns."""

    id: np.ndarray
    run: np.ndarray
    vec: np.ndarray
    rest: pa.Table


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of whole numbers as a matrix, short ones padded with zeros."""
    offsets = vectors.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = vectors.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.int64, copy=False)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def same_width(*parts: np.ndarray) -> list[np.ndarray]:
    width = max(p.shape[1] for p in parts)
    return [p if p.shape[1] == width else np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]


def _rows(parts: list[pa.RecordBatch]) -> Rows:
    table = pa.Table.from_batches(parts).combine_chunks()
    vec = table["vec"].combine_chunks()
    vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
    return Rows(table["id"].to_numpy(), table["run"].to_numpy(), matrix(vec), table)


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Rows | None, Rows | None]]:
    """``(queries, None)`` when a cell begins, ``(None, candidates)`` for each tile of
    at most ``TILE`` of its candidates (whole runs), ``(None, None)`` when it ends.
    Cells without queries are passed over."""
    cell, asked, held, size, begun = None, [], [], 0, False

    def tile() -> Rows:
        nonlocal held, size
        out, held, size = _rows(held), [], 0
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column("cell").to_numpy(), batch.column("kind").to_numpy(), batch.column("run").to_numpy()])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            c, kind = int(key[0, start]), int(key[1, start])
            if c != cell:
                if begun:
                    if held:
                        yield None, tile()
                    yield None, None
                cell, asked, held, size, begun = c, [], [], 0, False
            part = batch.slice(start, end - start)
            if kind == 0:
                asked.append(part)
                continue
            if not asked and not begun:
                continue
            if not begun:
                yield _rows(asked), None
                asked, begun = [], True
            if held and size + part.num_rows > TILE:
                yield None, tile()
            held.append(part)
            size += part.num_rows
    if begun:
        if held:
            yield None, tile()
        yield None, None


def check_reach(a: np.ndarray, b: np.ndarray) -> None:
    """Raise unless every inner product of rows of ``a`` and ``b`` fits 64 bits."""
    if a.size and b.size:
        most = np.abs(a.astype(float)).sum(axis=1).max() * np.abs(b.astype(float)).max()
        if most >= 2.0 ** 62:
            raise OverflowError("an inner product might not fit 64 bits: use a smaller scale")


def distinct(rows: Rows) -> np.ndarray:
    """Positions of ``rows`` in the order of ids, equal rows once."""
    order = np.argsort(rows.id, kind="stable")
    ids = rows.id[order]
    again = np.flatnonzero(ids[1:] == ids[:-1]) + 1
    if not len(again):
        return order
    seen, keep = set(), np.ones(len(order), dtype=bool)
    for at in np.union1d(again, again - 1):
        this = (int(ids[at]), rows.vec[order[at]].tobytes(),
                str(rows.rest.slice(int(order[at]), 1).drop_columns(["run", "vec"]).to_pylist()))
        keep[at] = this not in seen
        seen.add(this)
    return order[keep]


class Heaps:
    """The ``k`` best (score descending, id ascending) of each of ``n`` queries.

    Heaps of different tiles, tasks or machines merge: the best of a union are among
    the best of its parts.  Equal entries (a row met twice) count once."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), NO_SCORE, dtype=np.int64)
        self.ids = np.full((n, k), NO_ID, dtype=np.int64)

    def kth(self) -> np.ndarray:
        """The score that a new entry must at least have."""
        return self.scores[:, -1]

    def push(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge entries (one row per position of ``at``, ``NO_SCORE`` = none) in."""
        useful = scores.max(axis=1, initial=NO_SCORE) >= np.maximum(self.scores[at, -1], NO_SCORE + 1)
        at, scores, ids = at[useful], scores[useful], ids[useful]
        if not len(at):
            return
        scores = np.concatenate([self.scores[at], scores], axis=1)
        ids = np.concatenate([self.ids[at], np.where(scores[:, self.k:] == NO_SCORE, NO_ID, ids)], axis=1)
        for _ in range(2):
            # ~x turns the order round and, unlike -x, has no overflow
            order = np.lexsort((ids, ~scores), axis=1)
            scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
            twice = (scores[:, 1:] == scores[:, :-1]) & (ids[:, 1:] == ids[:, :-1]) & (scores[:, 1:] != NO_SCORE)
            if not twice.any():
                break
            scores[:, 1:][twice], ids[:, 1:][twice] = NO_SCORE, NO_ID
        self.scores[at], self.ids[at] = scores[:, :self.k], ids[:, :self.k]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the query, id, score) of all entries."""
        row, col = np.nonzero(self.scores != NO_SCORE)
        return row, self.ids[row, col], self.scores[row, col]


def merged(parts: DataFrame, k: int, *keys: str) -> DataFrame:
    """The heaps of all cells as one: ``parts`` (keys, id, score) -> the ``k`` best of
    each key with their ``rank``."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    # equal entries share a dense rank, and then count once
    ranked = parts.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k)
    return ranked.groupBy(*keys, "rank").agg(F.first("id").alias("id"), F.first("score").alias("score"))

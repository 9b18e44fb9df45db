"""Exact top-k search by block-at-a-time pruning.

Each candidate range is cut into blocks of consecutive stored rows.  A term is a
dimension; a block's index holds, per term, the greatest and the least weight of its
rows, and its forward index: the rows' weights by term.  A query sums, over its
terms, the most that a block can give (the greatest weight where the query's is
positive, the least where it is negative), visits the blocks in descending order of
that bound and scores them through their forward indexes.  It stops at the first
block whose bound is below its kth score so far; a block that equals the kth score
may still hold a smaller id and is scored.  So results are exact, whatever is pruned.

The queries' heaps of all ranges are merged by one window with a limit per task.
Edge cases: see ``vectors``; fewer than k candidates give all; rows of the query's
own id are no candidates; equal rows count once; of query rows that share an id the
one with the smallest vector asks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import (
    NO_ID, NO_SCORE, Heaps, Rows, cells, check_reach, distinct, merged, one_per_id, runs, same_width, whole)

CHUNK = 512


class BlockIndex:
    """Blocks of one tile: term bounds and forward indexes."""

    def __init__(self, tile: Rows):
        kept = np.sort(distinct(tile))
        run = tile.run[kept]
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        sizes = np.diff(np.r_[starts, len(run)])
        vec = tile.vec[kept]
        self.most, self.least = np.maximum.reduceat(vec, starts), np.minimum.reduceat(vec, starts)
        block = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(run)) - np.repeat(starts, sizes)
        self.rows = np.zeros((len(starts), int(sizes.max()), vec.shape[1]), dtype=np.int64)
        self.rows[block, place] = vec
        self.ids = np.full(self.rows.shape[:2], NO_ID, dtype=np.int64)
        self.ids[block, place] = tile.id[kept]
        self.there = np.zeros(self.rows.shape[:2], dtype=bool)
        self.there[block, place] = True

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that any row of each block can score, per query."""
        return np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T

    def scores(self, queries: np.ndarray, blocks: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the rows of one block per query."""
        ids = self.ids[blocks]
        found = np.matmul(self.rows[blocks], queries[:, :, None])[:, :, 0]
        return np.where(self.there[blocks] & (ids != own[:, None]), found, NO_SCORE), ids


def search(index: BlockIndex, queries: np.ndarray, own: np.ndarray, heaps: Heaps) -> int:
    """Visit the blocks of ``index`` for all queries; returns the blocks scored."""
    visited = 0
    for start in range(0, len(queries), CHUNK):
        at = np.arange(start, min(start + CHUNK, len(queries)))
        bounds = index.bounds(queries[at])
        order = np.argsort(~bounds, axis=1, kind="stable")
        for step in range(order.shape[1]):
            block = order[at - start, step]
            open_ = bounds[at - start, block] >= heaps.kth()[at]
            # bounds fall and kth scores rise: a query that stops here has stopped
            at, block = at[open_], block[open_]
            if not len(at):
                break
            visited += len(at)
            heaps.push(at, *index.scores(queries[at], block, own[at]))
    return visited


def _top(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = heaps = None
        for queries, tile in runs(batches):
            if queries is not None:
                asked, heaps = queries, Heaps(len(queries.id), k)
            elif tile is not None:
                wide, vec = same_width(asked.vec, tile.vec)
                check_reach(wide, vec)
                if not wide.shape[1]:            # only empty vectors: every score is 0
                    wide, vec = np.zeros((len(wide), 1), np.int64), np.zeros((len(vec), 1), np.int64)
                search(BlockIndex(tile._replace(vec=vec)), wide, asked.id, heaps)
            else:
                row, ids, scores = heaps.entries()
                yield pa.RecordBatch.from_pydict({"query_id": asked.id[row], "id": ids, "score": scores})
    return run


def top_k(df: DataFrame, queries: Column, k: int, *, scale: int, id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, ``id``, score): of each row where ``queries`` holds, the ``k``
    other rows of the highest integer inner product, ties to the smaller id."""
    candidates = whole(df, scale, id=id, vector=vector)
    asked = one_per_id(whole(df.where(queries), scale, id=id, vector=vector))
    parts = cells(asked, candidates).mapInArrow(_top(k), "query_id long, id long, score long")
    return merged(parts, k, "query_id").select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")


#: DuckDB, for the registered query's parameters
ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT vec_id, min(vec) AS vec FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.vec, v.vec), lambda p: (p[1] * p[2])::BIGINT))::BIGINT AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 20
"""

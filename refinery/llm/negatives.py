"""Hard-negative mining by integer matrix products.

Scores of anchors against candidates are products of int64 tiles, multiplied by
Strassen's recursion (seven half-size products instead of eight; odd sizes padded
with zeros).  It uses only ring operations, so sums and differences are exact
whenever the result fits 64 bits, which is checked.

Two passes over the same cells (see ``vectors``).  The first multiplies anchors by
candidates of their own label and keeps per anchor a heap of positives.  Heaps of
all cells merge into the anchor's first positives.  The second multiplies anchors by
candidates of other labels and keeps, for each positive, a heap of the window
``low * positive <= 100 * negative <= high * positive``; these merge likewise.

Edge cases: see ``vectors``; rows with a null label take no part.  An anchor without
another row of its label, and a window without a row, give no row.  Rows of the
anchor's own id are not its positives.  Equal rows count once; of anchor rows that
share an id the one with the smallest label, then vector, stands.  The
limits of a window are worked out once, in decimals, so no comparison can overflow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared
from .vectors import (
    NO_ID, NO_SCORE, Heaps, Rows, cells, check_reach, distinct, merged, one_per_id, runs, same_width, whole)

LEAF = 32
ANCHOR_TILE = 512


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:m, :n], out[m:, n:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    out[m:, :n] = p
    out[m:, n:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:m, n:] = p
    out[m:, n:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:m, :n] += p
    out[m:, :n] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:m, :n] -= p
    out[:m, n:] += p
    out[m:, n:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:m, :n] += strassen(a12 - a22, b21 + b22, leaf)
    return out


def _label(rows: Rows) -> np.ndarray:
    return rows.rest["label"].to_numpy()


def _tile(asked: Rows, tile: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and candidates of one width, and the candidates' ids and labels, by id."""
    kept = distinct(tile)
    anchors, vec = same_width(asked.vec, tile.vec[kept])
    check_reach(anchors, vec)
    return anchors, vec, tile.id[kept], _label(tile)[kept]


def _products(anchors: np.ndarray, at: np.ndarray, vec: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, scores) of the anchors at ``at``, tile by tile."""
    turned = np.ascontiguousarray(vec.T)
    for start in range(0, len(at), ANCHOR_TILE):
        part = at[start:start + ANCHOR_TILE]
        yield part, strassen(anchors[part], turned)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row; ``ids`` ascend, so the stable order settles ties."""
    order = np.argsort(~scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), ids[order]


def _positives(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = heaps = None
        for queries, tile in runs(batches):
            if queries is not None:
                asked, heaps = queries, Heaps(len(queries.id), k)
            elif tile is not None:
                anchors, vec, ids, labels = _tile(asked, tile)
                own = _label(asked)
                for label in np.intersect1d(own, labels):
                    same = labels == label
                    for part, scores in _products(anchors, np.flatnonzero(own == label), vec[same]):
                        scores[ids[same][None, :] == asked.id[part][:, None]] = NO_SCORE
                        heaps.push(part, *_best(scores, ids[same], k))
            else:
                row, ids, scores = heaps.entries()
                yield pa.RecordBatch.from_pydict({"anchor_id": asked.id[row], "id": ids, "score": scores})
    return run


def _windows(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = heaps = owner = low = high = positive = against = None
        for queries, tile in runs(batches):
            if queries is not None:
                asked = queries
                windows = asked.rest["windows"].combine_chunks()
                windows = windows.chunk(0) if isinstance(windows, pa.ChunkedArray) else windows
                owner = np.repeat(np.arange(len(asked.id)), np.diff(windows.offsets.to_numpy()))
                inner = windows.flatten()
                low, high, positive, against = (
                    inner.field(n).to_numpy() for n in ("low", "high", "positive_id", "positive_score"))
                heaps = Heaps(len(owner), k)
            elif tile is not None:
                anchors, vec, ids, labels = _tile(asked, tile)
                own = _label(asked)
                for part, scores in _products(anchors, np.arange(len(anchors)), vec):
                    scores[own[part][:, None] == labels[None, :]] = NO_SCORE
                    order = np.argsort(~scores, axis=1, kind="stable")
                    scores, by = np.take_along_axis(scores, order, 1), ids[order]
                    # a window is a stretch of the anchor's sorted scores
                    mine = np.flatnonzero((owner >= part[0]) & (owner <= part[-1]))
                    row = owner[mine] - part[0]
                    first = np.array([scores.shape[1] - np.searchsorted(scores[r, ::-1], h, "right")
                                      for r, h in zip(row, high[mine])], dtype=np.int64)
                    col = first[:, None] + np.arange(k)
                    there = col < scores.shape[1]
                    col = np.minimum(col, scores.shape[1] - 1)
                    found, who = scores[row[:, None], col], by[row[:, None], col]
                    fits = there & (found >= low[mine][:, None]) & (found != NO_SCORE)
                    heaps.push(mine, np.where(fits, found, NO_SCORE), np.where(fits, who, NO_ID))
            else:
                row, ids, scores = heaps.entries()
                yield pa.RecordBatch.from_pydict({"anchor_id": asked.id[owner[row]], "positive_id": positive[row],
                                                  "positive_score": against[row], "id": ids, "score": scores})
    return run


def _ceil_share(score: Column, share: int) -> Column:
    """Least whole x with 100 * x >= share * score, in exact decimals."""
    return F.ceil(score.cast("decimal(20,0)") * F.lit(share).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)")).cast("long")


def _floor_share(score: Column, share: int) -> Column:
    return F.floor(score.cast("decimal(20,0)") * F.lit(share).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)")).cast("long")


def mine(df: DataFrame, anchors: Column, *, scale: int, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100, id: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each row where ``anchors`` holds and each of its first ``positives`` rows of the same
    label, the first ``negatives`` rows of other labels whose score is ``low`` to ``high``
    hundredths of the positive's."""
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    take = dict(id=id, vector=vector, label=label.cast("long"))
    candidates = whole(df, scale, **take).where(F.col("label").isNotNull())
    asked = shared(one_per_id(whole(df.where(anchors), scale, **take).where(F.col("label").isNotNull())), "anchors")
    parts = cells(asked, candidates).mapInArrow(_positives(positives), "anchor_id long, id long, score long")
    first = shared(merged(parts, positives, "anchor_id").select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    window = F.struct("positive_id", "positive_score", _ceil_share(F.col("positive_score"), low).alias("low"),
                      _floor_share(F.col("positive_score"), high).alias("high"))
    # positives that share an id (one id, several vectors) have a window each
    windows = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    asked = asked.join(windows, asked["id"] == windows["anchor_id"]).drop("anchor_id")
    parts = cells(asked, candidates).mapInArrow(
        _windows(negatives), "anchor_id long, positive_id long, positive_score long, id long, score long")
    return merged(parts, negatives, "anchor_id", "positive_id", "positive_score").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


#: DuckDB, for the registered query's parameters
ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT vec_id, min({'label': label, 'vec': vec}) AS r FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.r.label = v.label AS same,
        list_sum(list_transform(list_zip(a.r.vec, v.vec), lambda p: (p[1] * p[2])::BIGINT))::BIGINT AS score
      FROM a JOIN v ON a.vec_id <> v.vec_id OR a.r.label <> v.label),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
      WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
WHERE rank <= 5
"""

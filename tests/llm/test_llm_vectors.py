"""Hard negatives and top-k search against plain Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.llm import negatives, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, score string, rank string"


def plain_rows(rows, scale, labelled=False):
    """Distinct (id, label, whole numbers) that take part."""
    out = set()
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or labelled and label is None:
            continue
        out.add((i, label if labelled else None, tuple(math.floor(scale * x) for x in v)))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def first_per_id(rows, wanted):
    out = {}
    for i, label, v in sorted(r for r in rows if wanted(r[0])):
        out.setdefault(i, (label, v))
    return out


def plain_top_k(rows, wanted, k, scale):
    rows = plain_rows([(i, v, None) for i, v, _ in rows], scale)
    rows = {(i, 0, v) for i, _, v in rows}
    out = []
    for q, (_, v) in first_per_id(rows, wanted).items():
        best = sorted({(-dot(v, w), i) for i, _, w in rows if i != q})[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def plain_negatives(rows, wanted, scale, p=5, n=5):
    rows = plain_rows(rows, scale, labelled=True)
    out = []
    for a, (label, v) in first_per_id(rows, wanted).items():
        scored = {(-dot(v, w), i, lab) for i, lab, w in rows}
        for s, i, _ in sorted(x for x in scored if x[1] != a and x[2] == label)[:p]:
            fits = sorted({(t, j) for t, j, lab in scored if lab != label and 80 * -s <= 100 * -t <= 100 * -s})[:n]
            out += [(a, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fits, 1)]
    return sorted(out)


def _rows(seed, n, dim=9, few=False):
    rng = random.Random(seed)
    spread = [-1.0, -0.5, 0.25, 0.5, 1.0] if few else None
    rows = [(i, [rng.choice(spread) if few else float(np.float32(rng.gauss(0.1, 0.5))) for _ in range(dim)], rng.randint(0, 3))
            for i in range(n)]
    rows += [(None, [1.0] * dim, 1), (n, None, 1), (n + 1, [1.0, None] + [0.0] * (dim - 2), 1), (n + 2, [math.nan] * dim, 1),
             (n + 3, [math.inf] * dim, 1), (n + 4, [], 1), (n + 5, [2.0], 2), (n + 6, [0.5] * (dim + 3), 0), (n + 7, [0.0] * dim, None)]
    rows += [rows[0], rows[5], rows[5], (10, [0.75] * dim, 2), (20, [0.75] * dim, 2)]       # repeated rows, ids with two vectors
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("few", [False, True])
def test_top_k_matches_brute_force(spark, few):
    rows = _rows(1, 400, few=few)
    out = topk.top_k(_frame(spark, rows), F.col("vec_id") % 10 == 0, 7, scale=64)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, out.collect())) == plain_top_k(rows, lambda i: i % 10 == 0, 7, 64)


@pytest.mark.parametrize("few", [False, True])
def test_negatives_match_brute_force(spark, few):
    rows = _rows(2, 300, few=few)
    out = negatives.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0, scale=256)
    got = sorted(map(tuple, out.collect()))
    assert got == plain_negatives(rows, lambda i: i % 10 == 0, 256) and got
    relabelled = [(i, v, None if lab is None else (lab + 1) % 3 if i is not None and i % 7 == 0 else lab) for i, v, lab in rows]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    out = negatives.mine(_frame(spark, rows), F.col("vec_id") % 25 == 0, scale=256, label=label)
    assert sorted(map(tuple, out.collect())) == plain_negatives(relabelled, lambda i: i % 25 == 0, 256)


def test_cells_of_many_blocks_give_the_same(spark, monkeypatch):
    rows = _rows(3, 300)
    monkeypatch.setattr(vectors, "QUERY_CELL", 7)
    monkeypatch.setattr(vectors, "CANDIDATE_CELL", 50)
    out = topk.top_k(_frame(spark, rows), F.col("vec_id") % 5 == 0, 4, scale=64)
    assert sorted(map(tuple, out.collect())) == plain_top_k(rows, lambda i: i % 5 == 0, 4, 64)


def test_no_queries_no_rows_and_overflow(spark):
    rows = _frame(spark, _rows(4, 30))
    assert topk.top_k(rows, F.col("vec_id") < 0, 3, scale=64).collect() == []
    assert topk.top_k(rows.limit(0), F.col("vec_id") % 2 == 0, 3, scale=64).collect() == []
    assert negatives.mine(rows.limit(0), F.col("vec_id") % 2 == 0, scale=64).collect() == []
    huge = _frame(spark, [(i, [3e30] * 3, 1) for i in range(4)])
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(huge, F.col("vec_id") == 0, 3, scale=64).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(1, 70), st.integers(1, 70), st.integers(0, 2 ** 31))
def test_strassen_is_exact(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-2 ** 27, 2 ** 27, (m, k)), rng.integers(-2 ** 27, 2 ** 27, (k, n))
    assert (negatives.strassen(a, b, leaf=4) == a.astype(object) @ b.astype(object)).all()


def test_strassen_recurses():
    calls = []
    plain = negatives.strassen
    a = np.arange(64 * 64).reshape(64, 64)
    try:
        negatives.strassen = lambda x, y, leaf: calls.append(x.shape) or plain(x, y, leaf)
        plain(a, a, 32)
    finally:
        negatives.strassen = plain
    assert calls == [(32, 32)] * 7


def test_pruning_skips_blocks_and_loses_nothing():
    """Blocks along one direction: most bounds are below the kth score."""
    rng = np.random.default_rng(5)
    vec = np.concatenate([rng.integers(-3, 4, (64, 8)) + 10 * (b % 16) for b in range(32)])
    import pyarrow as pa
    ids, run = np.arange(len(vec)), np.repeat(np.arange(32), 64)
    tile = vectors.Rows(ids, run, vec, pa.table({"id": ids, "run": run, "vec": pa.array(vec.tolist())}))
    queries, own = np.ones((5, 8), np.int64), np.array([3, 1999, -1, -2, 77])
    heaps = vectors.Heaps(5, 10)
    visited = topk.search(topk.BlockIndex(tile), queries, own, heaps)
    assert visited < 5 * 32 / 4
    scores = vec.sum(axis=1)
    for q in range(5):
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != own[q])[:10]
        assert list(zip((-heaps.scores[q]).tolist(), heaps.ids[q].tolist())) == want


def test_heaps_merge_in_any_order():
    rng = random.Random(8)
    entries = [(rng.randint(0, 5), rng.randint(0, 30)) for _ in range(200)]
    want = sorted({(-s, i) for s, i in entries})[:6]
    for _ in range(5):
        rng.shuffle(entries)
        heaps, at = vectors.Heaps(1, 6), 0
        while at < len(entries):
            part = entries[at:at + rng.randint(1, 20)]
            at += len(part)
            heaps.push(np.array([0]), np.array([[s for s, _ in part]]), np.array([[i for _, i in part]]))
        assert list(zip((-heaps.scores[0]).tolist(), heaps.ids[0].tolist())) == want

"""SimHash: fingerprints and groups against plain Python."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from refinery.llm import simhash as S


def plain_fingerprint(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(items, near):
    head = {x: x for x in items}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    items = sorted(items)
    for i, a in enumerate(items):
        for b in items[i + 1:]:
            if near(a, b):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {x: find(x) for x in items}


def test_fingerprint_matches_plain_python(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one two", "ONE two", "a b c a b c", "Ä b c d\x1ce f g", "x" * 500]
    texts += [" ".join(rng.choice(["A", "bb", "É", "漢", "d\n", "e\t"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    for t in texts:
        assert S.fingerprint(t) == plain_fingerprint(t), t
    monkeypatch.setattr(S, "_TEXT_BLOCK", 16)       # blocks with carried words give the same
    for t in texts:
        assert S.fingerprint(t) == plain_fingerprint(t), t


def test_spark_hash_is_the_same(spark):
    texts = ["héllo wörld", "a", "x" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert all(r.h % (1 << 64) == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in got)


def test_bit_sliced_groups_match_all_pairs():
    rng = np.random.default_rng(3)
    for radius in (0, 1, 2, 3, 4):
        base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
        near = base.repeat(5)
        for _ in range(radius + 1):
            near = near ^ (np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64))
        fps = np.unique(np.concatenate([base, near]))
        bucket = np.sort(rng.integers(0, 4, len(fps)))
        want = plain_groups(range(len(fps)), lambda i, j: bucket[i] == bucket[j]
                            and int(fps[i] ^ fps[j]).bit_count() <= radius)
        assert S.local_groups(fps, bucket, radius).tolist() == [want[i] for i in range(len(fps))]


def test_keys_miss_no_link_and_bound_buckets():
    masks = [m % (1 << 64) for m in S.key_masks(2)]
    assert len(masks) == 28 and all((~m % (1 << 64)).bit_count() == 16 for m in masks)
    for i in range(64):
        for j in range(i + 1):
            flipped = (1 << i) | (1 << j)
            assert any(not flipped & m for m in masks)


def test_groups_on_chains_and_hot_buckets(spark):
    """A long chain of single flips, a dense cluster and single fingerprints."""
    rng = random.Random(4)
    chain, x = [], rng.getrandbits(64)
    for i in range(40):
        chain.append(x)
        x ^= 1 << (i * 7 % 64)
    centre = rng.getrandbits(64)
    cluster = [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)]
    fps = sorted(set(chain + cluster + [rng.getrandbits(64) for _ in range(100)] + [0]))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node % (1 << 64): r.root for r in S.contract(S.fingerprint_links(df)).collect()}
    want = plain_groups(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    got = {}
    for f in fps:
        got.setdefault(roots.get(f, f"own{f}"), set()).add(f)
    groups = {}
    for f, h in want.items():
        groups.setdefault(h, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_query_matches_all_pairs(spark):
    from conftest import SF001
    from refinery.llm.queries import op1_simhash_near_dedup
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    fp = dict(docs)
    want = plain_groups([d for d, _ in docs], lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op1_simhash_near_dedup(spark, SF001).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in docs}

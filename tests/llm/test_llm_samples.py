"""Samples, places and models hold whatever repeats in a table."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import language, mixing, secrets, toxicity
from refinery.llm.common import SpanHash, code_points, sampled, shared

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("equal", [0.0, 0.9, 1.0])
def test_a_sample_is_as_large_as_asked_for(spark, equal):
    rows = 5000
    df = shared(spark.range(rows, numPartitions=7).select(F.when(F.col("id") < rows * equal, -1).otherwise(F.col("id")).alias("x")), "t")
    for n in (0, 1, 2000, rows, 2 * rows):
        got = sampled(df, n)
        assert got.count() == min(n, rows)
    share = sampled(df, 1000).where("x = -1").count() / 1000
    assert abs(share - equal) < 0.08
    assert sorted(map(tuple, sampled(df, 300).collect())) == sorted(map(tuple, sampled(df, 300).collect()))


def _key(rng, n=40):
    return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))


@pytest.mark.parametrize("same_id, same_text", [(0.0, 0.9), (1.0, 0.9), (1.0, 0.0), (0.0, 1.0)])
def test_random_keys_are_found_in_tables_of_copies(spark, same_id, same_text):
    rng = random.Random(2)
    base = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()]
    rows = [(1 if i < 4000 * same_id else i, base[0] if i < 4000 * same_text else base[i % len(base)]) for i in range(4000)]
    keys = {9000 + i: _key(rng) for i in range(20)}
    rows += [(i, f"the value is {k} here") for i, k in keys.items()]
    docs = shared(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), "t")
    found = {r.doc_id: r.found for r in secrets.scan(docs, secrets.train(docs)).where("doc_id >= 9000").collect()}
    for i, k in keys.items():
        assert [(s.kind, s.start, s.end) for s in found[i] or []] == [("markov", 13, 13 + len(k))]


def test_precision_on_labelled_names_and_keys(spark):
    """What is stated in the README: names that people write against random keys."""
    rng = random.Random(6)
    words = "retry count user account handler config default timeout session render image upload cache index".split()
    names = ["_".join(rng.choice(words) for _ in range(4)) for _ in range(60)]
    names += ["_".join(rng.choice(words) for _ in range(4)).upper() for _ in range(60)]
    names += ["-".join(rng.choice(words) for _ in range(4)) for _ in range(60)]
    names += [f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}-"
              f"{rng.randint(0, 59):02}-{rng.randint(0, 59):02}Z-{rng.choice(words)}" for _ in range(60)]
    names += ["-".join("".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12)) for _ in range(60)]
    keys = [_key(rng, n) for n in (20, 24, 32, 40) for _ in range(75)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = secrets._literal(secrets.train(docs))
    df = spark.createDataFrame([(x, i < len(names)) for i, x in enumerate(names + keys)], "x string, name boolean")
    got = Counter((r.name, r.hit) for r in df.select("name", secrets._accepted("markov", F.col("x"), table, 12.0).alias("hit")).collect())
    precision, recall = got[False, True] / (got[False, True] + got[True, True]), got[False, True] / len(keys)
    assert precision >= 0.97 and recall >= 0.99


@pytest.mark.parametrize("ids", ["null", "one", "few", "own"])
def test_every_source_ends_within_a_document_of_its_target(spark, ids):
    doc_id = {"null": F.lit(None).cast("long"), "one": F.lit(7).cast("long"), "few": F.col("id") % 5, "own": F.col("id")}[ids]
    sizes = F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") % 9 + 1).cast("int")))
    docs = spark.range(400, numPartitions=5).select(doc_id.alias("doc_id"), sizes.alias("text"),
                                                    F.when(F.col("id") < 300, "a").otherwise("b").alias("source"))
    rows = [(i < 300, i % 9 + 1) for i in range(400)]
    tokens = {s: sum(n for a, n in rows if a == (s == "a")) for s in "ab"}
    out = mixing.mix(shared(docs, "t"), entropy=0.95, max_repeats=4.0, budget=1.0, block_tokens=200)
    got = {r.source: (r.n, r.w) for r in out.groupBy("source").agg(F.sum("tokens").alias("n"), F.first("weight").alias("w")).collect()}
    total = sum(tokens.values())
    for s in "ab":
        target = min(math.floor(got[s][1] * total), 4 * tokens[s])
        assert target - 9 < got[s][0] <= target
    copies = out.groupBy("source", "copy", "place").count()
    assert copies.agg(F.max("count")).first()[0] == 1            # every row has a place of its own


def test_ten_thousand_sources(spark):
    import time
    totals = spark.range(10_000).select(F.col("id").cast("string").alias("key"), (F.pow(F.col("id") + 1, 1.5)).cast("long").alias("tokens"))
    began = time.time()
    rows = mixing.weights(totals, 0.995, 4.0, 1.0).collect()
    assert time.time() - began < 60
    tokens = np.array([r.tokens for r in rows], float)
    p = tokens / tokens.sum()

    def share(a):
        q = p ** a
        return q / q.sum()

    entropy = lambda q: -(q * np.log(q)).sum()
    low, high, goal = 0.0, 1.0, 0.995 * math.log(len(p))
    for _ in range(60):
        low, high = ((low + high) / 2, high) if entropy(share((low + high) / 2)) >= goal else (low, (low + high) / 2)
    a = low
    if (share(a) / p).max() > 4:
        high = 1.0
        for _ in range(60):
            low, high = ((low + high) / 2, high) if (share((low + high) / 2) / p).max() > 4 else (low, (low + high) / 2)
        a = high
    assert np.allclose([r.weight for r in rows], share(a), rtol=1e-9)


def _plain_language(model, text):
    """Features, average, linear scores and softmax of one text in plain loops."""
    ids, share = language.features(text)
    z = [0.0] * len(model.langs)
    for i, s in zip(ids.tolist(), share.tolist()):
        for k in range(len(z)):
            z[k] += s * model.scores[i][k]
    e = [math.exp(x / model.temperature - max(z) / model.temperature) for x in z]
    return {lang: x / sum(e) for lang, x in zip(model.langs, e)}


def _plain_sentences(model, text):
    """-log(1 - P) of a text: sentences, words and their prefixes in plain loops."""
    def weight(part, salt):
        codes = code_points(part)
        h = SpanHash(codes).of(np.array([0]), np.array([len(codes)]))[0] ^ np.uint64(salt)
        return model.weights[int(h >> np.uint64(64 - toxicity.BITS))]

    left = 0.0
    for sentence in re.split(r"[.!?\n]", text.lower()):
        words = "".join(c if c.isalpha() else " " for c in sentence).split()
        if words:
            z = model.bias + sum(weight(w, 1) + sum(weight(w[:k], 2) for k in toxicity.PREFIXES if len(w) > k) for w in words)
            left += math.log1p(math.exp(-abs(z))) + max(z, 0)
    return left


def test_language_scores_match_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    model = language.fit(docs)
    texts = [r.text for r in docs.limit(40).collect()] + ["", "漢字", "the", "Ä", "12 34", "la casa de la señora"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in language.identify(df, model).collect():
        if not any(c.isalpha() for c in texts[r.doc_id]):
            assert r.lang_pred == "und" and r.lang_score == 0
            continue
        want = _plain_language(model, texts[r.doc_id])
        assert r.lang_pred == "und" or abs(want[r.lang_pred] - r.lang_score) < 1e-6 and max(want.values()) - want[r.lang_pred] < 1e-6


def test_toxicity_scores_match_plain_loops(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    texts = [r.text for r in docs.limit(60).collect()] + ["", "one. two! three", "No end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in toxicity.score(df, model).collect():
        s = _plain_sentences(model, texts[r.doc_id])
        want = 0.0 if s <= 0 else 1 / (1 + math.exp(-(s + math.log(-math.expm1(-s)) + model.shift))) if s > 1e-12 else 0.0
        assert abs(r.score - want) < 1e-6


@pytest.mark.parametrize("block", [16, 40, 1000])
def test_a_sentence_over_a_cut_is_one(monkeypatch, block):
    rng = np.random.default_rng(4)
    model = toxicity.ToxicityModel(rng.normal(0, 0.4, 1 << toxicity.BITS), -1.0, 0.3)
    words = "the damn river \u0130stanbul x \u00c9t\u00e9 longerword 12".split()
    picks = random.Random(3)
    text = " ".join(picks.choice(words) + picks.choice([""] * 9 + [".", "!", "\n", " ."]) for _ in range(300))
    whole = model._strength([text])[0]
    spans = model._offending(text, 0.5)
    assert spans and 0 < whole
    monkeypatch.setattr(toxicity, "BLOCK", block)
    if len(text) > 2 * block:
        assert abs(sum(np.logaddexp(0, z) for _, _, z in model.long_sentences(text)) - whole) < 1e-6
    assert abs(model.score([text])[0] - model.calibrated(np.array([whole]))[0]) < 1e-9
    cut = model._offending(text, 0.5)
    assert [x[:2] for x in cut] == [x[:2] for x in spans] and np.allclose([x[2] for x in cut], [x[2] for x in spans])
    assert model._offending(" . \n" * block, 0.5) == [] and model.score([" . \n" * block])[0] == 0

"""Quality rules, source mixing and chat formatting against plain Python and numpy."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import chat, mixing, quality
from refinery.llm import queries as Q

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i:i + 5])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_counts_match_plain_python(spark):
    texts = [None, "", " \n\t", "a a a a a a", "a b c d e f a b c d e", "x\nx\n x\nx \n\n\nx", "é😀 #|| <b>\x0b\x0c\x1c y", "w " * 2000,
             "a b c d e a b c d e a b c d e z"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality.counts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])


def test_verdict_follows_the_labels(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in Q.op7_quality_rules(spark, "/root/testdata/sf0.1").collect() if r.doc_id in label]
    good = [r for r in rows if label[r.doc_id] == 1 and not r.base_failed]
    bad = [r for r in rows if label[r.doc_id] == 0 and not r.base_failed]
    assert np.mean([r.kept for r in good]) >= 0.995 and np.mean([r.kept for r in bad]) <= 0.2


def test_estimate_matches_numpy(spark):
    """The concentration steps against the same steps in numpy."""
    rng = np.random.default_rng(6)
    x = rng.multivariate_normal([1.5, 0.2, 0.3, 0.2, 0.2], np.diag([.04, .01, .02, .02, .01]) + .004, 800)
    x[:80] += [1, 2, 0, 2, 1]
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x] + [("small", *map(float, r)) for r in x[:20]],
                                 "group string, " + ", ".join(f"x{j} double" for j in range(5)))
    got = quality.estimate(rows, steps=3).collect()
    assert [r.group for r in got] == ["g"]
    b = np.floor(x * 200)
    quant = lambda q: np.array([(np.sort(b[:, j])[math.ceil(q * len(x)) - 1] + 0.5) / 200 for j in range(5)])
    m, s = quant(0.5), (quant(0.75) - quant(0.25)) / 1.349
    cov = np.diag(s * s + np.array(quality.SPREAD) ** 2)
    for _ in range(3):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        bins = np.floor(np.log1p(d) * 64)
        below = np.array([(bins < k).sum() for k in bins])
        near = x[below < 0.75 * len(x)]
        m = near.mean(axis=0)
        cov = np.cov(near.T, bias=True) * quality.CONSISTENCY + np.diag(np.array(quality.SPREAD) ** 2)
    assert np.allclose([got[0][f"m{j}"] for j in range(5)], m)
    w = np.array([[got[0][f"w{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
    assert np.allclose(w.T @ w, np.linalg.inv(cov))
    d = rows.where("group = 'g'").join(quality.estimate(rows, steps=3).drop("group")).select(quality._distance().alias("d"))
    d = np.array([r.d for r in d.collect()])
    assert (d > quality.CUT).sum() >= 70 and (np.sort(d)[:720] <= quality.CUT).all()


def test_rare_languages_are_judged_by_all_texts(spark):
    rng = __import__("random").Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(60))
    odd = " ".join(f"{chr(65 + i % 26)}#{'X' * 40}{i}|" for i in range(60))
    rows = [(i, text(), "en", "s") for i in range(200)] + [(1000, odd, "xx", "s"), (1001, text(), "xx", "s"), (1002, odd, None, None)]
    schema = "doc_id long, text string, lang string, source string"
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, schema)).collect()}
    assert all(r.distance is not None and not r.base_failed for r in got.values())
    assert not got[1000].kept and not got[1002].kept and got[1001].kept
    few = quality.judge(spark.createDataFrame(rows[:3], schema)).collect()       # no language has 50 texts
    assert all(r.distance is not None and r.kept for r in few)


def plain_weights(tokens, entropy, max_repeats, budget):
    total = sum(tokens.values())
    p = {s: t / total for s, t in tokens.items() if t}

    def at(a):
        q = {s: v ** a for s, v in p.items()}
        n = sum(q.values())
        return {s: v / n for s, v in q.items()}

    h = lambda q: -sum(v * math.log(v) for v in q.values())
    rep = lambda q: max(v * total * budget / tokens[s] for s, v in q.items())
    best = max((a for a in np.linspace(0, 1, 4001) if h(at(a)) >= entropy * math.log(len(p)) - 1e-9), default=0)
    if rep(at(best)) > max_repeats:
        best = min((a for a in np.linspace(best, 1, 4001) if rep(at(a)) <= max_repeats), default=1)
    return at(best)


@pytest.mark.parametrize("entropy,max_repeats,budget", [(0.9, 4, 1.0), (1.0, 50, 1.0), (1.0, 2, 1.0), (0.5, 4, 2.5), (0.9, 4, 0.3)])
def test_mix_meets_weights_and_budget(spark, entropy, max_repeats, budget):
    sizes = {"big": 600, "mid": 150, "small": 40, None: 10}
    rows = [(i, "w " * (i % 7 + 1), s) for s, n in sizes.items() for i in range(n)]
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)] + [(9000, None, "none"), (9001, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, entropy=entropy, max_repeats=max_repeats, budget=budget, block_tokens=100).collect()
    tokens, drawn, copies = defaultdict(int), defaultdict(int), defaultdict(lambda: defaultdict(int))
    for k, t, s in rows:
        tokens[s] += len((t or "").split())
    total = sum(tokens.values())
    want = plain_weights({s: t for s, t in tokens.items() if t}, entropy, max_repeats, budget)
    for r in out:
        drawn[r.source] += r.tokens
        copies[r.source][r.doc_id] += 1
        assert r.weight == pytest.approx(want[r.source], abs=2e-3) and 0 <= r.position < 1 + 1e-9
    for s, w in want.items():
        target = min(w * total * budget, tokens[s] * max_repeats)
        assert target - 8 - 0.003 * total * budget <= drawn[s] <= target + 0.003 * total * budget + 1
        seen = [copies[s].get(k, 0) for k, _, x in rows if x == s]
        assert max(seen) - min(seen) <= 1 and max(seen) <= math.ceil(max_repeats)
    assert None in drawn and "none" not in drawn


def test_unspaced_sources_count_by_their_bytes(spark):
    rows = [(i, "some plain words here " * 20, "spaced") for i in range(100)]
    rows += [(100 + i, "漢字" * 300, "unspaced") for i in range(100)] + [(300, " \n" * 500, "blank")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {r.doc_id: r.tokens for r in mixing.token_rows(docs).collect()}
    assert tokens[0] == 80 and tokens[100] == 225 and tokens[300] == 0
    out = mixing.mix(docs, entropy=0.5).collect()                   # the shares are kept: each document once
    assert sum(r.source == "unspaced" for r in out) in (99, 100) and sum(r.source == "spaced" for r in out) in (99, 100)
    exact = docs.selectExpr("*", "if(source = 'spaced', 7L, null) AS n")
    assert {r.source for r in mixing.mix(exact, token_col="n").collect()} == {"spaced"}


def test_mix_is_a_permutation_per_copy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = (Q.op9_source_mix(spark, SF).collect() for _ in range(2))
    assert sorted(one) == sorted(two)
    assert len({(r.doc_id, r.copy) for r in one}) == len(one) and {r.doc_id for r in one} <= {r.doc_id for r in docs.collect()}
    first = [r.doc_id for r in sorted(one, key=lambda r: r.position)]
    assert first != sorted(first)


def plain_maximal(convs):
    def key(turns):
        return [(r, t) for _, r, t in sorted(turns, key=lambda x: ((x[0] is not None, x[0] or 0), (x[1] is not None, x[1] or ""),
                                                                    (x[2] is not None, x[2] or "")))]
    seqs = {c: key(t) for c, t in convs.items()}
    return {c for c, s in seqs.items()
            if not any(len(o) > len(s) and o[:len(s)] == s or o == s and d < c for d, o in seqs.items() if d != c)}


def test_chats_match_plain_python(spark):
    rng = __import__("random").Random(3)
    convs, rows = {}, []
    for c in range(120):
        n = rng.randint(1, 6)
        turns = [(i * rng.choice([1, 1, 2]) if c % 3 else i, rng.choice(["user", None]) if i % 2 == 0 else "assistant",
                  rng.choice(["hi", "", None, "a<|im_end|>"])) for i in range(n)]
        convs[c] = turns
    convs[200] = [(i, "user", "same") for i in range(50)]
    convs[201] = convs[200][:49]
    for c, turns in convs.items():
        rows += [(c, *t) for t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (4, 1024):             # long conversations in blocks give the same
        out = chat.format_chats(df, block).collect()
        assert {r.conv_id for r in out} == plain_maximal(convs)
        whole = "".join(r.text for r in sorted(out, key=lambda r: r.part) if r.conv_id == 200)
        assert whole == "<|im_start|>user\nsame<|im_end|>\n" * 50
        assert max(r.part for r in out if r.conv_id == 200) == (12 if block == 4 else 0)


def test_a_conversation_of_few_turn_numbers_is_spread(spark):
    """Rows without conv_id on turns 0..10, many of them equal: no block or range holds them all."""
    rows = [(None, i % 11, "user", "same" if i % 2 else f"t{i % 97:02}") for i in range(2000)] + [(i, 0, "user", "hi") for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = chat.numbered(df, 16).collect()
    lost = sorted((r for r in got if r.conv_id is None), key=lambda r: r.pos)
    assert [r.pos for r in lost] == list(range(1, 2001)) and {r.len for r in lost} == {2000}
    assert [r.text for r in lost] == [t for _, _, _, t in sorted(rows[:2000], key=lambda x: x[1:])]
    assert all(r.block == (r.pos - 1) // 16 for r in got) and len(got) == len(rows)
    out = [r for r in chat.format_chats(df, 16).collect() if r.conv_id is None]
    assert len(out) == 125 and "".join(r.text for r in sorted(out, key=lambda r: r.part)) == "".join(
        f"<|im_start|>user\n{r.text}<|im_end|>\n" for r in lost)


def test_no_cross_join_in_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.token_rows(docs).groupBy("key").agg(F.sum("tokens").alias("tokens"))
    plan = mixing.weights(rows, 0.9, 4.0, 1.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

"""Collocations and their automata against plain Python counts."""

import random
import re
from collections import Counter, defaultdict

import pytest

from refinery.llm import automata, phrases


def plain_grams(rows):
    """{(lang, word, ...): count} of up to four words; (lang,) has the number of words."""
    out = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            out[(lang,)] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    out[(lang, *words[i:i + k])] += 1
    return +out


def plain_collocations(rows, least, top, longer=80):
    f = plain_grams(rows)
    cands = {g: n for g, n in f.items() if len(g) > 2 and n >= least}
    inside = defaultdict(int)
    for g, n in cands.items():
        for size in range(2, len(g) - 1):
            for i in range(1, len(g) - size + 1):
                key = (g[0], *g[i:i + size])
                inside[key] = max(inside[key], n)
    out = defaultdict(list)
    for g, a in cands.items():
        if inside[g] and 100 * inside[g] >= longer * a:
            continue
        cuts = [(2_000_000 * a // (f[g[:k + 1]] + f[(g[0], *g[k + 1:])]), k) for k in range(1, len(g) - 1)]
        score, k = min(cuts)
        out[g[0]].append((-score, -a, " ".join(g[1:]).encode(), f[g[:k + 1]], f[(g[0], *g[k + 1:])]))
    return sorted((lang, rank, p.decode(), -a, left, right, f[(lang,)], -score) for lang, found in out.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def _texts(seed, n):
    rng = random.Random(seed)
    words = "a B c d é E漢 of the The river x".split(" ") + ["deep water", "new york city", "x"]
    return [("".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t", "  ", ". ", "\n", "!", "\x0b", ",", " "])
                     for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und"])) for _ in range(n)]


def _counted(rows, ranges, limit):
    shard, pieces = phrases.Shard(ranges, limit), defaultdict(list)
    for text, lang in rows:
        for place, piece in shard.add(text or "", lang or "und"):
            pieces[place].append(piece)
    for place, piece in shard.flush():
        pieces[place].append(piece)
    return pieces


def _paths(counts):
    known = counts.words.to_pylist()
    paths = [[(counts.langs[s],) for s in counts.levels[0].symbol]]
    for level in counts.levels[1:]:
        paths.append([paths[-1][p] + (known[s].decode(),) for s, p in zip(level.symbol, level.parent)])
    return {p: int(w) for k, level in enumerate(counts.levels) for p, w in zip(paths[k], level.weight) if w}


@pytest.mark.parametrize("limit", [40, 700, 10 ** 6])
def test_shards_and_ranges_count_every_gram_once(limit):
    rows = _texts(limit, 80)
    got = Counter()
    for place, pieces in _counted(rows, 5, limit).items():
        union = phrases.Union()
        for piece in pieces:
            union.add(automata.unfold(automata.from_bytes(piece)))
        found = _paths(union.result())
        assert not set(found) & set(got)
        assert all(phrases._place(g[0], [w.encode() for w in g[1:]], 5) == place for g in found)
        got.update(found)
    assert got == plain_grams(rows)


def test_automata_are_minimal_and_come_back():
    rows = [(" ".join(f"{a} {b} end stop." for a in "uvw" for b in "xyz"), "en")]
    union = phrases.Union()
    for pieces in _counted(rows, 1, 10 ** 6).values():
        for piece in pieces:
            union.add(automata.unfold(automata.from_bytes(piece)))
    counts = union.result()
    machine = automata.freeze(counts)
    assert _paths(automata.unfold(machine)) == _paths(counts)
    # the nine "a b" states have one successor state: "end" then "stop"
    states = [len(a.start) - 1 for a in machine.arcs]
    assert states[0] == 1 and sum(len(a.symbol) for a in machine.arcs) < counts.size
    for arcs in machine.arcs:               # no two states are equal
        seen = {tuple(map(tuple, zip(arcs.symbol[i:j], arcs.weight[i:j], arcs.target[i:j])))
                for i, j in zip(arcs.start, arcs.start[1:])}
        assert len(seen) == len(arcs.start) - 1


def test_composition_looks_up_parts():
    rows = _texts(9, 40)
    f = plain_grams(rows)
    union = phrases.Union()
    for pieces in _counted(rows, 3, 300).values():
        for piece in pieces:
            union.add(automata.unfold(automata.from_bytes(piece)))
    machine = automata.freeze(union.result())
    wanted = [g for g in f if len(g) > 1] + [("en", "nowhere"), ("xx", "a"), ("en", "a", "nowhere", "a")]
    accepted, places = automata.acceptor([(g[0], [w.encode() for w in g[1:]]) for g in wanted])
    weights = automata.compose(accepted, machine)
    assert [int(weights[len(g) - 1][places[len(g) - 1][i]]) for i, g in enumerate(wanted)] == [f.get(g, 0) for g in wanted]
    kept = automata.at_least(union.result(), 5)
    assert {g: n for g, n in _paths(kept).items() if len(g) > 1} .items() >= {
        g: n for g, n in f.items() if n >= 5 and len(g) > 1}.items()


def test_a_long_text_is_cut_between_words():
    text = ("Ab\tcd, " + "e" * 50 + " f.ég " * 20) * 5
    whole = [t for t in next(iter([sum(phrases.tokens(text, 1 << 20), [])])) if t]
    for step in (1, 7, 64):
        assert [t for t in sum(phrases.tokens(text, step), []) if t] == whole


@pytest.mark.parametrize("least, top", [(3, 1000), (8, 5)])
def test_collocations_match_plain_python(spark, least, top):
    rows = _texts(least, 150) + [(None, "en"), ("", None), ("same words here again. " * 30, "en")] + [("copy of a text", "de")] * 20
    df = spark.createDataFrame([(*r, "x") for r in rows], "text string, lang string, phrase string").repartition(6)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=least, top=top).collect())
    assert got == plain_collocations(rows, least, top) and got
    assert len({r[0] for r in got}) == 3


def test_products_over_64_bits(spark):
    """The score's product is taken in decimals."""
    from pyspark.sql import functions as F
    a = 9_000_000_000_000
    got = spark.range(1).select(F.expr(f"cast(2000000 as decimal(10,0)) * cast({a}L as decimal(19,0)) div "
                                       f"(cast({a}L as decimal(19,0)) + cast({2 * a}L as decimal(19,0)))").alias("s")).first().s
    assert got == 2_000_000 * a // (3 * a)

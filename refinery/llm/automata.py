"""Count transducers: weighted acyclic automata over sorted word n-grams.

A path is a language followed by up to ``MAX_WORDS`` words; the weight of its last arc
is the count of that n-gram (the first arc's weight is the number of words of the
language; 0 = not counted here).  ``Counts`` holds the sorted n-grams with shared
prefixes, level by level.  ``freeze`` turns them into a minimal automaton: because
the n-grams are sorted, all arcs of a state are known once its prefix is left, so
states are frozen from the deepest level up and each is looked up in a register of the
states already there (equal arcs, weights and targets are one state).  ``union`` adds
the weights of several automata, ``compose`` runs an acceptor of phrases through one.

All work is on whole levels as numpy arrays.  Symbols are numbered per automaton, so
automata of different shards are matched by their words.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import mix

MAX_WORDS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Level(NamedTuple):
    """Arcs of one depth in sorted order: symbol, weight, index of the arc before."""

    symbol: np.ndarray
    weight: np.ndarray
    parent: np.ndarray


class Counts(NamedTuple):
    """Sorted n-grams: ``levels[0]`` languages, ``levels[k]`` the k-th words (numbers in
    ``langs`` and in the binary array ``words``)."""

    langs: list[str]
    words: pa.Array
    levels: list[Level]

    @property
    def size(self) -> int:
        return sum(len(level.symbol) for level in self.levels)


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the order that sorts, where each key starts in it."""
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[starts], order, starts


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: np.unique hashes, which is slower here)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def count(langs: list[str], words: list[bytes], lang: np.ndarray, token: np.ndarray, until: int) -> Counts:
    """N-grams of a token stream that begin before position ``until``.  ``token`` is
    -1 where a piece ends, ``lang`` the language of each token."""
    width, words = max(len(words), 1), pa.array(words, pa.binary())
    at = np.flatnonzero(token[:until] >= 0)
    node = np.zeros(len(at), np.int64)
    levels = []
    for k in range(MAX_WORDS + 1):
        if k:
            there = at + k - 1 < len(token)
            at, node = at[there], node[there]
            symbol = token[at + k - 1]
            inside = symbol >= 0
            at, key = at[inside], node[inside] * width + symbol[inside]
        else:
            key = lang[at].astype(np.int64)
        key, order, starts = _grouped(key)
        weight = np.diff(np.r_[starts, len(order)])
        levels.append(Level(key % width, weight, key // width) if k else Level(key, weight, np.zeros(len(key), np.int64)))
        node = np.empty(len(order), np.int64)
        node[order] = np.repeat(np.arange(len(starts)), weight)
    return Counts(langs, words, levels)


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], dtype=np.uint64)


def prefix_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a prefix one symbol longer."""
    return mix(before * _ODD + word)


def prefix_ranges(counts: Counts, ranges: int) -> list[np.ndarray]:
    """The range of every n-gram: that of its prefix of a language and at most three
    words, so the extensions of a very common word or pair are spread."""
    lang, word = word_hashes([x.encode() for x in counts.langs]), word_hashes(counts.words.to_pylist())
    h = prefix_hash(np.zeros(len(counts.levels[0].symbol), np.uint64), lang[counts.levels[0].symbol])
    out = [h]
    for k, level in enumerate(counts.levels[1:], 1):
        h = prefix_hash(h[level.parent], word[level.symbol]) if k < MAX_WORDS else h[level.parent]
        out.append(h)
    return [(h % np.uint64(ranges)).astype(np.int64) for h in out]


def split(counts: Counts, ranges: int) -> Iterator[tuple[int, Counts]]:
    """``counts`` by prefix range.  Arcs that only lead to a range's n-grams have
    weight 0 in it."""
    own = prefix_ranges(counts, ranges)
    sizes = [max(len(level.symbol), 1) for level in counts.levels]
    # per level the sorted (range, node) pairs: a range's own nodes and the way to those below
    keys, below = [], np.zeros(0, np.int64)
    for k in range(MAX_WORDS, -1, -1):
        n, place = sizes[k], own[k]
        key = _distinct(np.concatenate([place * n + np.arange(len(place)), below]))
        keys.append(key)
        below = key // n * (sizes[k - 1] if k else 1) + counts.levels[k].parent[key % n] if len(key) else key
    keys.reverse()
    levels, bounds, above = [], [], np.arange(ranges)
    for level, place, key, n in zip(counts.levels, own, keys, sizes):
        node = key % n
        weight = np.where(key // n == place[node], level.weight[node], 0) if len(key) else key
        before = key // n * (1 if not levels else sizes[len(levels) - 1]) + level.parent[node] if len(key) else key
        levels.append((level.symbol[node] if len(key) else key, weight, np.searchsorted(above, before)))
        bounds.append(np.searchsorted(key, np.arange(ranges + 1) * n))
        above = key
    for r in range(ranges):
        out, first = [], r
        for (symbol, weight, parent), bound in zip(levels, bounds):
            part = slice(bound[r], bound[r + 1])
            out.append(Level(symbol[part], weight[part], parent[part] - first))
            first = bound[r]
        if len(out[0].symbol):
            yield r, _tight(Counts(counts.langs, counts.words, out))


def _tight(counts: Counts) -> Counts:
    """Only the symbols that are used; their order stays."""
    used = [np.zeros(len(counts.langs), bool), np.zeros(len(counts.words), bool)]
    for k, level in enumerate(counts.levels):
        used[min(k, 1)][level.symbol] = True
    number = [np.cumsum(u) - 1 for u in used]
    levels = [level._replace(symbol=number[min(k, 1)][level.symbol]) for k, level in enumerate(counts.levels)]
    return Counts([x for x, u in zip(counts.langs, used[0]) if u], counts.words.filter(pa.array(used[1])), levels)


def union(parts: list[Counts]) -> Counts:
    """N-grams of all parts with their weights added."""
    langs: dict[str, int] = {}
    lang_of = [np.array([langs.setdefault(x, len(langs)) for x in p.langs], dtype=np.int64) for p in parts]
    coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    words = coded.dictionary
    word_of = np.split(coded.indices.to_numpy().astype(np.int64), np.cumsum([len(p.words) for p in parts])[:-1])
    levels, places = [], [np.zeros(1, np.int64) for _ in parts]
    for k in range(MAX_WORDS + 1):
        width = max(len(words) if k else len(langs), 1)
        keys = [place[p.levels[k].parent] * width + (names[p.levels[k].symbol] if len(p.levels[k].symbol) else 0)
                for p, place, names in zip(parts, places, word_of if k else lang_of)]
        key, order, starts = _grouped(np.concatenate(keys))
        weight = np.concatenate([p.levels[k].weight for p in parts]).astype(np.int64)[order]
        weight = np.add.reduceat(weight, starts) if len(starts) else weight
        levels.append(Level(key % width, weight, key // width))
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
        places = np.split(at, np.cumsum([len(x) for x in keys])[:-1])
    return Counts(list(langs), words, levels)


def at_least(counts: Counts, least: int) -> Counts:
    """The n-grams of weight ``least`` or more (of languages: 1) and the way to them."""
    levels, kept = [], []
    for k in range(MAX_WORDS, -1, -1):
        level = counts.levels[k]
        keep = level.weight >= (least if k else 1)
        if k < MAX_WORDS:
            below = counts.levels[k + 1]
            needed = np.zeros(len(keep), bool)
            needed[below.parent[kept[-1]]] = True
            keep |= needed
        kept.append(keep)
    kept.reverse()
    number = np.zeros(1, np.int64)
    for level, keep in zip(counts.levels, kept):
        weight = level.weight[keep]
        levels.append(Level(level.symbol[keep], weight, number[level.parent[keep]]))
        number = np.cumsum(keep) - 1
    return _tight(Counts(counts.langs, counts.words, levels))


class Arcs(NamedTuple):
    """Arcs of all states of one depth: state by state, symbols ascending."""

    start: np.ndarray
    symbol: np.ndarray
    weight: np.ndarray
    target: np.ndarray


class Transducer(NamedTuple):
    langs: list[str]
    words: pa.Array
    arcs: list[Arcs]


def _spread(start: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All arcs of ``states`` one after the other, and the position of their state."""
    sizes = start[states + 1] - start[states]
    owner = np.repeat(np.arange(len(states)), sizes)
    return np.repeat(start[states] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(owner)), owner


def _register(states: int, level: Level, target: np.ndarray) -> tuple[np.ndarray, Arcs]:
    """One state for all those with equal arcs: the state of each prefix, and the arcs."""
    sizes = np.bincount(level.parent, minlength=states)
    start = np.r_[0, np.cumsum(sizes)]
    signature = mix(sizes.astype(np.uint64))
    full = np.flatnonzero(sizes)
    if len(full):
        h = mix(mix(mix(target.astype(np.uint64)) + level.weight.astype(np.uint64)) + level.symbol.astype(np.uint64))
        signature[full] += np.add.reduceat(h, start[full])
    # the first of the states of one signature stands for all
    _, order, groups = _grouped(signature)
    model = np.empty(states, np.int64)
    model[order] = np.repeat(np.minimum.reduceat(order, groups) if states else order, np.diff(np.r_[groups, states]))
    # equal signatures are compared arc by arc, so the register is exact
    other = sizes != sizes[model]
    arc = np.minimum(start[model[level.parent]] + np.arange(len(level.symbol)) - start[level.parent], len(level.symbol) - 1)
    differs = ((level.symbol != level.symbol[arc]) | (level.weight != level.weight[arc]) | (target != target[arc])
               if len(arc) else np.zeros(0, bool))
    other[level.parent[differs]] = True
    model[other] = np.flatnonzero(other)
    kept = np.flatnonzero(model == np.arange(states))
    take, owner = _spread(start, kept)
    number = np.cumsum(model == np.arange(states)) - 1
    return number[model], Arcs(np.r_[0, np.cumsum(sizes[kept])], level.symbol[take], level.weight[take], target[take])


def freeze(counts: Counts) -> Transducer:
    """The minimal automaton of sorted n-grams."""
    arcs, target = [], np.zeros(len(counts.levels[-1].symbol), np.int64)
    for k in range(MAX_WORDS, -1, -1):
        states = len(counts.levels[k - 1].symbol) if k else 1
        state, kept = _register(states, counts.levels[k], target)
        arcs.append(kept)
        target = state
    return Transducer(counts.langs, counts.words, arcs[::-1])


def unfold(machine: Transducer) -> Counts:
    """The sorted n-grams of an automaton."""
    levels, states = [], np.zeros(1, np.int64)
    for arcs in machine.arcs:
        take, owner = _spread(arcs.start, states)
        levels.append(Level(arcs.symbol[take], arcs.weight[take], owner))
        states = arcs.target[take]
    return Counts(machine.langs, machine.words, levels)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def to_bytes(machine: Transducer) -> bytes:
    words = machine.words.cast(pa.binary())
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    data = bytes(words.buffers()[2])[ends[0]:ends[-1]] if len(words) and words.buffers()[2] else b""
    arrays = [_narrow(np.diff(ends)), *(_narrow(a) for arcs in machine.arcs for a in (np.diff(arcs.start), *arcs[1:]))]
    head = json.dumps({"langs": machine.langs, "arrays": [[a.dtype.str, len(a)] for a in arrays]}).encode()
    raw = struct.pack("<qq", len(head), len(data)) + head + data + b"".join(a.tobytes() for a in arrays)
    return struct.pack("<q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def from_bytes(packed: bytes) -> Transducer:
    raw = pa.decompress(packed[8:], decompressed_size=struct.unpack("<q", packed[:8])[0], codec="zstd", asbytes=True)
    head_size, size = struct.unpack("<qq", raw[:16])
    head = json.loads(raw[16:16 + head_size])
    at = 16 + head_size
    data = raw[at:at + size]
    at += size
    arrays = []
    for kind, n in head["arrays"]:
        a = np.frombuffer(raw, dtype=kind, count=n, offset=at)
        at += a.nbytes
        arrays.append(a.astype(np.int64))
    ends = np.r_[0, np.cumsum(arrays[0])].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
    arcs = [Arcs(np.r_[0, np.cumsum(arrays[i])], *arrays[i + 1:i + 4]) for i in range(1, len(arrays), 4)]
    return Transducer(head["langs"], words, arcs)


def acceptor(phrases: list[tuple[str, list[bytes]]]) -> tuple[Counts, list[np.ndarray]]:
    """Sorted phrases with shared prefixes (weights 0), and for each level the place of
    every phrase's prefix in it (-1 where the phrase is shorter)."""
    langs: dict[str, int] = {}
    words: dict[bytes, int] = {}
    symbol = np.full((len(phrases), MAX_WORDS + 1), -1, np.int64)
    for i, (lang, parts) in enumerate(phrases):
        symbol[i, 0] = langs.setdefault(lang, len(langs))
        for k, word in enumerate(parts, 1):
            symbol[i, k] = words.setdefault(word, len(words))
    levels, places, node = [], [], np.zeros(len(phrases), np.int64)
    for k in range(MAX_WORDS + 1):
        width = max(len(words) if k else len(langs), 1)
        there = np.flatnonzero(symbol[:, k] >= 0)
        key, inverse = np.unique(node[there] * width + symbol[there, k], return_inverse=True)
        levels.append(Level(key % width, np.zeros(len(key), np.int64), key // width))
        place = np.full(len(phrases), -1, np.int64)
        place[there] = inverse
        places.append(place)
        node = place
    return Counts(list(langs), pa.array(list(words), pa.binary()), levels), places


def compose(phrases: Counts, machine: Transducer) -> list[np.ndarray]:
    """The weights that ``machine`` gives to every arc of an acceptor (0: no such path).

    A state of the composition is a pair of a prefix of the phrases and a state of the
    machine; level by level, arcs of equal symbols meet."""
    names = [{x: i for i, x in enumerate(machine.langs)}, machine.words]
    own = [np.array([names[0].get(x, -1) for x in phrases.langs], dtype=np.int64),
           pc.fill_null(pc.index_in(phrases.words, machine.words), -1).to_numpy().astype(np.int64)]
    out, state = [], np.zeros(1, np.int64)
    for k, (level, arcs) in enumerate(zip(phrases.levels, machine.arcs)):
        width = max(len(names[min(k, 1)]), 1)
        symbol = own[min(k, 1)][level.symbol] if len(level.symbol) else level.symbol
        before = state[level.parent]
        # arcs are sorted by state and symbol
        known = np.repeat(np.arange(len(arcs.start) - 1), np.diff(arcs.start)) * width + arcs.symbol
        wanted = before * width + symbol
        at = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
        met = (before >= 0) & (symbol >= 0) & (len(known) > 0)
        met &= (known[at] == wanted) if len(known) else False
        out.append(np.where(met, arcs.weight[at] if len(known) else 0, 0))
        state = np.where(met, arcs.target[at] if len(known) else 0, -1)
    return out

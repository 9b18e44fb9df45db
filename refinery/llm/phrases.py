"""Phrase collocations, counted by weighted acyclic automata (``automata``).

1. Shards: a task turns its texts into word streams and every ``SHARD`` words into
   sorted n-grams of up to four words.  These are split by prefix range, and each part
   is frozen to a count transducer, the only thing that is shuffled.
2. Ranges: a range's transducers are united and their weights summed.  Only n-grams of
   at least ``least`` occurrences can matter (a phrase's parts occur as often as the
   phrase at least), so the others go; what is left is a transducer again.
3. Parts: every candidate's first parts and rests are sent to their prefix ranges and
   composed with the range's transducer, which gives their counts.
4. Scores, the filter by longer candidates and the ranks are DataFrame functions, in
   decimals where a product could pass 64 bits.

An n-gram's range is that of its first three words, so the extensions of a very
common word or pair are spread over all ranges; a shard sends one arc for an n-gram,
however often it occurs.  The number of ranges grows with the characters of the
corpus, so a range stays small.  A text of any length is read in steps of ``STEP``
bytes, and a shard may end inside a text: it keeps the n-grams that begin in it, and
the next one starts with its last three words.

Edge cases: a null text counts as empty, a null language as ``und``; repeated rows count
as often as they are there; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import automata
from .automata import MAX_WORDS, Counts
from .common import shared, slices

SHARD = 1_500_000
STEP = 1 << 20
#: about so many characters make a prefix range
RANGE_CHARS = 8 << 20
#: n-grams that are held before they are united
HELD = 1 << 20
PARTS = 64
# A-Z go to lower case with bytes.lower; blanks split words, the other marks split pieces.
_MARKS = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" " + b"\n" * 10)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, key: bytes) -> int:
        value = self[key] = len(self)
        return value


def _numbers() -> _Numbers:
    out = _Numbers()
    out[b""], out[b"\n"] = 0, 1         # nothing between two blanks; the end of a piece
    return out


def tokens(text: str, step: int = STEP) -> Iterator[list[bytes]]:
    """Words of a text, ``b"\\n"`` where a piece ends and ``b""`` between blanks."""
    raw = text.encode("utf-8", "surrogatepass")
    carry = b""
    for at in range(0, len(raw), step):
        found = (carry + raw[at:at + step].lower().translate(_MARKS).replace(b"\n", b" \n ")).split(b" ")
        carry = found.pop()
        yield found
    yield [carry, b"\n"]


class Shard:
    """The word stream of a shard."""

    def __init__(self, ranges: int, limit: int = SHARD):
        self.ranges, self.limit = ranges, limit
        self.langs: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.parts, self.lang, self.size = _numbers(), [], [], 0

    def add(self, text: str, lang: str) -> Iterator[tuple[int, bytes]]:
        code = self.langs.setdefault(lang, len(self.langs))
        for words in tokens(text):
            ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            ids = ids[ids > 0]
            self.parts.append(ids)
            self.lang.append((code, len(ids)))
            self.size += len(ids)
            if self.size >= self.limit:
                yield from self.flush(MAX_WORDS - 1)

    def flush(self, keep: int = 0) -> Iterator[tuple[int, bytes]]:
        """(range, transducer) of the n-grams that begin before the last ``keep`` tokens,
        which stay as the beginning of the next shard."""
        if not self.size:
            return
        token = np.concatenate(self.parts) - 2
        lang = np.repeat([c for c, _ in self.lang], [n for _, n in self.lang])
        words = list(self.numbers)
        until = max(len(token) - keep, 0)
        counted = automata.count(list(self.langs), words[2:], lang, token, until)
        last = [words[i + 2] for i in token[until:]], lang[until:].tolist()
        self._clear()
        if last[0]:
            self.parts = [np.fromiter(map(self.numbers.__getitem__, last[0]), np.int64, len(last[0]))]
            self.lang = [(code, 1) for code in last[1]]
            self.size = len(last[0])
        for place, part in automata.split(counted, self.ranges):
            yield place, automata.to_bytes(automata.freeze(part))


def _shards(ranges: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(ranges)

        def rows(found: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            for place, piece in found:
                yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int32()),
                                                  "piece": pa.array([piece], pa.binary())})

        for batch in slices(batches, 100):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                yield from rows(shard.add(text or "", lang))
        yield from rows(shard.flush())
    return run


class Union:
    """Automata of one range, united whenever as much is waiting as is there."""

    def __init__(self):
        self.done: Counts | None = None
        self.waiting: list[Counts] = []
        self.size = 0

    def add(self, part: Counts) -> None:
        self.waiting.append(part)
        self.size += part.size
        if self.size >= max(HELD, self.done.size if self.done else 0):
            self.result()

    def result(self) -> Counts:
        if self.waiting:
            self.done = automata.union(([self.done] if self.done else []) + self.waiting)
            self.waiting, self.size = [], 0
        return self.done


def phrases_of(counts: Counts) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, words, weight) of every phrase of two words or more that is counted in
    ``counts``."""
    known = counts.words.to_pylist()
    paths = [[(counts.langs[s], []) for s in counts.levels[0].symbol.tolist()]]
    for level in counts.levels[1:]:
        before = paths[-1]
        paths.append([(before[p][0], before[p][1] + [known[s]])
                      for s, p in zip(level.symbol.tolist(), level.parent.tolist())])
    for k in range(2, MAX_WORDS + 1):
        for (lang, words), weight in zip(paths[k], counts.levels[k].weight.tolist()):
            if weight:
                yield lang, words, weight


_RANGE_ROW = {"kind": pa.int32(), "place": pa.int32(), "lang": pa.string(), "phrase": pa.string(), "n_words": pa.int32(),
              "a": pa.int64(), "cut": pa.int32(), "first": pa.bool_(), "part": pa.string(), "piece": pa.binary()}
RANGE_SCHEMA = ("kind int, place int, lang string, phrase string, n_words int, a long, cut int, first boolean, "
                "part string, piece binary")
PIECE, PART, PHRASE, TOTAL = range(4)


def _text(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


_ALL = (1 << 64) - 1


@lru_cache(maxsize=1 << 16)
def _next_hash(before: int, word: bytes) -> int:
    """``automata.prefix_hash`` of one prefix, in plain numbers."""
    x = (before * int(automata._ODD) + zlib.crc32(word)) & _ALL
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _ALL
    return x ^ (x >> 31)


def _place(lang: str, words: list[bytes], ranges: int) -> int:
    """The prefix range of one n-gram, as ``automata.prefix_ranges`` has it."""
    h = _next_hash(0, lang.encode())
    for word in words[:MAX_WORDS - 1]:
        h = _next_hash(h, word)
    return h % ranges


def _range_rows(place: int, counts: Counts, ranges: int, least: int) -> Iterator[dict]:
    kept = automata.at_least(counts, least)
    for symbol, n in zip(kept.levels[0].symbol.tolist(), kept.levels[0].weight.tolist()):
        if n:
            yield {"kind": TOTAL, "lang": kept.langs[symbol], "a": n}
    for lang, words, a in phrases_of(kept):
        phrase = _text(words)
        yield {"kind": PHRASE, "lang": lang, "phrase": phrase, "n_words": len(words), "a": a}
        for cut in range(1, len(words)):
            for first, part in ((True, words[:cut]), (False, words[cut:])):
                yield {"kind": PART, "place": _place(lang, part, ranges), "lang": lang, "phrase": phrase, "a": a,
                       "cut": cut, "first": first, "part": _text(part)}
    yield {"kind": PIECE, "place": place, "piece": automata.to_bytes(automata.freeze(kept))}


def _batched(rows: Iterable[dict], size: int = 4000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r.get(n) for r in rows], t) for n, t in _RANGE_ROW.items()})


def _unite(ranges: int, least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            here, found = None, Union()
            for batch in slices(batches, 1):
                place = batch.column("place")[0].as_py()
                if place != here:
                    if here is not None:
                        yield from _range_rows(here, found.result(), ranges, least)
                    here, found = place, Union()
                found.add(automata.unfold(automata.from_bytes(batch.column("piece")[0].as_py())))
            if here is not None:
                yield from _range_rows(here, found.result(), ranges, least)
        yield from _batched(rows())
    return run


def _look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts by range, each range's transducer before its parts."""
    here = machine = None
    for batch in batches:
        kind, place = batch.column("kind").to_numpy(), batch.column("place").to_numpy()
        for start, end in _stretches(place):
            if place[start] != here:
                here, machine = place[start], None
            if kind[start] == PIECE:
                machine = automata.from_bytes(batch.column("piece")[start].as_py())
                start += 1
            part = batch.slice(start, end - start)
            if not part.num_rows:
                continue
            wanted = [(lang, text.encode("utf-8", "surrogatepass").split(b" "))
                      for lang, text in zip(part.column("lang").to_pylist(), part.column("part").to_pylist())]
            phrases, places = automata.acceptor(wanted)
            n = np.zeros(len(wanted), np.int64)
            if machine is not None:
                weights = automata.compose(phrases, machine)
                for i, (_, words) in enumerate(wanted):
                    n[i] = weights[len(words)][places[len(words)][i]]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("lang", "phrase", "a", "cut", "first")), pa.array(n)],
                names=["lang", "phrase", "a", "cut", "first", "n"])


def _stretches(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(x[1:] != x[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(x)]) if len(x) else iter(())


def collocations(docs: DataFrame, *, least: int = 30, factor: int = 2_000_000, longer: int = 80,
                 top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to
    four words with ``a >= least``.  A cut into two parts of counts l and r scores
    ``floor(factor * a / (l + r))``; a phrase has its lowest cut (ties: the shortest first
    part).  Phrases inside a longer candidate with ``100 * a(longer) >= longer * a`` go."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // RANGE_CHARS))
    pieces = docs.mapInArrow(_shards(ranges), "place int, piece binary")
    united = (pieces.repartition(ranges, "place").sortWithinPartitions("place")
              .mapInArrow(_unite(ranges, least), RANGE_SCHEMA))
    rows = shared(united, "phrases")
    asked = rows.where(F.col("kind").isin(PIECE, PART)).repartition(ranges, "place").sortWithinPartitions("place", "kind")
    parts = asked.mapInArrow(_look_up, "lang string, phrase string, a long, cut int, first boolean, n long")

    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = parts.groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("first"), F.col("n"))).alias("l"), F.max(F.when(~F.col("first"), F.col("n"))).alias("r"))
    score = F.expr(f"cast({factor} as decimal(10,0)) * cast(a as decimal(19,0)) div "
                   "(cast(l as decimal(19,0)) + cast(r as decimal(19,0)))").cast("long")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))

    words = F.split("phrase", " ", -1)
    inner = F.expr(
        "flatten(transform(sequence(2, n_words - 1), size -> transform(sequence(1, n_words - size + 1), "
        "at -> array_join(slice(split(phrase, ' ', -1), at, size), ' '))))")
    holders = (rows.where((F.col("kind") == PHRASE) & (F.size(words) > 2))
               .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("holder"))
               .groupBy("lang", "phrase").agg(F.max("holder").alias("holder")))
    held = F.coalesce(wide("holder") * 100 >= wide("a") * longer, F.lit(False))
    kept = scored.join(holders, ["lang", "phrase"], "left").where(~held)
    order = [F.desc("low.score"), F.desc("a"), F.col("phrase")]
    # first within PARTS parts of a language, so that one task ranks at most PARTS * top rows of it
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = kept.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = rows.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("a").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "low.l", "low.r", "n", "low.score")


#: DuckDB, for the registered query's parameters
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM d),
g AS (SELECT lang, unnest(range(1, len(words) + 1)) AS i, words FROM p),
f AS (SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k, count(*) AS a
      FROM g, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(words) GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.a AS l, r.a AS r,
        (2000000::HUGEINT * cuts.a // (l.a + r.a))::BIGINT AS score
      FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(words[1:cut], ' ')
      JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, max(a) AS holder
      FROM c, (SELECT unnest([2, 3]) AS size), (SELECT unnest([1, 2, 3]) AS i)
      WHERE size < k AND i + size - 1 <= k GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low LEFT JOIN inside USING (lang, phrase) JOIN n USING (lang)
WHERE holder IS NULL OR 100::HUGEINT * holder < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

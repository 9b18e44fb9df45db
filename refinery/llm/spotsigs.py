"""SpotSigs fingerprints: spots of content words that follow common words.

A *spot* starts at an anchor (a common word) and holds the next ``chain`` content
words after it; common words in between are passed over.  A text's signature is
the set of its spots, as 64-bit hashes.  Navigation and boilerplate hold few
common words, so spots come from running prose.  The anchors are a fixed list,
so that fingerprints of different runs compare.

Likeness is the Jaccard similarity of two signatures.  Since it can't exceed
min/max of the set sizes, sizes are cut into partitions in which neighbouring
sizes of likeness tau meet in one or two adjacent partitions, and a comparison
stops as soon as its bound falls below tau (``pruned_jaccard``, which merges
``STEP`` elements between looks at the bound).
``near_duplicates`` is the search over all documents: equal signatures collapse,
each signature lists its rarest spots (enough that two signatures of likeness
tau share one) under its own and the next size partition, and pairs that meet in
a list are compared once, by ``pruned_jaccard``.  ``next_document_likeness`` gives
the exact likeness of every pair, so it has no tau and can't stop early.

The anchors are those of four languages.  A text without a spot (no anchor, or too
few content words) has its whole word sequence as its only element, so its
likeness to a changed text is 0.  ``near_duplicates`` with ``chains`` gives such a
text all its chains of ``chain`` + 1 words instead, which finds near copies in any
language written with letters and blanks.

Edge cases: null counts as empty.  A text without words has the empty signature;
two empty signatures have likeness 1, an empty and another 0.  Equal texts have
equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SpanHash, code_points, mix, shared, slices, text_blocks, word_char_table

ANCHORS = (
    # English
    "a an and are as at be by for from he in is it not of on or that the this to was with "
    # French
    "avec dans de des du elle en est et il la le les par pas pour qui que sur un une "
    # German
    "auf das dem den der des die ein eine er für im in ist mit nicht sich sie und von zu "
    # Spanish
    "al como con del el es la las lo los no para por que se su un una y"
).split()
CHAIN = 2
STEP = 64
BLOCK = 1 << 19


def _anchor_hashes() -> np.ndarray:
    out = []
    for word in sorted(set(ANCHORS)):
        codes = code_points(word)
        out.append(SpanHash(codes).of(np.array([0]), np.array([len(codes)]))[0])
    return np.sort(np.array(out, dtype=np.uint64))


_anchors: list[np.ndarray] = []


def signatures(texts: list[str], chain: int = CHAIN, chains: bool = False) -> list[np.ndarray]:
    """The sorted distinct spots of each text; ``chains``: a text without spots has its
    word chains instead of its whole word sequence."""
    out: list[np.ndarray] = []
    for a, b in text_blocks(texts, BLOCK):
        out += _signatures(texts[a:b], chain, chains)
    return out


def _signatures(texts: list[str], chain: int, chains: bool) -> list[np.ndarray]:
    if not _anchors:
        _anchors.append(_anchor_hashes())
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    codes = code_points("\n".join([*lowered, ""]))
    edge = np.diff(np.r_[False, word_char_table()[codes], False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = SpanHash(codes).of(start, end)
    place = np.minimum(np.searchsorted(_anchors[0], words), len(_anchors[0]) - 1)
    common = _anchors[0][place] == words
    doc = np.searchsorted(np.cumsum(sizes), start, "right")
    content = np.flatnonzero(~common)
    anchors = np.flatnonzero(common)
    first = np.searchsorted(content, anchors)          # the first content word after each anchor
    last = first + chain - 1
    whole = last < len(content)
    anchors, first, last = anchors[whole], first[whole], last[whole]
    inside = doc[content[last]] == doc[anchors] if len(anchors) else anchors.astype(bool)
    anchors, first = anchors[inside], first[inside]
    spots = words[anchors]
    for k in range(chain):
        spots = mix(spots * np.uint64(3) + words[content[first + k]])
    owner = doc[anchors]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    word_cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = np.unique(spots[cuts[i]:cuts[i + 1]])
        mine = words[word_cuts[i]:word_cuts[i + 1]]
        if not len(own) and chains and len(mine) > chain:
            linked = mine[:len(mine) - chain]
            for k in range(1, chain + 1):
                linked = mix(linked * np.uint64(3) + mine[k:len(mine) - chain + k])
            own = np.unique(linked)
        elif not len(own) and len(mine):
            own = np.array([int.from_bytes(hashlib.sha256(mine.tobytes()).digest()[:8], "little")], dtype=np.uint64)
        out.append(own)
    return out


def fingerprint(signature: np.ndarray) -> str:
    """A digest of the signature: its size and 24 hex digits."""
    return f"{len(signature)}-{hashlib.sha256(signature.astype('<u8').tobytes()).hexdigest()[:24]}"


def size_partition(size: int, tau: float) -> int:
    """Sizes whose ratio is tau or more are in the same or neighbouring partitions."""
    return int(np.floor(np.log(max(size, 1)) / -np.log(tau)))


def merged(a: np.ndarray, b: np.ndarray, tau: float) -> tuple[int, int]:
    """(shared elements found, elements of the smaller set looked at) of two sorted sets:
    STEP elements at a time, until the rests can't bring the likeness to ``tau``."""
    if len(a) > len(b):
        a, b = b, a
    both = at = behind = 0
    while at < len(a):
        most = both + min(len(a) - at, len(b) - behind)
        if most / (len(a) + len(b) - most) < tau:
            break
        part = a[at:at + STEP]
        place = behind + np.searchsorted(b[behind:], part)
        inside = place < len(b)
        both += int(np.count_nonzero(b[place[inside]] == part[inside]))
        at, behind = at + len(part), int(place[-1])
    return both, at


def pruned_jaccard(a: np.ndarray, b: np.ndarray, tau: float = 0.0) -> float | None:
    """Jaccard similarity of two sorted sets; None once it can't reach ``tau``."""
    if not len(a) and not len(b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if small / large < tau:
        return None
    if tau > 0:
        both, seen = merged(a, b, tau)
        if seen < small:
            return None
    else:
        both = len(np.intersect1d(a, b, assume_unique=True))
    likeness = both / (small + large - both)
    return None if likeness < tau else likeness


# ---- each document against its edited text and the next one ------------------

_DIGEST = ("doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, n_spots long")


def edited(text: str, following: str) -> str:
    """The last third (rounded down) replaced by the first as many characters of
    the following text (or all of it)."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def compare_with_next(pairs: Iterable[tuple[object, str, str]], chain: int = CHAIN) -> dict[str, list]:
    """Digest columns of (id, text, next text) triples."""
    pairs = list(pairs)
    texts = [t for _, t, _ in pairs]
    changed = [edited(t, n) for _, t, n in pairs]
    following = [n for _, _, n in pairs]
    sets = signatures([*texts, *following[-1:]], chain)
    # the next text is nearly always the next pair's own
    after = [sets[i + 1] if i + 1 < len(texts) and texts[i + 1] is following[i] or i + 1 == len(texts)
             else signatures([following[i]], chain)[0] for i in range(len(texts))]
    other = signatures(changed, chain)
    return {"n_chars": list(map(len, texts)),
            "edited_sha256": [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed],
            "fingerprint": [fingerprint(s) for s in sets[:len(texts)]],
            "edited_fingerprint": [fingerprint(s) for s in other],
            "near_edited": [pruned_jaccard(s, x) for s, x in zip(sets, other)],
            "near_next": [pruned_jaccard(s, x) for s, x in zip(sets, after)],
            "n_spots": [len(s) for s in sets[:len(texts)]]}


_STEP_ROWS, _STEP_CHARS = 256, 1 << 20


def _walk(batches, chain: int) -> Iterator[pa.RecordBatch]:
    """Over one range of the order: a digest for every row but the last; the
    first and the last row with their text, for the neighbours."""
    id_type = None
    held: list[tuple[object, str]] = []
    task, opened = TaskContext.get().partitionId(), False

    def out(kind, ids, texts, columns):
        n = len(ids)
        arrays = [pa.array([kind] * n, pa.string()), pa.array([task] * n, pa.int64()), pa.array(ids, id_type),
                  pa.array(texts, pa.string())]
        for name, kind_ in (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                            ("near_next", pa.float64()), ("n_spots", pa.int64())):
            arrays.append(pa.array(columns[name] if columns else [None] * n, kind_))
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "task", "doc_id", "text", "n_chars", "edited_sha256",
                                                         "fingerprint", "edited_fingerprint", "near_edited",
                                                         "near_next", "n_spots"])

    def flush():
        pairs = [(i, t, n) for (i, t), (_, n) in zip(held, held[1:])]
        ids = [i for i, _, _ in pairs]
        columns = compare_with_next(pairs, chain)
        del held[:-1]
        return out("done", ids, [None] * len(ids), columns)

    size = 0
    for batch in slices(batches):
        id_type = batch.column(0).type
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.append((i, text or ""))
            size += len(text or "")
            if not opened:
                opened = True
                yield out("first", [i], [text or ""], None)
            if len(held) > _STEP_ROWS or size > _STEP_CHARS and len(held) > 1:
                yield flush()
                size = len(held[-1][1])
    if len(held) > 1:
        yield flush()
    if held:
        yield out("last", [held[0][0]], [held[0][1]], None)


def next_document_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           chain: int = CHAIN) -> DataFrame:
    """One digest row per document; the next document is the one after it by
    descending id (then text), and the first one after the last.

    The documents are sorted by range once; a task walks its range and needs
    only the first text of the next range.  First and last rows of the ranges
    (two a task) are paired afterwards.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc(), F.col("text").asc()]
    walked = shared(
        rows.repartitionByRange(F.col("doc_id").desc()).sortWithinPartitions(*order)
        .mapInArrow(lambda b: _walk(b, chain), f"kind string, task long, doc_id {id_type}, text string, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double, n_spots long"), "spots")
    # two rows per range: the order of the ranges, without the texts
    edges = walked.where("kind <> 'done'").select("kind", "task")
    every = Window.orderBy("task", "kind")
    turn = (edges.withColumn("to", F.lead("task").over(every))
            .withColumn("to", F.coalesce("to", F.min("task").over(Window.partitionBy())))
            .where("kind = 'last'").select(F.col("task").alias("from"), "to"))
    firsts = walked.where("kind = 'first'").select(F.col("task").alias("first_task"), F.col("text").alias("next_text"))
    lasts = (walked.where("kind = 'last'").join(turn, F.col("task") == F.col("from"))
             .join(firsts, F.col("to") == F.col("first_task")).select("doc_id", "text", "next_text"))

    def border(batches):
        for batch in batches:
            ids = batch.column(0)
            columns = compare_with_next(zip(ids.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()), chain)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(v) for v in columns.values()]],
                                             names=["doc_id", *columns])

    digest = _DIGEST.format(id=id_type)
    names = [c.split()[0] for c in digest.split(", ")]
    return walked.where("kind = 'done'").select(*names).unionByName(lasts.mapInArrow(border, digest))


# ---- search over all documents -----------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: float = 0.8,
                    chain: int = CHAIN, chains: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members gives each document the fingerprint of its
    signature; pairs lists the different signatures (by fingerprint) whose
    likeness is ``tau`` or more, each pair once.  ``chains``: texts without spots are
    compared by their word chains."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            sets = signatures([t or "" for t in batch.column(1).to_pylist()], chain, chains)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(fingerprint, sets), pa.string()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "fingerprint", "spots"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = shared(rows.mapInArrow(run, f"doc_id {id_type}, fingerprint string, spots array<long>"), "signatures")
    sets = shared(signed.groupBy("fingerprint").agg(F.first("spots").alias("spots")).where("size(spots) > 0"), "sets")
    spots = sets.select("fingerprint", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    common = spots.groupBy("spot").agg(F.count("*").alias("df")).withColumnRenamed("spot", "of_spot")
    # prefix filter: with its spots from rare to frequent, the first n - ceil(tau n) + 1 must hold a shared one
    ranked = (spots.join(common, F.col("spot") == F.col("of_spot"))
              .withColumn("place", F.row_number().over(Window.partitionBy("fingerprint").orderBy("df", "spot")))
              .where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * tau) + 1))
    partition = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(tau)))).cast("int")
    lists = shared(ranked.select("fingerprint", "n", "spot", partition.alias("part")), "lists")
    left = lists.select(F.col("fingerprint").alias("a"), F.col("n").alias("n_a"), "spot",
                        F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = lists.select(F.col("fingerprint").alias("b"), F.col("n").alias("n_b"), "spot", "part")
    met = (left.join(right, ["spot", "part"])
           .where((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
           .where(F.col("n_a") >= F.col("n_b") * tau).select("a", "b").distinct())
    of = lambda c: sets.select(F.col("fingerprint").alias(f"f_{c}"), F.col("spots").alias(f"s_{c}"))
    def compared(batches):
        for batch in slices(batches):
            sides = [[x.as_py() for x in batch.column(k)] for k in (0, 1)]
            sets = [[x.values.to_numpy().view(np.uint64) for x in batch.column(k)] for k in (2, 3)]
            likeness = pa.array((pruned_jaccard(x, y, tau) for x, y in zip(*sets)), pa.float64())
            whole = pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in sides), likeness], names=["a", "b", "likeness"])
            yield whole.filter(likeness.is_valid())

    pairs = (met.join(of("a"), F.col("a") == F.col("f_a")).join(of("b"), F.col("b") == F.col("f_b"))
             .select("a", "b", "s_a", "s_b").mapInArrow(compared, "a string, b string, likeness double"))
    return signed.select("doc_id", "fingerprint"), pairs

"""SimHash near-duplicate groups by bit-sliced comparison.

A text's fingerprint has 64 bits; bit b is set when it is set in more than half
of the hashes of the text's word shingles.  Two fingerprints link when they
differ in at most ``radius`` bits; linked fingerprints form groups.

Candidates.  The 64 bits are cut into ``radius + 6`` pieces.  Two fingerprints
within the radius agree on all pieces but ``radius`` of them, so every choice of
6 agreeing pieces is a bucket key and no link is missed.  For a radius of 2 a
key leaves 16 bits free: a bucket holds at most 65,536 *different* fingerprints
whatever the data, since equal fingerprints are collapsed (map side first)
before anything is bucketed.  No bucket is capped or dropped.

Comparison.  Buckets are laid side by side as 64 vertical bit planes.  Round r
compares every fingerprint with the one r places further on in its bucket:
shifted planes are XORed and added into carry-save counters, 64 pairs per word
operation.  After every eight planes the words in which all pairs exceed the
radius are abandoned.  A bucket returns a star per local group, not its pairs.

Groups.  The stars' edges are contracted until none is left: every vertex
moves to the neighbour of the smallest hash, edges are renamed, loops and
repeats go.  Vertices at least halve on average, whatever the shape.

Edge cases: a null text counts as empty; a text without words has fingerprint
zero and links like any other; repeated rows (also repeated ids) each get a
row; a null id stays a row and takes the group's smallest id; an empty table
gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared, slices

SEED = 42
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_TEXT_BLOCK = 1 << 22      # bytes split into words at a time
_LANES = 1 << 17           # fingerprints compared at a time (or one bucket)
_COLUMN = np.arange(8) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLANE_STEP = 8            # planes between looks for abandoned words


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        end = at + _TEXT_BLOCK
        if end < len(data):
            found = _SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text (see the module's text)."""
    counts = np.zeros(64, dtype=np.int64)
    total = 0
    carry: list[bytes] = []
    # bytes.lower and bytes.split know just A-Z and the six ASCII separators
    for block in _word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carry + block
        carry = words[-(shingle - 1):] if shingle > 1 else []
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], SEED)
                           for a, b in zip(starts, ends[shingle - 1:].tolist())])
        counts += _bit_counts(hashes)
        total += len(words) - shingle + 1
    if not total and carry:
        counts += _bit_counts(xxhash.xxh64_digest(b" ".join(carry), SEED))
        total = 1
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big") if total else 0


def _bit_counts(digests: bytes) -> np.ndarray:
    """How often each of the 64 bits is set, from a histogram of the eight byte columns."""
    columns = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8) + _COLUMN
    seen = np.bincount(columns.ravel(), minlength=8 * 256).reshape(8, 256)
    return (seen @ _BITS).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit integer."""
    id_type = docs.schema[id_col].dataType

    def run(batches):
        for batch in slices(batches):
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, fp long")


# ---- bit-sliced comparison -------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of packed bits: word w of plane p holds bit p of 64 fingerprints."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    words = len(fps) // 64 + 2
    padded = np.zeros((64, words * 64), dtype=np.uint8)
    padded[:, :len(fps)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def _above(counters: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose vertical counter is over ``limit``."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for bit in reversed(range(len(counters))):
        if limit >> bit & 1:
            equal &= counters[bit]
        else:
            above |= equal & counters[bit]
            equal &= ~counters[bit]
    return above


def links_at(planes: np.ndarray, shift: int, lanes: np.ndarray, radius: int) -> np.ndarray:
    """The lanes i (of the sorted array ``lanes``) that differ from lane
    i + shift in at most ``radius`` bits."""
    words = np.unique(lanes >> 6)
    wanted = np.zeros(planes.shape[1], dtype=np.uint64)
    np.bitwise_or.at(wanted, lanes >> 6, np.uint64(1) << (lanes & 63).astype(np.uint64))
    far, near = divmod(shift, 64)
    last = planes.shape[1] - 1
    size = (radius + 1).bit_length()
    counters = [np.zeros(len(words), dtype=np.uint64) for _ in range(size)]
    over = ~wanted[words]
    for start in range(0, 64, _PLANE_STEP):
        part = planes[start:start + _PLANE_STEP]
        low = part[:, np.minimum(words + far, last)]
        if near:
            low = (low >> np.uint64(near)) | (part[:, np.minimum(words + far + 1, last)] << np.uint64(64 - near))
        for carry in part[:, words] ^ low:
            for counter in counters:                 # ripple through the carry-save counter
                counter ^= carry
                carry = carry & ~counter
            over |= carry
        over |= _above(counters, radius)
        keep = over != np.uint64(0xFFFFFFFFFFFFFFFF)  # abandon words without a pair inside
        if not keep.all():
            words, over = words[keep], over[keep]
            counters = [c[keep] for c in counters]
            if not len(words):
                break
    inside = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(inside)
    return words[row] * 64 + bit


def local_groups(fps: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the index of its group's first member; ``bucket``
    is sorted, and only members of one bucket are compared."""
    label = np.arange(len(fps))
    planes = bit_planes(fps)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.repeat(np.r_[starts[1:], len(fps)], np.diff(np.r_[starts, len(fps)]))
    lanes, shift = np.arange(len(fps)), 1
    while len(lanes := lanes[lanes + shift < ends[lanes]]):
        found = links_at(planes, shift, lanes, radius)
        if len(found):
            _merge(label, found, found + shift)
        shift += 1
    return label


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        np.minimum.at(label, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (label[label] != label).any():
            label[:] = label[label]


def _bucket_edges(batches, radius: int):
    for batch in batches:
        lists = batch.column(0)
        values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.array([0])
        at = 0
        while at < len(owner):
            end = cuts[max(np.searchsorted(cuts, at + _LANES, "right") - 1,
                           np.searchsorted(cuts, at, "right"))]
            part = values[at:end]
            root = local_groups(part, owner[at:end], radius)
            other = np.flatnonzero(root != np.arange(len(root)))
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(part[other].view(np.int64)),
                                                  pa.array(part[root[other]].view(np.int64))],
                                                 names=["a", "b"])
            at = end


def key_masks(radius: int) -> list[int]:
    """Bit masks (signed) of the bucket keys: six of ``radius + 6`` pieces each."""
    pieces = radius + 6
    edges = [round(64 * i / pieces) for i in range(pieces + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, pieces - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) between different fingerprints of column ``fp`` that join
    exactly the fingerprints connected by links of at most ``radius`` bits."""
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("part"))
        for i, mask in enumerate(key_masks(radius))]))
    # few bytes become many rows here: spread them first, whatever the size of the files
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = (fps.select("fp").distinct().repartition(spread).select("fp", keys.alias("key"))
               .groupBy("key").agg(F.collect_list("fp").alias("fps"))
               .where(F.size("fps") > 1).select("fps"))
    return buckets.mapInArrow(lambda b: _bucket_edges(b, radius), "a long, b long").distinct()


def _ranked(c: str):
    return F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("id"))


def contract(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): one (node, root) row per node with an edge."""
    edges = shared(edges, "edges")
    nodes = (edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node")))
             .distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = shared(both.groupBy("a").agg(F.min(_ranked("b")).alias("best"))
                       .select(F.col("a").alias("old"), F.least(F.col("best"), _ranked("a")).getField("id").alias("new")),
                       "moves")
        edges = shared(
            edges.join(moves, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
            .join(moves.withColumnsRenamed({"old": "old_b", "new": "new_b"}), F.col("b") == F.col("old_b"))
            .select(F.least("a", "new_b").alias("a"), F.greatest("a", "new_b").alias("b"))
            .where("a <> b").distinct(), "edges")
        nodes = shared(nodes.join(moves, F.col("root") == F.col("old"), "left")
                       .select("node", F.coalesce("new", "root").alias("root")), "roots")
    return nodes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (the smallest id of the group)."""
    rows = shared(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    firsts = shared(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = contract(fingerprint_links(firsts, radius))
    linked = shared(firsts.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first_doc"), "linked")
    heads = linked.groupBy("root").agg(F.min("first_doc").alias("head"))
    moved = linked.join(heads, "root").select(F.col("fp").alias("moved_fp"), "head")
    groups = shared(firsts.join(moved, F.col("fp") == F.col("moved_fp"), "left")
                    .select(F.col("fp").alias("group_fp"), F.coalesce("head", "first_doc").alias("component_id")),
                    "groups")
    return (rows.join(groups, F.col("fp") == F.col("group_fp"), "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (a null id is the
    smallest; of one id, the row of the smallest hash; of equal rows, one).

    Only the ids that go are joined to the texts.  Map columns don't count as
    part of a row here."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    tag = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(*plain).alias("row"))
    found = near_duplicates(docs.select(tag.alias("tag"), F.col(f"`{text_col}`").alias("text")), "tag", "text", shingle, radius)
    found = shared(found.groupBy("doc_id").agg(F.first("component_id").alias("head"), F.count("*").alias("copies"))
                   .select(F.col("doc_id.id").alias("__go_id"), F.col("doc_id.row").alias("__go_row"),
                           F.col("doc_id").eqNullSafe(F.col("head")).alias("stays"), "copies"), "heads")
    same = F.col("__tag.id").eqNullSafe(F.col("__go_id")) & (F.col("__tag.row") == F.col("__go_row"))
    tagged = docs.withColumn("__tag", tag)
    kept = tagged.join(found.where("not stays"), same, "left_anti")
    repeated = found.where("stays and copies > 1")
    if repeated.isEmpty():
        return kept.drop("__tag")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["__tag"])
    return kept.join(repeated, same, "left_anti").unionByName(once).drop("__tag")

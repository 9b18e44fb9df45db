"""Byte-level BPE encoding and decoding in linear time.

A vocabulary of byte strings with ranks defines BPE by merging, again and again,
the neighbouring pair of the lowest rank.  The same result is found here from
left to right without merging:

* the bytes are mapped to Latin-1 characters, so that pyahocorasick (which works
  on str) can look tokens up;
* at each place the longest token that matches is tried first, then the token's
  longest proper prefix that is a token, and so on;
* a token may follow another only if the two are *compatible*: merging their
  joined bytes gives just these two tokens again.  A sequence in which all
  neighbours are compatible is the BPE result, so local checks are enough.
  Compatibility is memoised per pair;
* if no token fits, the last token is taken back and its place marked as a dead
  end, so no place is tried twice with the same outcome and the work stays
  linear in the length.

A match of the split pattern that is itself a token is that token, as the
reference library has it; tokens that merging can't reach are used nowhere else.

Edge cases: null and empty texts give no ids (decoded: no bytes).  Repeated
rows each get a row; other columns are ignored.  Texts of any length are split
and encoded match by match; the memo of encoded matches is emptied when it
reaches ``CACHE`` entries, which affects time only.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

CACHE = 1 << 18
LONG = 64                  # matches longer than this many bytes are not remembered


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_bytes(data: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """BPE by its definition: merge the pair of the lowest rank until none is
    left (or ``stop`` parts are)."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > stop:
        best, at = min(((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best > len(ranks):
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class BytePairCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        if len(ranks) != len(set(ranks.values())) or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("ranks must be unique and hold all 256 single bytes")
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        halves = {t: merge_bytes(t, ranks, 2) for t in ranks}
        # reachable by merging, and each token made from two of lower rank
        made = {t for t, h in halves.items() if len(h) == 1 or len(h) == 2 and max(map(ranks.__getitem__, h)) < ranks[t]}
        if any(len(h) == 2 and not made.issuperset(h) for t, h in halves.items() if t in made):
            raise ValueError("ranks don't follow from merges")
        tokens = {t.decode("latin-1"): t for t in made}
        self.left_edge = {name: self._edge(t, halves, 0) for name, t in tokens.items()}
        self.right_edge = {name: self._edge(t, halves, -1) for name, t in tokens.items()}
        self.most = max(map(len, tokens))
        self.find = ahocorasick.Automaton()
        for name in tokens:
            self.find.add_word(name, name)
        self.prefix = {name: self._longest_prefix(name) for name in tokens}
        self.id_of = {name: ranks[t] for name, t in tokens.items()}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.fits = lru_cache(maxsize=1 << 17)(self._fits)

    def _longest_prefix(self, name: str) -> str | None:
        # longest_prefix gives how much of the key the trie has, token or not
        for end in range(len(name) - 1, 0, -1):
            if name[:end] in self.find:
                return name[:end]
        return None

    def _edge(self, token: bytes, halves: dict[bytes, list[bytes]], side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at one edge of a token while it is merged, first
        to last, each with the rank of the merge that ends it."""
        out, ends = [], float("inf")
        while True:
            out.append((token, ends))
            if len(token) == 1:
                return out[::-1]
            ends, token = self.ranks[token], halves[token][side]

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging the joined bytes leaves the border alone: at each moment
        the two parts that meet there must not be the next pair to merge.  Of
        equal ranks the leftmost pair is merged first."""
        lefts, rights = self.right_edge[left], self.left_edge[right]
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            joined = self.ranks.get(a + b)
            if joined is not None and joined < a_ends and joined <= b_ends:
                return False
            if a_ends <= b_ends:
                if a_ends == float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def _longest(self, text: str, at: int) -> str | None:
        end = at + self.find.longest_prefix(text[at:at + self.most])
        while end > at:
            if (name := text[at:end]) in self.id_of:
                return name
            end -= 1
        return None

    def encode_match(self, data: bytes) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        text = data.decode("latin-1")
        tokens: list[str] = []
        open_at = bytearray(b"\1") * (len(text) + 1)
        at, token = 0, self._longest(text, 0)
        while at < len(text):
            end = at + len(token)
            if open_at[end] and (not tokens or self.fits(tokens[-1], token)):
                tokens.append(token)
                at = end
                token = self._longest(text, at) if at < len(text) else None
            elif (shorter := self.prefix[token]) is not None:
                token = shorter
            else:
                open_at[at] = 0
                token = tokens.pop()
                at -= len(token)
        return tuple(map(self.id_of.__getitem__, tokens))

    def encode(self, text: str | None) -> array:
        """The ids of a whole text, as unsigned 32-bit integers."""
        ids, memo = array("I"), self.memo
        for match in self.split(text or ""):
            found = memo.get(match)
            if found is None:
                data = match.encode("utf-8", "surrogatepass")
                found = self.encode_match(data)
                if len(data) <= LONG:
                    if len(memo) >= CACHE:
                        memo.clear()
                    memo[match] = found
            ids.extend(found)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str) -> BytePairCodec:
    """One codec per Python worker and vocabulary file."""
    return BytePairCodec(load_ranks(path))


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every whole text."""
    id_type = docs.schema[id_col].dataType

    def run(batches):
        own = codec(path)
        for batch in slices(batches):
            n, ids_sha, text_sha, every = [], [], [], array("I")
            for text in batch.column(1).to_pylist():
                ids = own.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(little_endian(ids)).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
                if with_ids:
                    every.extend(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                       pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, np.array(every, dtype=np.int32)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string" + ", ids array<int>" * with_ids)

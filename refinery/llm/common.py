"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import scratch_path

# Word separators of every contract: blank and the six ASCII controls 9-13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, a lost executor costs only its own tasks, and Catalyst
    knows the size."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def sampled(df: DataFrame, n: int) -> DataFrame:
    """Exactly min(``n``, rows) rows of ``df``, whatever repeats in them: those of the
    smallest hash of the row's number.

    The nth smallest hash is found without reading a column, and the rows up to it stay
    where they are (no task holds the sample).  ``df`` must give its rows in the same
    order twice, as a stored table does."""
    place = F.xxhash64(F.lit("sample"), F.monotonically_increasing_id())
    last = df.select(place.alias("place")).orderBy("place").limit(n).agg(F.max("place")).first()[0]
    return df.where(place <= last) if last is not None else df.limit(0)


def within(df: DataFrame, place: str, size: str, n: int, total: int) -> DataFrame:
    """The rows of ``df`` of the smallest ``place``, at most ``n`` and of at most ``total``
    of ``size`` together.  Only places and sizes of ``n`` rows come to the driver."""
    last, used = None, 0
    for r in df.select(place, size).orderBy(place).limit(n).collect():
        used += r[size] or 0
        if used > total:
            break
        last = r[place]
    return df.where(F.col(place) <= last) if last is not None else df.limit(0)


def slices(batches, rows: int = 1000):
    """Arrow batches in parts of ``rows`` rows, which bounds what a task holds as
    Python objects (the parts share the batch's memory)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_blocks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``limit`` characters (one at
    least), so that arrays made from a range stay small."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def segments(text: str, limit: int) -> Iterator[str]:
    """Cut one text after a blank or line break into parts of about ``limit``
    characters; the parts joined are the text."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit)) + 1
        cut = cut if cut > at else at + limit
        yield text[at:cut]
        at = cut
    yield text[at:]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


_B = 0x9E3779B97F4A7C15 | 1
_B_INV = pow(_B, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class SpanHash:
    """64-bit hashes of any spans of one code point array, by prefix sums
    modulo 2^64; equal spans hash alike wherever they stand."""

    _tables: dict[str, np.ndarray] = {}

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        known = self._tables.get("up")
        if known is None or len(known) < n:
            size = max(n, 1 << 16)
            self._tables["up"] = _powers(_B, size)
            self._tables["down"] = _powers(_B_INV, size)
        up = self._tables["up"]
        self.down = self._tables["down"]
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WORD_CHAR: list[np.ndarray] = []


def word_char_table() -> np.ndarray:
    """True for the code points that ``str.isalpha`` accepts."""
    if not _WORD_CHAR:
        _WORD_CHAR.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _WORD_CHAR[0]

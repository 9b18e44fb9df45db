"""Token counts from pre-token frequencies, without materialising ids.

No piece of the vocabulary has a blank after another character, and none has a
line break inside, so a text's pieces never span such a border: the text falls
into *pre-tokens* (a run of blanks with what follows it, or a line break with
what follows it) whose piece counts simply add up.  ``check_borders`` proves
this for a vocabulary before it is used.

* Each text becomes pre-token frequencies, inside the row.
* Pre-tokens that are frequent in a bounded sample of the documents (``sample``
  documents, at most ``known`` pre-tokens; both affect speed only) are counted
  once each and sent to all tasks: that table's size is bounded by ``known``.
* All others, however many, go the distributed way: the (row, pre-token,
  frequency) rows are dealt by pre-token and sorted, so that equal ones lie
  together and are counted once, whatever the number of rows that have them; each
  row gets its pre-token's count, and the products are summed by row.  That is one
  shuffle of the pre-tokens: no table of the distinct ones is made beside them.

Edge cases: null and empty texts have 0 bytes and 0 tokens; special strings
inside texts are ordinary text, as the library has it by default; repeated rows
(also repeated or null ids) each get a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, shared, slices

BLANK = "▁"
_PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text; joined they are a blank (the library's dummy
    prefix) and the text."""
    return _PRE_TOKEN.findall(" " + text.replace(BLANK, " ")) if text else []


@lru_cache(maxsize=4)
def model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_borders(path: str) -> None:
    sp = model(path)
    bad = [p for p in map(sp.id_to_piece, range(sp.get_piece_size()))
           if re.search(f"[^{BLANK}]{BLANK}", p) or "\n" in p]
    if bad or sp.encode("\n")[0] != sp.piece_to_id(BLANK) or sp.encode("a  b")[-1:] == [sp.unk_id()]:
        raise ValueError(f"pieces of {path} cross pre-token borders: {bad[:5]}")


def count_pieces(path: str, pre: list[str]) -> list[int]:
    """Pieces of each pre-token.  The library puts a blank in front of what it is
    given: for a pre-token that starts with one it stands for that blank, for one
    that starts with a line break it is a piece too many."""
    sp = model(path)
    found = sp.encode([p[1:] if p[0] == " " else p for p in pre], num_threads=1)
    return [1 if p == " " else len(ids) - (p[0] == "\n") for p, ids in zip(pre, found)]


def _with_counts(pieces: DataFrame, path: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            pre = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count_pieces(path, pre), pa.int64())],
                                             names=["pre", "pieces"])

    return pieces.mapInArrow(run, "pre string, pieces long")


def _times_pieces(rest: DataFrame, path: str) -> DataFrame:
    """(row, more) of sorted (row, pre, n): frequency times pieces, each pre-token of a batch counted once."""
    def run(batches):
        for batch in batches:
            pre = batch.column(1).dictionary_encode()
            pieces = np.array(count_pieces(path, pre.dictionary.to_pylist()), np.int64)
            more = batch.column(2).to_numpy() * pieces[pre.indices.to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(more)], names=["row", "more"])

    return rest.mapInArrow(run, "row long, more long")


def _frequencies(batches):
    for batch in batches:
        seen: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            seen.update(pre_tokens(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["pre", "n"])


def frequent(docs: DataFrame, path: str, sample: int, known: int) -> dict[str, int]:
    """Piece counts of the pre-tokens most frequent in a sample of ``sample`` texts."""
    texts = sampled(docs, sample).select("text")
    seen = (texts.mapInArrow(_frequencies, "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n"))
            .where(F.length("pre") <= 64).orderBy(F.desc("n"), "pre").limit(known).select("pre"))
    return {r.pre: r.pieces for r in _with_counts(seen, path).collect()}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 sample: int = 8000, known: int = 250_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens), one row per input row."""
    check_borders(path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(frequent(rows, path, sample, known))

    def run(batches):
        table = sent.value
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            numbers, sizes, sums, rest = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                total, other = 0, []
                for pre, n in Counter(pre_tokens(text)).items():
                    pieces = table.get(pre)
                    if pieces is None:
                        other.append((pre, n))
                    else:
                        total += n * pieces
                numbers.append(row)
                row += 1
                sizes.append(len(text.encode("utf-8", "surrogatepass")))
                sums.append(total)
                rest.append(other)
            offsets = [0]
            for x in rest:
                offsets.append(offsets[-1] + len(x))
            pairs = pa.StructArray.from_arrays(
                [pa.array([p for x in rest for p, _ in x], pa.string()), pa.array([n for x in rest for _, n in x], pa.int64())],
                names=["pre", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)],
                names=["row", "doc_id", "n_bytes", "known", "rest"])

    counted = shared(rows.mapInArrow(run, f"row long, doc_id {id_type}, n_bytes long, known long, "
                                          "rest array<struct<pre: string, n: long>>"), "pre-tokens")
    rest = counted.select("row", F.explode("rest").alias("x")).select("row", "x.pre", "x.n")
    # REBALANCE: a pre-token too frequent for one task is split over several
    dealt = rest.hint("rebalance", "pre").sortWithinPartitions("pre")
    sums = (_times_pieces(dealt, path).groupBy("row").agg(F.sum("more").alias("more"))
            .withColumnRenamed("row", "of_row"))
    return (counted.join(sums, F.col("row") == F.col("of_row"), "left")
            .select("doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens")))

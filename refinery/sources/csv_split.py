"""CSV files whose values may hold line breaks, read by as many tasks as they have splits.

A line break ends a record only outside quotes, and a split in the middle of a file
doesn't know whether it begins inside them.  So:

1. Every split counts its quotes (one aggregation, one row a split).  An odd count
   turns the state round for all that follows, so a running sum over the splits of a
   file says in which state each begins.
2. With its state known, a split cuts its lines into records by the running quote
   parity.  Records inside one split are complete.
3. What is left at a split's borders (the end of a record that began earlier, the
   beginning of one that goes on) is put together by the split in which the record
   began.  That is at most two pieces a split, and none if no split begins inside quotes.

The records are then parsed by Spark's own CSV expression, with the options of the
package's CSV contract.  Lines end with a line feed.  In files that aren't ``own``, a
record may also end with a carriage return and a line feed, which then count as one
line feed inside its quotes too, as in Spark's reader.  Quotes are those of the contract: a value that holds one is
quoted, and it is doubled inside.  A file whose quotes don't pair up fails the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery.csv_format import reader_options
from refinery.session import scratch_path

#: splits that begin inside quotes, of one read; 24 bytes each are sent to every task
SPLITS = 1_000_000
RECORD, END, MIDDLE, BEGIN = range(4)
_SCHEMA = "file long, block long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")))


def _states(lines: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin inside quotes, and (file, null) of a file that ends so."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes.cast("long")) % 2).alias("odd"))
    order = Window.partitionBy("file").orderBy("block")
    upto = odd.select("file", "block", (F.sum("odd").over(order) % 2).alias("inside"))
    after = upto.withColumn("next", F.lead("block").over(order)).where("inside = 1")
    return after.select("file", F.col("next").alias("block"))


class _Cutter:
    """Cuts the lines of the splits of one task into records."""

    def __init__(self, own: bool, borders: bool):
        self.own, self.borders = own, borders
        self.split: tuple[int, int] | None = None

    def begin(self, split: tuple[int, int], inside: bool) -> None:
        self.split, self.inside, self.head = split, inside, inside
        self.held: list[pa.Array] = []      # lines of a record that isn't over
        self.first = split[1] == 0          # whether the next record is the file's first

    def lines(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1
        inside = (np.cumsum(odd) + int(self.inside)) & 1
        ends = np.flatnonzero(inside == 0) + 1
        self.inside = bool(inside[-1])
        if not len(ends):
            self.held.append(lines)
            return
        start = 0
        if self.held or self.head:
            yield from self._out([*self.held, lines.slice(0, ends[0])], END if self.head else RECORD)
            start, ends, self.held, self.head = ends[0], ends[1:], [], False
        if len(ends):
            if not self.borders:
                whole = lines.slice(start, ends[-1] - start)
                offsets = np.concatenate([[start], ends]) - start
                if len(ends) == len(whole):
                    joined = whole
                else:
                    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), whole), "\n")
                yield self._batch(joined, RECORD)
            self.first = False
            start = ends[-1]
        if start < len(lines):
            self.held = [lines.slice(start)]

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.split is not None and self.held:
            yield from self._out(self.held, MIDDLE if self.head else BEGIN)
            self.held = []

    def _out(self, parts: list[pa.Array], kind: int) -> Iterator[pa.RecordBatch]:
        if self.borders == (kind == RECORD):
            self.first = self.first and kind != RECORD
            return
        lines = pa.concat_arrays(parts)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")
        yield self._batch(joined, kind)

    def _batch(self, records: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(records)
        first = np.zeros(n, bool)
        first[:1] = self.first
        self.first = False
        file, block = self.split
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, file)), pa.array(np.full(n, block)), pa.array(np.full(n, kind, np.int32)),
             pa.array(first), records.cast(pa.string())], names=["file", "block", "kind", "first", "record"])


def _cut(own: bool, borders: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(own, borders)
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
            inside = batch.column("inside")
            cuts = (np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                split = int(file[start]), int(block[start])
                if split != cutter.split:
                    yield from cutter.end()
                    cutter.begin(split, bool(inside[start].as_py()))
                yield from cutter.lines(batch.column("line").slice(start, end - start))
        yield from cutter.end()
    return run


def records(spark: SparkSession, path: str | list[str], *, own: bool = False, unpaired: str = "raise") -> DataFrame:
    """(first, record): the text of every record; ``first`` marks those that begin a file.

    A file whose quotes don't pair up fails; with ``unpaired="keep"`` all that follows
    its last quote is one record, as in Spark's reader (for files of bounded size)."""
    lines = _lines(spark, path)
    states = scratch_path(spark, "csv_states")
    _states(lines).write.parquet(states)
    states = spark.read.schema("file long, block long").parquet(states)
    seen = states.agg(F.count("block").alias("splits"), F.count_if(F.col("block").isNull()).alias("open")).first()
    if seen["open"] and unpaired != "keep":
        raise ValueError(f"the quotes of {seen['open']} CSV file(s) under {path} don't pair up")
    if seen["splits"] > SPLITS:
        raise ValueError(f"over {SPLITS} splits begin inside quotes: read the files in parts")
    borders = seen["splits"] or seen["open"]
    if borders:
        # at most SPLITS rows (checked above); the lines stay in their order
        marked = lines.join(F.broadcast(states.where("block is not null").withColumn("inside", F.lit(True))), ["file", "block"], "left")
    else:
        marked = lines.withColumn("inside", F.lit(None).cast("boolean"))
    marked = marked.select("file", "block", "line", "inside")
    out = marked.mapInArrow(_cut(own, False), _SCHEMA).select("first", "record")
    if borders:
        out = out.unionByName(_stitched(spark, marked.mapInArrow(_cut(own, True), _SCHEMA)))
    if own:
        return out
    # a carriage return before the line feed that ends a record belongs to the line end
    bare = F.replace(F.expr("substr(record, 1, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return out.select("first", F.when(F.endswith("record", F.lit("\r")), bare).otherwise(F.col("record")).alias("record"))


def _stitched(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Records that reach over splits: their pieces joined under the split they began in."""
    path = scratch_path(spark, "csv_pieces")
    pieces.write.parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.max(F.when(F.col("begins"), F.col("block"))).over(before)
    slim = (pieces.groupBy("file", "block").agg(F.bool_or(F.col("kind") == BEGIN).alias("begins"))
            .select("file", "block", begun.alias("from_block")))
    placed = pieces.join(slim, ["file", "block"]).withColumn(
        "from_block", F.when(F.col("kind") == BEGIN, F.col("block")).otherwise(F.col("from_block")))
    ordered = F.sort_array(F.collect_list(F.struct("block", "record", "first")))
    return (placed.groupBy("file", "from_block").agg(ordered.alias("parts"))
            .select(F.element_at("parts", 1)["first"].alias("first"),
                    F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_split_csv(spark: SparkSession, path: str | list[str], schema: StructType | str, *, header: bool = True,
                   own: bool = False, typed: bool = True, enforceSchema: bool = True,
                   unpaired: str = "raise", **options) -> DataFrame:
    """The rows of CSV files as Spark's multi-line reader gives them, by splits.

    With ``enforceSchema`` False a header whose names differ from the schema's fails.
    Other ``options`` go to the parser; those that decide where a record ends are fixed."""
    fixed = {"quote", "escape", "linesep", "multiline", "encoding", "charset", "comment"} & {k.lower() for k in options}
    if fixed:
        raise ValueError(f"{sorted(fixed)} can't be chosen for a read by splits")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    parse = {**reader_options(header=False, typed=typed, own=own), **{k: str(v) for k, v in options.items()}}
    parse.pop("lineSep", None)
    parse["multiLine"] = "false"
    found = records(spark, path, own=own, unpaired=unpaired).where("record <> ''")
    if header:
        keep = ~F.col("first")
        if str(enforceSchema).lower() == "false":
            fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
            names = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(schema) + 1)), parse)
            same = names[f"c{len(schema)}"].isNull()
            for i, field in enumerate(schema.fields):
                name = names[f"c{i}"] if fold is str else F.lower(names[f"c{i}"])
                same = same & name.eqNullSafe(F.lit(fold(field.name)))
            wrong = F.raise_error(F.concat(F.lit("CSV header differs from the schema: "), "record")).cast("boolean")
            keep = F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(wrong)
        found = found.where(keep)
    return found.select(F.from_csv("record", _ddl(schema), parse).alias("row")).select("row.*")

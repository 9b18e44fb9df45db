"""Chat formatting after cumulative-snapshot collapse.

Native: only DataFrame and SQL functions.

Services log a conversation after each turn, so a log holds all its prefixes.
Every turn gets the rolling hash of the conversation up to it: the sum of hashes
of (position, role, text), two independent 64-bit ones, summed exactly as
decimals.  A conversation whose whole hash is the hash of a proper prefix of
another one is dropped by an anti-join, equal conversations leave the one of the
smallest id, and what remains is rendered.

All rows are sorted by range once, also within a conversation (equal rows, which
can stand in any order, by their place in the input), and a position is the row's
place in its range behind the conversation's rows in the ranges before.  Sums of
position-salted hashes can be split anywhere, so they run over blocks of ``BLOCK``
positions.  No task holds more of a conversation than a range or a block.
Both sides of the anti-join are distinct hashes, so a conversation or first turn
that a third of the log shares is one row there.  Rendered conversations of over
``BLOCK`` turns continue in further parts (joined in order they are the whole).

Edge cases: rows of a conversation are ordered by turn (null first), role, text;
repeated rows are turns of their own.  Rows without a conversation id are one
conversation.  A null role is rendered as ``unknown``, a null text as empty, and
neither equals the word or the empty text when compared.  An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared

BLOCK = 1024


def _turn_hash(salt: int) -> Column:
    parts = [F.col(c) for c in ("role", "text")]
    return F.xxhash64(F.lit(salt), "pos", *[x for p in parts for x in (p.isNull(), p)]).cast("decimal(20,0)")


def numbered(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns with their position from 1, the conversation's length and two turn hashes."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    # the upper bits of the place are the range, the lower 33 count its rows in order
    ordered = shared(rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order, "salt")
                     .sortWithinPartitions(*order).select(*rows.columns, F.monotonically_increasing_id().alias("place")), "ordered")
    ordered = ordered.withColumn("range", F.shiftright("place", 33))
    sizes = ordered.groupBy("conv_id", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    own = Window.partitionBy("conv_id")
    before = own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("s_conv"), F.col("range").alias("s_range"), "first",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(own).alias("len"))
    placed = (ordered.join(sizes, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("range") == F.col("s_range")))
              .withColumn("pos", F.col("offset") + F.col("place") - F.col("first") + 1)
              .withColumn("block", F.floor((F.col("pos") - 1) / block)))
    return shared(placed.select("conv_id", "block", "pos", "len", "role", "text", _turn_hash(1).alias("h1"), _turn_hash(2).alias("h2")),
                  "turns")


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """(conv_id, pos, len, p1, p2): the rolling hash of each conversation up to each turn."""
    sums = placed.groupBy("conv_id", "block").agg(F.sum("h1").alias("b1"), F.sum("h2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select(F.col("conv_id").alias("s_conv"), F.col("block").alias("s_block"),
                       *[F.coalesce(F.sum(c).over(before), zero).alias(c) for c in ("b1", "b2")])
    run = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rolled = (placed.select("conv_id", "block", "pos", "len", F.sum("h1").over(run).alias("r1"), F.sum("h2").over(run).alias("r2"))
              .join(sums, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("block") == F.col("s_block"))))
    return rolled.select("conv_id", "pos", "len", (F.col("r1") + F.col("b1")).cast("decimal(38,0)").alias("p1"),
                         (F.col("r2") + F.col("b2")).cast("decimal(38,0)").alias("p2"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_copies) of the conversations that no longer one begins with."""
    prefixes = shared(prefixes, "prefixes")
    whole = (prefixes.where("pos = len").groupBy("len", "p1", "p2")
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    inner = (prefixes.where("pos < len").select(F.col("pos").alias("i_len"), F.col("p1").alias("i1"), F.col("p2").alias("i2")).distinct())
    return (whole.join(inner, (F.col("len") == F.col("i_len")) & (F.col("p1") == F.col("i1")) & (F.col("p2") == F.col("i2")), "left_anti")
            .select("conv_id", "n_copies"))


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in chat markup; a mark inside a text is broken up."""
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), clean(F.coalesce(role, F.lit("unknown"))), F.lit("\n"),
                    clean(F.coalesce(text, F.lit(""))), F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, text) of the maximal conversations."""
    placed = numbered(turns, block)
    kept = shared(maximal(prefix_hashes(placed)), "maximal").withColumnRenamed("conv_id", "k_conv")
    pieces = (placed.join(kept, F.col("conv_id").eqNullSafe(F.col("k_conv")))
              .select("conv_id", "len", "n_copies", "pos", F.floor((F.col("pos") - 1) / block).alias("part"),
                      rendered_turn(F.col("role"), F.col("text")).alias("piece")))
    whole = pieces.groupBy("conv_id", "part").agg(F.max("len").alias("n_turns"), F.max("n_copies").alias("n_copies"),
                                                 F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("pieces"))
    return whole.select("conv_id", "part", "n_turns", "n_copies", F.array_join("pieces.piece", "").alias("text"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS len
  FROM conversations),
e AS (
  SELECT *, to_json({'r': role, 't': text}) AS enc FROM t),
p AS (
  SELECT conv_id, pos, len,
         string_agg(enc, ',') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS pre
  FROM e),
kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM p
  WHERE pos = len AND pre NOT IN (SELECT pre FROM p WHERE pos < len)
  GROUP BY pre)
SELECT t.conv_id, (t.pos - 1) // 1024 AS part, CAST(max(t.len) AS BIGINT) AS n_turns,
       CAST(max(kept.n_copies) AS BIGINT) AS n_copies,
       string_agg('<|im_start|>' || replace(coalesce(t.role, 'unknown'), '<|', '< |') || chr(10)
                  || replace(coalesce(t.text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS text
FROM t JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id
GROUP BY t.conv_id, part
"""

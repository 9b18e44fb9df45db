"""Mixing sources to target weights: temperature mixing.

Native: only DataFrame and SQL functions.

Tokens are counted natively: a text has as many as blank-separated words, and one
per ``TOKEN_BYTES`` bytes (UTF-8, without blanks) at least, which counts unspaced
scripts, base64 and minified text.  ``token_col`` names a column of exact counts to
use instead (null counts as 0).

Source token shares p are raised to an exponent and normalised, q ~ p^a: 1 keeps
the shares, 0 makes all sources equal.  The exponent is bisected to the largest that
meets ``entropy`` (as a part of log n of n sources); then raised as far as needed so
that no source is repeated more than ``max_repeats`` times (the limit wins if both
can't be met).  A pass of the bisection is one aggregation over the table of sources:
the sums of p^a and p^a log p for a grid of exponents.

The weights are realised as budgeted block permutations.  A source's share of
the token budget is so many whole copies of the source and a rest.  Every copy
is a permutation of its own: a salted hash puts the documents in order, in
blocks of about ``block_tokens`` tokens.  The rest takes the first blocks of the
next permutation that fit the budget and the first documents of the block after
them.  Sums run over blocks; only one block a source is summed by document, so a
source of any size is spread over all tasks.  What is sent to the tasks is one
row per source, joined by size (Catalyst broadcasts it while it is small).

A source ends within one document of its target, and never above it.

Edge cases: a null source is a source; null and empty texts have no tokens and
come along with their source's copies; rows of a null or repeated id are numbered
(``tagged``), so each has its own place in every permutation; sources without
tokens, an empty table: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, shared

_KEY = "__mix_key"
TAG = "__mix_tag"
TOKEN_BYTES = 8
#: exponents looked at in one pass, and passes: 54 halvings
GRID, ROUNDS = 64, 9


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACES))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def token_count(text: Column) -> Column:
    """Words, or a token per TOKEN_BYTES bytes that aren't blanks where that is more."""
    solid = F.octet_length(F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, ""))
    return F.greatest(word_count(text), F.ceil(solid / TOKEN_BYTES).cast("long"))


def source_key(source: Column) -> Column:
    return F.to_json(F.struct(source.cast("string").alias("s")))


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(sum of p^a, sum of p^a log p) over all sources for each exponent a.  Summed as
    decimals, so the order of the sources doesn't matter."""
    a, power = F.col("a"), F.exp(F.col("a") * F.col("log"))
    exact = lambda c: F.sum(c.cast("decimal(38,20)"))
    found = (shares.select("log", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
             .groupBy("a").agg(exact(power).alias("z"), exact(power * F.col("log")).alias("s")).orderBy("a").collect())
    return [(float(r["z"]), float(r["s"])) for r in found]


def _bisected(shares: DataFrame, low: float, raise_low) -> tuple[float, float]:
    """[low, 1] narrowed to neighbours: ``raise_low(a, z, s)`` says whether the limit lies
    above ``a``.  A round looks at GRID exponents at once, which is a bisection of
    log2(GRID) steps in one pass over the sources."""
    high = 1.0
    for _ in range(ROUNDS):
        grid = sorted({low + (high - low) * i / GRID for i in range(1, GRID)} - {low, high})
        if not grid:
            break
        above = [raise_low(a, z, s) for a, (z, s) in zip(grid, _sums(shares, grid))]
        n = above.index(False) if False in above else len(grid)
        low, high = grid[n - 1] if n else low, grid[n] if n < len(grid) else high
    return low, high


def weights(totals: DataFrame, entropy: float, max_repeats: float, budget: float) -> DataFrame:
    """(key, tokens, weight, exponent, total) of the sources, from (key, tokens).

    The sources stay a table; the driver gets two sums an exponent."""
    totals = totals.where("tokens > 0").select("key", "tokens")
    whole = totals.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.min("tokens").alias("least")).first()
    total, sources = whole["t"] or 0, whole["n"]
    shares = totals.withColumn("log", F.log(F.col("tokens") / F.lit(float(max(total, 1)))))
    exponent, norm = 1.0, 1.0
    if sources:
        goal = math.log(sources) * entropy
        # entropy of p^a / z is log z - a s / z; the most repeated source is the smallest one
        meets = lambda a, z, s: math.log(z) - a * s / z >= goal
        least = math.log(whole["least"] / total)
        over = lambda a, z, s: math.exp(least * (a - 1)) / z * budget > max_repeats
        exponent = 1.0 if meets(1.0, *_sums(shares, [1.0])[0]) else _bisected(shares, 0.0, meets)[0]
        if over(exponent, *_sums(shares, [exponent])[0]):
            exponent = _bisected(shares, exponent, over)[1]
        norm = _sums(shares, [exponent])[0][0]
    return shares.select("key", "tokens", (F.exp(F.col("log") * exponent) / F.lit(norm)).alias("weight"),
                         F.lit(exponent).alias("exponent"), F.lit(total).cast("long").alias("total"))


def tagged(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with TAG, written: a number for rows whose id is null or repeated (so that
    each has a place of its own), null for the others (their place depends on the id)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    many = (docs.groupBy(F.col(f"`{id_col}`").alias("__mix_id")).agg(F.count(F.lit(1)).alias("__mix_n"))
            .where("__mix_n > 1 and __mix_id is not null"))
    many = shared(many, "mix-repeated")     # written, so that texts aren't shuffled while it is small
    found = docs.join(many, F.col(f"`{id_col}`") == F.col("__mix_id"), "left")
    again = F.col("__mix_id").isNotNull() | F.col(f"`{id_col}`").isNull()
    return shared(found.select(*own, F.when(again, F.monotonically_increasing_id()).alias(TAG)), "mix-tagged")


def _place(seed: int, copy: Column, doc_id: Column, tag: Column) -> Column:
    return F.xxhash64(F.lit(seed), copy.cast("long"), doc_id, tag)      # a null tag changes nothing


def _unit(place: Column) -> Column:
    """A signed 64-bit hash as a number from 0 to 1, in the same order."""
    return (place.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)


def _block(place: Column, blocks: Column) -> Column:
    return F.least(F.floor(_unit(place) * blocks), blocks - 1)


def _tag(df: DataFrame) -> Column:
    return F.col(TAG) if TAG in df.columns else F.lit(None).cast("long")


def plan(rows: DataFrame, entropy: float = 0.9, max_repeats: float = 4.0, budget: float = 1.0,
         block_tokens: int = 1_000_000, seed: int = 11) -> DataFrame:
    """One row per source, from (key, doc_id, tokens, TAG if there is one): weight, target, whole copies and
    where the rest ends (last whole block, last place within the next)."""
    totals = shared(rows.groupBy("key").agg(F.sum("tokens").alias("tokens")), "mix-totals")
    found = weights(totals, entropy, max_repeats, budget)
    target = F.least(F.floor(F.col("weight") * F.col("total") * budget), F.floor(F.col("tokens") * max_repeats)).cast("long")
    sized = shared(found.withColumn("target", target)
                   .withColumn("copies", F.floor(F.col("target") / F.col("tokens")))
                   .withColumn("rest", F.col("target") - F.col("copies") * F.col("tokens"))
                   .withColumn("blocks", F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).cast("long"))
                   .drop("total"), "mix-sizes")
    placed = (rows.join(sized.select(F.col("key").alias("of_key"), "copies", "blocks", "rest"), F.col("key") == F.col("of_key"))
              .withColumn("place", _place(seed, F.col("copies"), F.col("doc_id"), _tag(rows)))
              .withColumn("block", _block(F.col("place"), F.col("blocks"))))
    run = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    border = (placed.groupBy("key", "block").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
              .withColumn("upto", F.sum("n").over(run)).where(F.col("upto") > F.col("rest"))
              .groupBy("key").agg(F.min(F.struct("block", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("b"))
              .select(F.col("key").alias("b_key"), F.col("b.block").alias("border"), F.col("b.left").alias("left")))
    border = shared(border, "mix-border")
    by_place = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (placed.select("key", "block", "place", "tokens")
            .join(border, (F.col("key") == F.col("b_key")) & (F.col("block") == F.col("border")))
            .groupBy("key", "place").agg(F.sum("tokens").alias("n"), F.max("left").alias("left"))
            .withColumn("upto", F.sum("n").over(by_place)).where(F.col("upto") <= F.col("left"))
            .groupBy(F.col("key").alias("l_key")).agg(F.max("place").alias("last_place")))
    return shared(sized.join(border, F.col("key") == F.col("b_key"), "left").join(last, F.col("key") == F.col("l_key"), "left")
                  .select("key", "tokens", "weight", "exponent", "target", "copies", "rest", "blocks", "border", "last_place"),
                  "mix-plan")


def realise(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 11) -> DataFrame:
    """The rows of ``docs`` (``tagged`` as the planned rows were) as often as the plan has them, with __mix_copy, __mix_block and
    __mix_place (their order in a source) and __mix_position (0 to 1: the order in which
    sources are interleaved by weight)."""
    p = planned.select(F.col("key").alias("__mix_of"), F.col("copies").alias("__mix_copies"), F.col("blocks").alias("__mix_blocks"),
                       F.col("border").alias("__mix_border"), F.col("last_place").alias("__mix_last"),
                       # copies and the part of the next permutation that is drawn
                       F.greatest(F.col("copies") + F.coalesce(_unit(F.col("last_place")), F.col("border") / F.col("blocks"), F.lit(0.0)),
                                  F.lit(1e-9)).alias("__mix_turns"))
    doc_id = F.col(f"`{id_col}`")
    place = _place(seed, F.col("__mix_copy"), doc_id, _tag(docs))
    rest = _place(seed, F.col("__mix_copies"), doc_id, _tag(docs))
    rest_block = _block(rest, F.col("__mix_blocks"))
    inside = F.coalesce((rest_block < F.col("__mix_border")) | (rest_block == F.col("__mix_border")) & (rest <= F.col("__mix_last")),
                        F.lit(False))
    taken = F.col("__mix_copies") + inside.cast("long")
    own = docs.columns
    return (docs.withColumn(_KEY, source_key(F.col(f"`{source_col}`"))).join(p, F.col(_KEY) == F.col("__mix_of"))
            .withColumn("__mix_taken", taken).where("__mix_taken > 0")
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__mix_taken") - 1)))
            .withColumn("__mix_place", place).withColumn("__mix_block", _block(place, F.col("__mix_blocks")))
            .withColumn("__mix_position", (F.col("__mix_copy") + _unit(F.col("__mix_place"))) / F.col("__mix_turns"))
            .select(*[F.col(f"`{c}`") for c in own], "__mix_copy", "__mix_block", "__mix_place", "__mix_position"))


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               token_col: str | None = None) -> DataFrame:
    tokens = F.coalesce(F.col(f"`{token_col}`").cast("long"), F.lit(0)) if token_col else token_count(F.col(f"`{text_col}`"))
    return shared(docs.select(source_key(F.col(f"`{source_col}`")).alias("key"), F.col(f"`{source_col}`").cast("string").alias("source"),
                              F.col(f"`{id_col}`").alias("doc_id"), tokens.alias("tokens"), _tag(docs).alias(TAG)), "mix-rows")


def mix(docs: DataFrame, token_col: str | None = None, **options) -> DataFrame:
    """(doc_id, source, tokens, copy, block, place, position, weight) of the mixture."""
    rows = tagged(token_rows(docs, token_col=token_col).drop(TAG))
    planned = plan(rows, **options)
    drawn = realise(rows, planned)
    return (drawn.join(planned.select(F.col("key").alias("w_key"), "weight"), F.col("key") == F.col("w_key"))
            .select("doc_id", "source", "tokens", F.col("__mix_copy").alias("copy"), F.col("__mix_block").alias("block"),
                    F.col("__mix_place").alias("place"), F.col("__mix_position").alias("position"), "weight"))

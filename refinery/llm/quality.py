"""Quality rules: fixed rules, then robust multivariate outliers.

Native: only DataFrame and SQL functions.

Every text gets plain counts.  ``base_failed`` marks texts of under 10 words or
with over 20 % of their words in repeated 5-word windows.  The others are judged
against their own language and source: their transformed statistics (log mean
word length; square roots of the shares of symbols, repeated lines, repeated
words and capitals) get a minimum-covariance-determinant estimate of centre and
covariance, and a text whose squared Mahalanobis distance is over ``cut`` is
rejected.

The estimate starts from medians and quartiles and takes concentration steps:
each keeps the 75 % of a group's texts nearest to the present centre and takes
mean and covariance of those, which brings the determinant down.  A step is one
aggregation by (group, distance bin) that sums the moments of each bin; the bins
up to the 75 % mark make the subset (up to one bin more).
So a group of any size is summed map side and never gathered, and no quantile needs
a sort.  Results depend on the order of rows only in the last digits of sums.
``SPREAD`` is added to the diagonal: statistics that hardly vary can't reject on a trifle.

All three levels (all texts, language, language and source) are estimated in the same
passes.  After each, a group's centre and covariance are drawn towards those of the
level above: n texts weigh n^2 / (n^2 + ``prior``^2) (by the squares, a few odd texts
of a rare language can't vouch for each other).  So a rare group follows its language
and a rare language all texts, without a least number; every text that passes the rules
gets a distance.

Edge cases: null text counts as empty, so it fails for its words; null language
or source is a value like any other; repeated rows (also repeated or null ids)
each get a row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, shared

SYMBOLS = "#*$%&|<>"
CAPITALS = r"\p{Lu}"
LEVELS = 3
WINDOW = 5
STATS = ("word_length", "symbols", "lines", "repeats", "capitals")
SPREAD = (0.10, 0.05, 0.10, 0.10, 0.06)
# chi-square with 5 degrees of freedom: 75 % of a normal sample lies within 6.626, and the
# covariance of that part is 1 / 1.41 of the whole's.
SUBSET, CONSISTENCY = 0.75, 1.41
CUT = 35.0                 # about one in a million of a normal sample
_BINS = 64                 # distance bins per unit of log(1 + distance)


def _once(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, from the window hashes in order."""
    def covered(pairs: Column) -> Column:
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        places = F.sort_array(F.transform(
            F.filter(F.transform(pairs, lambda x, i: F.when(
                F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), x["i"])),
                lambda p: p.isNotNull()), lambda p: p))
        return F.aggregate(
            places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _once(pairs, covered)).otherwise(F.lit(0).cast("long"))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The plain counts of every whole text, with lang and source."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text.alias("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    without = lambda chars: F.length(F.translate("text", chars, ""))
    per_words = _once(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        _once(F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - WINDOW + 1, F.lit(1))),
                                                      lambda i: F.xxhash64(F.slice(w, i, WINDOW))))
              .otherwise(F.array().cast("array<long>")), _repeat_words).alias("n_repeat_words")))
    per_lines = _once(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return rows.select(
        "doc_id", "lang", "source", per_words.alias("w"), per_lines.alias("l"),
        without(SPACES).cast("long").alias("word_chars"), (F.length("text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(CAPITALS)).cast("long").alias("n_capitals")).select(
        "doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
        "w.n_repeat_words", "n_capitals")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics(counted: DataFrame) -> DataFrame:
    """``counted`` with the transformed statistics x0..x4 (zero where nothing can be measured)."""
    share = lambda a, b: F.sqrt(F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0))
    return counted.withColumns({
        "x0": F.when(F.col("n_words") > 0, F.log(F.col("word_chars") / F.col("n_words"))).otherwise(0.0),
        "x1": share("n_symbols", "word_chars"), "x2": share("n_dup_lines", "n_lines"),
        "x3": share("n_repeat_words", "n_words"), "x4": share("n_capitals", "word_chars")})


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance from columns x*, m* and the inverse Cholesky factor w*."""
    n = len(STATS)
    rows = [sum((F.col(f"{prefix}w{i}{j}") * (F.col(f"x{j}") - F.col(f"{prefix}m{j}")) for j in range(i + 1)), F.lit(0.0))
            for i in range(n)]
    return sum((y * y for y in rows), F.lit(0.0))


def _start(rows: DataFrame) -> DataFrame:
    """(group, all, m*, c*): medians and quartile spreads per group, from binned counts."""
    n = len(STATS)
    binned = rows.select("group", F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.floor(F.col(f"x{j}") * 200).alias("bin")) for j in range(n)])).alias("b"))
    seen = binned.groupBy("group", "b.j", "b.bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("group", "j")
    upto = (seen.withColumn("upto", F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("n").over(own)))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, (F.col("bin") + 0.5) / 200))
    quarter = upto.groupBy("group", "j").agg(F.max("all").alias("all"), at(0.5).alias("m"),
                                             ((at(0.75) - at(0.25)) / 1.349).alias("s"))
    pick = lambda j, c: F.max(F.when(F.col("j") == j, F.col(c)))
    wide = quarter.groupBy("group").agg(F.max("all").alias("all"), *[pick(j, "m").alias(f"m{j}") for j in range(n)],
                                        *[pick(j, "s").alias(f"s{j}") for j in range(n)])
    return wide.select("group", "all", *[f"m{j}" for j in range(n)], *[
        (F.col(f"s{i}") * F.col(f"s{i}") + SPREAD[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i in range(n) for j in range(i + 1)])


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """(group, all, m*, c*): moments of the nearest SUBSET of each group."""
    n = len(STATS)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    near = rows.join(params.withColumnRenamed("group", "of_group"), F.col("group") == F.col("of_group"))
    bins = (near.select("group", *[f"x{j}" for j in range(n)], F.floor(F.log1p(_distance()) * _BINS).alias("bin"))
            .groupBy("group", "bin").agg(
                F.count("*").alias("n"), *[F.sum(f"x{j}").alias(f"t{j}") for j in range(n)],
                *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t{i}{j}") for i, j in pairs]))
    own = Window.partitionBy("group")
    inside = (bins.withColumn("below", F.coalesce(F.sum("n").over(
        own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("all", F.sum("n").over(own)).where(F.col("below") < F.col("all") * SUBSET))
    sums = inside.groupBy("group").agg(F.max("all").alias("all"), F.sum("n").alias("n"), *[F.sum(f"t{j}").alias(f"t{j}") for j in range(n)],
                                       *[F.sum(f"t{i}{j}").alias(f"t{i}{j}") for i, j in pairs])
    return sums.select("group", "all", *[(F.col(f"t{j}") / F.col("n")).alias(f"m{j}") for j in range(n)], *[
        ((F.col(f"t{i}{j}") / F.col("n") - F.col(f"t{i}") / F.col("n") * F.col(f"t{j}") / F.col("n")) * CONSISTENCY
         + F.lit(SPREAD[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in pairs])


def _factored(out: DataFrame) -> DataFrame:
    """(group, m*, w*) of (group, m*, c*): the inverse Cholesky factors."""
    n = len(STATS)
    for j in range(n):                                  # Cholesky factor l, column by column
        for i in range(j, n):
            rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(n):                                  # its inverse w
        out = out.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
        for j in range(i):
            out = out.withColumn(f"w{i}{j}", -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
                                 / F.col(f"l{i}{i}"))
    return out.select("group", *[f"m{j}" for j in range(n)], *[f"w{i}{j}" for i in range(n) for j in range(i + 1)])


def estimate(rows: DataFrame, steps: int = 4, min_rows: int = 50) -> DataFrame:
    """(group, m*, w*) of the groups of ``rows`` (group, x*) with ``min_rows`` rows or more,
    each by itself."""
    params = shared(_factored(_start(rows).where(F.col("all") >= min_rows)), "mcd-start")
    for step in range(steps):
        params = shared(_factored(_concentrate(rows, params)), f"mcd-{step}")
    return params


def _leaning(found: DataFrame, groups: DataFrame, prior: float) -> DataFrame:
    """Each group's moments drawn towards those of the group above it: n rows weigh
    n^2 / (n^2 + ``prior``^2)."""
    n = len(STATS)
    names = [f"m{j}" for j in range(n)] + [f"c{i}{j}" for i in range(n) for j in range(i + 1)]
    # written: a row a group, used once for each level
    placed = shared(found.join(groups.withColumnRenamed("group", "of_group"), F.col("group") == F.col("of_group"))
                    .drop("of_group"), "mcd-moments")
    above = placed.where("level = 0").select("group", *names)
    out = above
    for level in range(1, LEVELS):
        up = above.select(F.col("group").alias("u_group"), *[F.col(c).alias(f"u_{c}") for c in names])
        seen = F.col("all").cast("double") * F.col("all")
        share = seen / (seen + F.lit(float(prior) ** 2))
        above = placed.where(F.col("level") == level).join(up, F.col("above") == F.col("u_group")).select(
            "group", *[(share * F.col(c) + (1 - share) * F.col(f"u_{c}")).alias(c) for c in names])
        out = out.unionByName(above)
    return out


def estimate_levels(rows: DataFrame, steps: int = 4, prior: float = 50.0) -> DataFrame:
    """(group, m*, w*) of all groups of all levels; ``rows`` has x* and the groups of each
    row from the top, ``levels``.  A step is one pass for all levels."""
    each = rows.select(*[f"x{j}" for j in range(len(STATS))], F.posexplode("levels").alias("level", "group"), "levels")
    groups = shared(each.select("group", "level", F.get("levels", F.col("level") - 1).alias("above")).distinct(), "mcd-groups")
    each = each.drop("levels", "level")
    params = shared(_factored(_leaning(_start(each), groups, prior)), "mcd-start")
    for step in range(steps):
        params = shared(_factored(_leaning(_concentrate(each, params), groups, prior)), f"mcd-{step}")
    return params


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = 4, prior: float = 50.0,
          cut: float = CUT) -> DataFrame:
    """One row per input row: the counts, base_failed, distance (null where base_failed), kept."""
    levels = F.array(F.lit("all"), F.to_json(F.struct("lang")), F.to_json(F.struct("lang", "source")))
    rows = shared(statistics(counts(docs, id_col, text_col)).withColumn("base_failed", base_failed())
                  .withColumn("levels", levels), "quality")
    params = estimate_levels(rows.where(~F.col("base_failed")), steps, prior)
    rows = rows.join(params.withColumnRenamed("group", "of_group"), F.element_at("levels", -1) == F.col("of_group"), "left")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       F.when(~F.col("base_failed"), _distance()).alias("distance"),
                       (~F.col("base_failed") & (_distance() <= cut)).alias("kept"))

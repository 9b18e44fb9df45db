"""Secret scan: fixed rules, and character Markov models for everything else.

Native: only DataFrame and SQL functions.

Rules find assignments (``password = ...``), access keys and hex runs.  All
their matches are kept.  Besides, every long run of key characters is scored by
two first-order Markov models over its characters, one of random strings and
one of ordinary identifiers.  A run whose log-likelihood ratio per whole run is
``min_ratio`` or more is a secret as well, unless it overlaps a rule's match.

The models are transition counts (add-one smoothed) of labelled samples.
Random: the values the rules matched in the sampled documents, and as many digests
of a counter in hex, base64 and upper-case letters with digits.  Ordinary: the
words of the sampled documents without a match, alone and each joined to the next as
names are (``_``, ``-``, a capital letter, all capitals, a number), and dates of a
counter.  UUIDs are random by design but no keys: they are passed over by their shape.
The sample is exactly min(``sample``, rows) documents and taken whole; scanning covers
every whole text.  What comes to the driver is one table of 67 x 67 numbers.

Positions.  A pattern's matches and the pieces between them alternate, so a
match starts at the sum of the lengths before it: a running sum per document
over the documents that have a match.  No match holds a line break.

Edge cases: null counts as empty; no spans gives empty ``spans`` and the digest
of the empty string; repeated rows (also repeated or null ids) each get a row;
other columns are kept out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sampled, shared

# Patterns and least sizes of the rules, in the order of the kinds.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# A rule's pattern with its least size where that cannot change other matches:
# a run is matched whole, so a run that is too short holds no match at all.
ACCESS_RUN = r"AKIA[A-Z0-9]{16,}"
HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{24,}+"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# a whole run of 16 or more key characters, one of them a letter (numbers are no keys)
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}+"
# random by design, but a name and not a key
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
KINDS = ("assign", "access", "hex", "markov")
MASK = "<SECRET>"


def _symbols(run: Column) -> Column:
    """Places of a run's characters in the alphabet, from 0."""
    return F.transform(F.regexp_extract_all(run, F.lit(r"(.)"), F.lit(1)),
                       lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def log_ratio(run: Column, table: Column) -> Column:
    """Log-likelihood ratio of a run's transitions, by the flat table."""
    size = len(ALPHABET)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _symbols(run), start,
        lambda acc, x: F.struct(x.alias("last"),
                                (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(
                                    F.get(table, acc["last"] * size + x))).alias("sum")),
        lambda acc: acc["sum"])


def _literal(values: list[float]) -> Column:
    """A constant array (folded once at planning)."""
    return F.split(F.lit(",".join(f"{v:.5f}" for v in values)), ",").cast("array<double>")


def train(docs: DataFrame, sample: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """The flat table of log-likelihood ratios of transitions."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = shared(sampled(rows, sample), "secret-sample")
    drawn = rows.count()                # exactly min(sample, rows)
    digest = F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 256)
    code = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    made = docs.sparkSession.range(drawn).select(F.explode(F.array(
        digest, code, F.upper(F.substring(F.regexp_replace(code, "[^A-Za-z0-9]", ""), 1, 20)))).alias("run"))
    value = F.array_union(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
                          F.array_union(F.regexp_extract_all("text", F.lit(HEX_RUN), F.lit(0)),
                                        F.regexp_extract_all("text", F.lit(ACCESS_RUN), F.lit(0))))
    random = F.filter(value, lambda v: F.length(v) >= 16)
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])([A-Za-z][A-Za-z-]{1,24})(?![A-Za-z0-9+/_=-])"), F.lit(1))
    rest = F.greatest(F.size("words") - 1, F.lit(0))
    # each word joined to the next in one of the ways that names are written
    joined = lambda a, b: F.element_at(F.array(
        F.concat_ws("_", a, b), F.concat_ws("-", a, b), F.concat(a, F.initcap(b)), F.concat(F.initcap(a), F.initcap(b)), F.concat(a, b),
        F.upper(F.concat_ws("_", a, b)), F.concat_ws("_", a, F.pmod(F.hash(b), F.lit(1000)))), F.pmod(F.hash(a), F.lit(7)) + 1)
    pairs = F.zip_with(F.slice("words", F.lit(1), rest), F.slice("words", F.lit(2), rest),
                       lambda a, b: joined(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    moment = F.timestamp_seconds(F.lit(946_684_800) + F.col("id") * F.lit(433_494))
    dates = docs.sparkSession.range(drawn).select(F.explode(F.array(*[
        F.date_format(moment, f) for f in ("yyyy-MM-dd'T'HH-mm-ss'Z'", "yyyyMMdd-HHmmss", "yyyy-MM-dd-'v'H")])).alias("run"))
    clean = F.size(F.filter(value, lambda v: F.length(v) >= 16)) == 0
    labelled = (made.select(F.lit("random").alias("label"), "run")
                .union(rows.select(F.lit("random").alias("label"), F.explode(random).alias("run")))
                .union(dates.select(F.lit("word").alias("label"), "run"))
                .union(rows.where(clean).select(words.alias("words"))
                       .select(F.lit("word").alias("label"), F.explode(F.concat("words", pairs)).alias("run"))))
    moves = (labelled.where(F.length("run") >= 2).select("label", _symbols(F.col("run")).alias("s"))
             .select("label", F.explode(F.zip_with(F.slice("s", F.lit(1), F.greatest(F.size("s") - 1, F.lit(0))),
                                                   F.slice("s", F.lit(2), F.greatest(F.size("s") - 1, F.lit(0))),
                                                   lambda a, b: a * len(ALPHABET) + b)).alias("move"))
             .where("move >= 0").groupBy("move").pivot("label", ["random", "word"]).count())
    return _ratios({r["move"]: (r["random"] or 0, r["word"] or 0) for r in moves.collect()})     # at most 67 x 67 rows


def _ratios(counts: dict[int, tuple[int, int]]) -> list[float]:
    from math import log
    n, out = len(ALPHABET), []
    for a in range(n):
        row = [counts.get(a * n + b, (0, 0)) for b in range(n)]
        total = [sum(x[k] for x in row) + n for k in (0, 1)]
        out += [log((r + 1) / total[0]) - log((w + 1) / total[1]) for r, w in row]
    return out


def _patterns() -> list[tuple[str, str, int]]:
    """(kind, pattern, group of the value)."""
    return [("assign", ASSIGN, 2), ("access", ACCESS_RUN, 0), ("hex", HEX_RUN, 0), ("markov", CANDIDATE, 0)]


def _accepted(kind: str, value: Column, table: Column, min_ratio: float) -> Column:
    if kind == "markov":
        return ~value.rlike(UUID) & (log_ratio(value, table) >= min_ratio)
    return F.length(value) >= LEAST[kind]


def _may_match(text: Column, table: Column, min_ratio: float) -> Column:
    """Whether a text can have a span; cheap looks first."""
    assign = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")
    return (assign | (F.contains(text, F.lit("AKIA")) & text.rlike(ACCESS_RUN)) | text.rlike("[0-9a-f]{24}")
            | F.exists(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
                       lambda run: _accepted("markov", run, table, min_ratio)))


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text",
         min_ratio: float = 12.0) -> DataFrame:
    """One row per input row: doc_id and ``found``, its spans as (start, order, kind,
    end) in that order, order being the kind's place in KINDS."""
    table = _literal(ratios)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    flagged = shared(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                 F.when(_may_match(F.col("text"), table, min_ratio), F.col("text")).alias("text")), "flagged")
    hits = flagged.where("text is not null")
    sides = [F.struct(F.lit(i).alias("order"),
                      F.arrays_zip(F.split("text", p, -1).alias("piece"),
                                   F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("match"),
                                   F.regexp_extract_all("text", F.lit(p), F.lit(g)).alias("value")).alias("parts"))
             for i, (_, p, g) in enumerate(_patterns())]
    parts = (hits.select("row", F.explode(F.array(*sides)).alias("side"))
             .where(F.size("side.parts") > 1)
             .select("row", "side.order", F.posexplode("side.parts").alias("place", "part")))
    before = Window.partitionBy("row", "order").orderBy("place")
    placed = (parts.select("row", "order", "place", F.length("part.piece").alias("gap"),
                           F.coalesce(F.length("part.match"), F.lit(0)).alias("size"), F.col("part.value").alias("value"))
              .withColumn("start", F.sum("gap").over(before.rowsBetween(Window.unboundedPreceding, 0))
                          + F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("end", F.col("start") + F.col("size")).where("value is not null"))
    fine = F.lit(False)
    for i, (kind, _, _) in enumerate(_patterns()):
        fine = F.when(F.col("order") == i, _accepted(kind, F.col("value"), table, min_ratio)).otherwise(fine)
    own = Window.partitionBy("row").orderBy("start", "order")
    rule = F.col("order") < len(LEAST)
    spans = (placed.where(fine).select("row", "start", "order", "end")
             .withColumn("covered", F.max(F.when(rule, F.col("end"))).over(own.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("next", F.min(F.when(rule, F.col("start"))).over(own.rowsBetween(0, Window.unboundedFollowing)))
             .where(rule | ((F.coalesce("covered", F.lit(-1)) <= F.col("start"))
                            & (F.col("next").isNull() | (F.col("next") >= F.col("end"))))))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("order") + 1)
    found = (spans.groupBy(F.col("row").alias("of_row"))
             .agg(F.array_sort(F.collect_list(F.struct("start", "order", kind.alias("kind"), "end"))).alias("found")))
    return (flagged.select("row", "doc_id").join(found, F.col("row") == F.col("of_row"), "left")
            .select("doc_id", "found"))


def span_text(found: Column, rules_only: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined ("" without spans)."""
    spans = F.filter(found, lambda s: s["order"] < len(LEAST)) if rules_only else found
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","),
                      F.lit(""))


def count_of(found: Column, kind: str) -> Column:
    return F.coalesce(F.size(F.filter(found, lambda s: s["kind"] == kind)), F.lit(0)).cast("long")


def redact(docs: DataFrame, ratios: list[float], text_col: str = "text", min_ratio: float = 12.0) -> DataFrame:
    """The same rows and columns with every secret in ``text_col`` masked; the
    keyword of an assignment stays.  A null text stays null."""
    table = _literal(ratios)
    text = F.col(f"`{text_col}`").cast("string")
    masked = text
    for kind, pattern, group in _patterns():
        masked = _masked(masked, kind, pattern, group, table, min_ratio)
    return docs.withColumn(text_col, F.when(_may_match(text, table, min_ratio), masked).otherwise(text))


def _masked(text: Column, kind: str, pattern: str, group: int, table: Column, min_ratio: float) -> Column:
    """Pieces and matches put together again, accepted values masked."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("piece"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    shown = lambda p: F.when(p["match"].isNull(), F.lit("")).when(                                   # noqa: E731
        _accepted(kind, p["value"], table, min_ratio),
        F.concat(F.substr(p["match"], F.lit(1), F.length(p["match"]) - F.length(p["value"])), F.lit(MASK))).otherwise(p["match"])
    return F.array_join(F.transform(parts, lambda p: F.concat(p["piece"], shown(p))), "")

"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are the runs of 2, 3 and 4 characters inside its lower-cased
words (word edges included as a boundary mark).  Each is hashed into one of
2^16 rows of an embedding table; a text is the average of its rows; a linear
softmax over that average gives the language.  Embeddings and softmax are
trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows (``per_lang`` rows a language, ``max_rows`` in all, picked by
a hash of the id).  Nothing else is bounded: every whole text is scored.

Calibrated rejection.  A fifth of the sample is kept from training.  Whole
texts and single lines of it fit a softmax temperature; a text whose calibrated
confidence is not over ``min_confidence`` (0.5: no more likely right than wrong) is
rejected, as is a text without a letter.  Rows of subwords that training never
met are zero, so text in an unknown script has no confidence.

Since the softmax is linear, embedding times softmax weights is folded into one
row of scores per subword before scoring.

Edge cases: null text, empty text or text without a letter: ``und``, score 0,
rejected.  Without labelled rows every text is ``und``.  Repeated rows each get
a row; null ids count as held out; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_points, held_out, segments, shared, slices, text_blocks, word_char_table, within

BUCKETS = 1 << 16
BLOCK = 1 << 19            # characters turned into arrays at a time


def _subwords(codes: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(n, bucket of the subword at each place, whether there is one) for n = 2, 3, 4;
    boundaries are 0 in ``codes``."""
    c = codes.astype(np.uint32)
    letter = c != 0
    out = []
    h = c * np.uint32(0x01000193)
    for n in (2, 3, 4):
        h = (h[:-1] ^ c[n - 1:]) * np.uint32(0x01000193) + np.uint32(n)
        ok = letter[1:-1] if n == 3 else letter[:-1] | letter[1:] if n == 2 else letter[1:-2] & letter[2:-1]
        x = h ^ (h >> np.uint32(15))
        out.append((n, (x * np.uint32(0x2C1B3C6D)) >> np.uint32(16), ok))
    return out


def _letters(text: str) -> np.ndarray:
    codes = code_points(text)
    return np.where(word_char_table()[codes], codes, 0)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    codes = np.concatenate([[0], _letters(text.lower()), [0, 0, 0]])
    found = np.concatenate([h[ok] for _, h, ok in _subwords(codes)])
    ids, counts = np.unique(found, return_counts=True)
    return ids, counts / max(1, len(found))


@dataclass
class LanguageModel:
    """``scores``: one row of language scores per bucket, without a bias: text of
    which nothing is known scores all languages alike."""

    langs: list[str]
    scores: np.ndarray
    temperature: float
    min_confidence: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores per language, whether the text has a letter) of whole texts."""
        total = np.zeros((len(texts), len(self.langs)))
        count = np.zeros(len(texts))
        alpha = np.zeros(len(texts), dtype=bool)
        for a, b in text_blocks(texts, BLOCK):
            if b - a == 1 and len(texts[a]) > 2 * BLOCK:
                for part in segments(texts[a], BLOCK):
                    self._add([part], total[a:b], count[a:b], alpha[a:b])
            else:
                self._add(texts[a:b], total[a:b], count[a:b], alpha[a:b])
        return total / np.maximum(count, 1)[:, None], alpha

    def _add(self, texts, total, count, alpha) -> None:
        lowered = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
        starts = np.cumsum(sizes) - sizes
        # one boundary between texts: the subwords at a place belong to its text
        codes = np.concatenate([_letters(" " + " ".join(lowered)), [0, 0, 0, 0]])
        n = int(sizes.sum())
        alpha |= np.logical_or.reduceat(codes[1:n + 1] != 0, starts)
        for _, h, ok in _subwords(codes):
            h, ok = h[:n], ok[:n]
            count += np.add.reduceat(ok.astype(np.float64), starts)
            row = np.where(ok, h, BUCKETS)
            for k, column in enumerate(self._columns()):
                total[:, k] += np.add.reduceat(column[row], starts)

    def _columns(self) -> list[np.ndarray]:
        """One contiguous column of ``scores`` per language."""
        if not hasattr(self, "_by_lang"):
            self._by_lang = [np.ascontiguousarray(self.scores[:, k]) for k in range(len(self.langs))]
        return self._by_lang

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, confidence, accepted) of each text."""
        if not self.langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        logits, alpha = self.logits([t or "" for t in texts])
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(alpha, p[np.arange(len(p)), best], 0.0)
        return ([self.langs[k] if ok else "und" for k, ok in zip(best, alpha)], score,
                alpha & (score > self.min_confidence))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(texts: list[str], lines: int) -> list[tuple[int, str]]:
    """Each whole text and up to ``lines`` of its lines (short texts must be told apart too)."""
    out = []
    for i, text in enumerate(texts):
        out.append((i, text))
        parts = [p for p in text.split("\n") if p.strip()]
        out += [(i, p) for p in parts[:: max(1, len(parts) // lines)][:lines] if len(parts) > 1]
    return out


def train(texts: list[str], labels: list[str], dim: int = 16, epochs: int = 4, rate: float = 4.0,
          min_confidence: float = 0.5, lines: int = 3, seed: int = 7) -> LanguageModel:
    langs = sorted(set(labels))
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0)), 1.0, min_confidence)
    index = {x: k for k, x in enumerate(langs)}
    rng = np.random.default_rng(seed)
    keep = np.arange(len(texts)) % 5 != 4 if len(texts) >= 10 else np.ones(len(texts), dtype=bool)
    examples = [(features(t), index[labels[i]], keep[i]) for i, t in _examples(texts, lines)]
    examples = [x for x in examples if len(x[0][0])]
    learn = [x for x in examples if x[2]]
    check = [x for x in examples if not x[2]] or learn
    embed = rng.normal(0, 0.1, (BUCKETS, dim))
    weights = np.zeros((dim, len(langs)))
    weights[:, :] = rng.normal(0, 0.1, weights.shape)
    met = np.zeros(BUCKETS, dtype=bool)
    steps, done = epochs * max(1, len(learn)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(learn)):
            (ids, share), label, _ = learn[k]
            step = rate * (1 - done / steps)
            done += 1
            met[ids] = True
            x = share @ embed[ids]
            z = x @ weights
            g = np.exp(z - z.max())
            g /= g.sum()
            g[label] -= 1
            back = weights @ g
            weights -= step * np.outer(x, g)
            embed[ids] -= (step * share)[:, None] * back
    scores = np.zeros((BUCKETS + 1, len(langs)))
    scores[:BUCKETS][met] = (embed @ weights)[met]
    z = np.array([share @ scores[ids] for (ids, share), _, _ in check]).reshape(len(check), len(langs))
    y = np.array([label for _, label, _ in check], dtype=int)

    def loss(t: float) -> float:
        p = _softmax(z / t)
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-9)).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    return LanguageModel(langs, scores, float(min(grid, key=loss)) if len(y) else 1.0, min_confidence)


def labelled_sample(docs: DataFrame, per_lang: int, max_rows: int, max_chars: int) -> tuple[list[str], list[str]]:
    """About ``per_lang`` labelled texts a language, at most ``max_rows`` and ``max_chars``
    characters in all, by a hash of the row, from the rows that are not held out.  Texts
    of over a hundredth of ``max_chars`` are not learned from."""
    known = (docs.select("doc_id", "lang", "text", F.monotonically_increasing_id().alias("row"))
             .where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") <= max_chars // 100)))
    # written, so that its size is known and the texts are not shuffled for this join
    counts = shared(known.groupBy("lang").agg(F.count("*").alias("rows")).withColumnRenamed("lang", "of_lang"), "langs")
    place = F.xxhash64(F.lit("sample"), "doc_id", "row")
    share = F.pmod(place, F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = (known.select("lang", "text", F.length("text").alias("size"), place.alias("place"), share.alias("share"))
            .join(counts, F.col("lang") == F.col("of_lang")).where(F.col("share") * F.col("rows") <= per_lang))
    rows = within(rows, "place", "size", max_rows, max_chars).orderBy("place").select("lang", "text").collect()
    return [r.text for r in rows], [r.lang for r in rows]


def fit(docs: DataFrame, per_lang: int = 600, max_rows: int = 6000, max_chars: int = 64 << 20, **options) -> LanguageModel:
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return train(*labelled_sample(rows, per_lang, max_rows, max_chars), **options)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None,
             names: tuple[str, str, str] = ("lang_pred", "lang_score", "lang_accepted")) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and three more: prediction, score
    and whether it is accepted.  A column of ``docs`` of one of their names gives way."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    own = docs.select(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias(names[0]), *[F.col(f"`{c}`") for c in keep])
    schema = (own.schema.add(names[0], "string").add(names[1], "double").add(names[2], "boolean"))

    def run(batches):
        for batch in slices(batches):
            lang, score, ok = sent.value.predict(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score), pa.array(ok)],
                names=[*keep, *names])

    return rows.mapInArrow(run, schema)


def evaluate(predicted: list[str], truth: list[str]) -> dict[str, float]:
    """Accuracy over all rows and by language."""
    by: dict[str, list[bool]] = defaultdict(list)
    for p, t in zip(predicted, truth):
        by[t].append(p == t)
    return {"all": sum(map(sum, by.values())) / max(1, len(truth)), **{k: sum(v) / len(v) for k, v in by.items()}}

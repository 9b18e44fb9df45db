"""Toxicity by multiple-instance learning.

Only documents carry labels, so sentences are the hidden instances.  A
sentence's score is sigmoid(bias + sum of the weights of its words); a document
is toxic if any sentence is: P = 1 - prod(1 - p_sentence), the noisy-or.  The
weights (hashed words and word beginnings of 3 to 8 letters) are learned from
document labels through the noisy-or by AdaGrad with an L1 penalty, in numpy,
on a bounded sample of labelled rows (``max_rows``, picked by a hash of the
id).  Scoring covers every whole text (one of over 2 ``BLOCK`` characters in parts
cut after sentences), and the sentence scores locate what made a document toxic:
every sentence at or over the cut, or the top contributor of a toxic document
whose sentences only reach it together.  Places are code points of the text as it
is given, from the first letter of the sentence to past the mark that ends it.

Document scores are calibrated on the part of the sample that training left
out: the logit is shifted so that the cut that separates that part best falls
on 0.7.  The mapping is monotone.

Edge cases: null or empty text has no sentence and gets the lowest score, 0.
Without labelled rows of both kinds every score is 0.  Repeated rows each get
a row; null ids count as held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, code_points, held_out, sampled, segments, shared, slices, text_blocks, within, word_char_table

BITS = 18
CUT = 0.7
PREFIXES = range(3, 9)
BLOCK = 1 << 19
_MARKS = ".!?\n"
_ENDS = np.array([ord(c) for c in _MARKS], dtype=np.uint32)


def sentence_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document of each sentence, its first character, the one past its end, sentence of
    each feature, feature) over the lower-cased texts."""
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    codes = code_points("\n".join([*lowered, ""]))
    letter = word_char_table()[codes]
    edge = np.diff(np.r_[False, letter, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    mark = np.isin(codes, _ENDS)
    sentence = np.cumsum(mark)[start]                       # the mark belongs to the sentence it ends
    first = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]]) if len(start) else start
    number = np.cumsum(np.r_[False, sentence[1:] != sentence[:-1]]) if len(start) else start
    offsets = np.cumsum(sizes)
    doc = np.searchsorted(offsets, start[first], "right")
    hashes = SpanHash(codes)
    size = end - start
    owner, feature = [number], [hashes.of(start, end) ^ np.uint64(1)]
    for k in PREFIXES:
        long = size > k
        owner.append(number[long])
        feature.append(hashes.of(start[long], start[long] + k) ^ np.uint64(2))
    owner_all, feature_all = np.concatenate(owner), np.concatenate(feature)
    place = start[first] - (offsets - sizes)[doc]
    marks = np.flatnonzero(mark)                            # the break behind each text is one
    stop = np.minimum(marks[np.searchsorted(marks, start[first])] + 1 - (offsets - sizes)[doc], sizes[doc] - 1)
    return doc, place, stop, owner_all, (feature_all >> np.uint64(64 - BITS)).astype(np.int32)


def original_places(text: str, places: np.ndarray) -> np.ndarray:
    """Places in ``text`` of places in its lower-cased form, which can be longer."""
    if len(text.lower()) == len(text):
        return places
    widths = np.fromiter((len(c.lower()) for c in text), np.int64, len(text))
    return np.searchsorted(np.cumsum(widths), places, "right")


def _parts(text: str) -> Iterator[tuple[int, str]]:
    """(first character, part) of one long text, cut after a sentence where a part has an end of one."""
    at = 0
    while len(text) - at > BLOCK:
        cut = max(text.rfind(mark, at, at + BLOCK) for mark in _MARKS) + 1
        cut = cut if cut > at else at + len(next(segments(text[at:at + BLOCK + 1], BLOCK)))
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class ToxicityModel:
    """``weights`` per hashed feature, ``bias`` per sentence, ``shift`` of the document logit."""

    weights: np.ndarray | None
    bias: float = 0.0
    shift: float = 0.0

    def sentence_logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first character, the one past its end, logit) of each sentence with a word."""
        doc, place, stop, owner, feature = sentence_features(texts)
        z = self.bias + np.bincount(owner, weights=self.weights[feature], minlength=len(doc))
        return doc, place, stop, z

    def _strength(self, texts: list[str]) -> np.ndarray:
        """S = -log(1 - P) of each text: sums over its sentences."""
        doc, _, _, z = self.sentence_logits(texts)
        return np.bincount(doc, weights=_softplus(z), minlength=len(texts))

    def long_sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(first character, the one past its end, logit) of the sentences of a long text,
        read in parts: a sentence that goes on over a cut is one sentence."""
        open_ = None
        for at, part in _parts(text):
            _, place, stop, z = self.sentence_logits([part])
            start, end = (at + original_places(part, place)).tolist(), (at + original_places(part, stop - 1) + 1).tolist()
            found = list(zip(start, end, z.tolist()))
            marks = [i for i in (part.find(m) for m in _MARKS) if i >= 0]
            if open_ is not None:
                if found and (not marks or found[0][0] - at < min(marks)):
                    found[0] = (open_[0], found[0][1], open_[2] + found[0][2] - self.bias)
                elif marks:
                    found.insert(0, open_)
                else:
                    found = [open_]
            open_ = None
            if found and found[-1][0] - at > max((part.rfind(m) for m in _MARKS), default=-1):
                open_ = found.pop()
            elif found and not marks:
                open_ = found.pop()
            yield from found
        if open_ is not None:
            yield open_

    def score(self, texts: list[str | None]) -> np.ndarray:
        s = np.zeros(len(texts))
        if self.weights is None:
            return s
        texts = [t or "" for t in texts]
        for a, b in text_blocks(texts, BLOCK):
            if b - a == 1 and len(texts[a]) > 2 * BLOCK:
                s[a] = sum(float(_softplus(np.float64(z))) for _, _, z in self.long_sentences(texts[a]))
            else:
                s[a:b] = self._strength(texts[a:b])
        return self.calibrated(s)

    def calibrated(self, s: np.ndarray) -> np.ndarray:
        return np.where(s > 0, 1 / (1 + np.exp(-np.clip(_logit(s) + self.shift, -700, 700))), 0.0)

    def locate(self, text: str | None, cut: float = CUT) -> list[tuple[int, int, float]]:
        """(first character, the one past its end, score) of the sentences at or over ``cut``,
        in order; the top one of a text that is over it while no sentence is."""
        return self._offending(text, cut) if self.score([text])[0] >= cut else []

    def _offending(self, text: str | None, cut: float) -> list[tuple[int, int, float]]:
        """``locate`` of a text whose score is at or over ``cut``."""
        if self.weights is None or not text:
            return []
        if len(text) > 2 * BLOCK:
            found = list(self.long_sentences(text))
            start, end, z = (np.array([x[k] for x in found]) for k in range(3))
        else:
            _, place, stop, z = self.sentence_logits([text])
            start, end = original_places(text, place), original_places(text, stop - 1) + 1
        if not len(z):
            return []
        p = self.calibrated(_softplus(z))
        over = np.flatnonzero(p >= cut)
        chosen = over if len(over) else [int(z.argmax())]
        return [(int(start[i]), int(end[i]), float(p[i])) for i in chosen]


def _logit(s: np.ndarray) -> np.ndarray:
    """log(P / (1 - P)) of P = 1 - exp(-s)."""
    s = np.maximum(s, 1e-12)
    return s + np.log(-np.expm1(-s))


def train(texts: list[str], labels: list[int], epochs: int = 40, rate: float = 0.3, l1: float = 2e-4,
          batch: int = 512, seed: int = 3) -> ToxicityModel:
    y_all = np.asarray(labels)
    if len(set(labels)) < 2:
        return ToxicityModel(None)
    keep = np.arange(len(texts)) % 5 != 4 if len(texts) >= 50 else np.ones(len(texts), dtype=bool)
    if len(set(y_all[keep])) < 2 or len(set(y_all[~keep])) < 2:
        keep[:] = True
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(1 << BITS), -6.0
    seen, seen_bias = np.full(1 << BITS, 1e-6), 1e-6
    packs = []
    order = rng.permutation(np.flatnonzero(keep))
    for a in range(0, len(order), batch):
        part = order[a:a + batch]
        doc, _, _, owner, feature = sentence_features([texts[i] for i in part])
        key = np.unique(owner.astype(np.int64) << BITS | feature)       # a feature counts once a sentence
        ids, feature = np.unique((key & ((1 << BITS) - 1)).astype(np.int64), return_inverse=True)
        packs.append((doc, (key >> BITS).astype(np.int32), feature.astype(np.int32), ids, y_all[part], len(part)))
    for epoch in range(epochs):
        step = rate * (1 - 0.8 * epoch / epochs)
        for k in rng.permutation(len(packs)):
            doc, owner, feature, ids, y, n = packs[k]
            z = bias + np.bincount(owner, weights=weights[ids][feature], minlength=len(doc))
            s = np.bincount(doc, weights=_softplus(z), minlength=n)
            slope = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(s, 50)), 1e-3), 1.0)
            g_z = slope[doc] / (1 + np.exp(-z)) / n
            g = np.bincount(feature, weights=g_z[owner], minlength=len(ids))
            seen[ids] += g * g
            pace = step / np.sqrt(seen[ids])
            moved = weights[ids] - pace * g
            weights[ids] = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1, 0)
            g_b = g_z.sum()
            seen_bias += g_b * g_b
            bias -= step / np.sqrt(seen_bias) * g_b
    model = ToxicityModel(weights.astype(np.float32).astype(np.float64), float(bias))
    held = np.flatnonzero(~keep) if not keep.all() else np.arange(len(texts))
    s = np.concatenate([model._strength([texts[i] for i in held[a:a + batch]]) for a in range(0, len(held), batch)])
    model.shift = _shift(_logit(s), y_all[held])
    return model


def _shift(z: np.ndarray, y: np.ndarray) -> float:
    """Moves the cut of the best F1 (the middle of the gap below it) to CUT."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(len(y)) + 1 + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1                       # a cut can't part equal scores
    k = int(f1.argmax())
    cut = (z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1
    return float(np.log(CUT / (1 - CUT)) - cut)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_chars: int) -> tuple[list[str], list[int]]:
    """At most ``max_rows`` labelled texts of at most ``max_chars`` characters in all, none
    of over a hundredth of that, from the rows that are not held out."""
    marks = (labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("mark"))
             .select(F.col("doc_id").alias("of_doc"), "mark"))
    chosen = sampled(shared(marks.where(~held_out(F.col("of_doc"))), "marks"), max_rows)
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
            .where(F.length("text") <= max_chars // 100)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("of_doc"))      # at most max_rows rows
            .select("text", "mark", F.length("text").alias("size"), F.xxhash64(F.lit("sample"), "doc_id", "row").alias("place")))
    rows = within(rows, "place", "size", max_rows, max_chars).orderBy("place").select("text", "mark").collect()
    return [r.text for r in rows], [int(r.mark) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_chars: int = 64 << 20, **options) -> ToxicityModel:
    return train(*labelled_sample(docs, labels, max_rows, max_chars), **options)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, sentences, worst_sentence): the document's score, the sentences that
    ``locate`` finds in it (none in a document under the cut), and the first character of
    the highest scored of them."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            scores = sent.value.score(texts)
            found = [[]] * len(texts)
            for i in np.flatnonzero(scores >= CUT):
                found[i] = [dict(zip(span.names, x)) for x in sent.value._offending(texts[i], CUT)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(span))],
                names=["doc_id", "score", "sentences"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, score double, "
                                  "sentences array<struct<start:bigint,`end`:bigint,score:double>>")
    worst = F.array_max(F.transform("sentences", lambda x: F.struct(x["score"], (-x["start"]).alias("before"))))
    return scored.withColumn("worst_sentence", -worst["before"])

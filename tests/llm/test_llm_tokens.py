"""Piece counts and byte-level BPE against the libraries, fuzzed."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from refinery.llm import bpe, token_counts
from refinery.llm import queries as Q
from refinery.plans.inspect import explain_text

SF = "/root/testdata/sf0.01"
PIECES = P.path("piece_bpe_32k.model")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "abcdehiorst  \n\r\t\x00 　é漢😀▁.,'ZA12<s>|"


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(blacklist_categories=["Cs"])), max_size=80))
def test_bpe_is_the_library_s(text):
    codec = bpe.codec(RANKS)
    ids = codec.encode(text)
    assert ids.tolist() == library_cached().encode_ordinary(text) and codec.decode(ids) == text.encode()


_library = []


def library_cached():
    if not _library:
        _library.append(library())
    return _library[0]


def test_bpe_by_definition_on_a_small_vocabulary():
    """Ranks from merges with ties and nested repeats, against merging itself."""
    ranks = {bytes([i]): i for i in range(256)}
    for t in (b"aa", b"aaaa", b"ab", b"aab", b"ba", b"abab", b"ababab", b"bb", b"abb"):
        ranks[t] = len(ranks)
    codec = bpe.BytePairCodec(ranks, r"(?s).+")
    rng = random.Random(9)
    for _ in range(3000):
        data = bytes(rng.choice(b"aabc") for _ in range(rng.randint(1, 14)))
        want = (ranks[data],) if data in ranks else tuple(ranks[p] for p in bpe.merge_bytes(data, ranks))
        assert codec.encode_match(data) == want, data


def test_long_matches_take_linear_time():
    codec = bpe.codec(RANKS)
    import time
    took = []
    for n in (20_000, 80_000):
        text = "".join(random.Random(n).choice("abcdehiorst") for _ in range(n))
        began = time.perf_counter()
        ids = codec.encode(text)
        took.append(time.perf_counter() - began)
        assert codec.decode(ids).decode() == text
    assert took[1] < 12 * took[0]


def test_bpe_query(spark):
    lib = library_cached()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.op10_byte_bpe(spark, SF).collect():
        ids = lib.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@settings(max_examples=500, deadline=None)
@given(st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_piece_counts_add_up(text):
    sp = token_counts.model(PIECES)
    pre = token_counts.pre_tokens(text)
    assert sum(token_counts.count_pieces(PIECES, pre)) == len(sp.encode(text)) if pre else not sp.encode(text)


def test_piece_query_whatever_is_frequent(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: (len(r.text.encode()), len(sp.encode(r.text))) for r in docs.collect()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in Q.op8_token_counts(spark, SF).collect()} == want
    # all counts by way of the join, and nearly none
    for known in (1, 1_000_000):
        got = token_counts.token_counts(docs, PIECES, sample=1000, known=known).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want


def test_rare_pre_tokens_are_shuffled_once(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(4)
    hot = "q" * 90                          # too long for the table of frequent ones
    texts = [None, "", hot] + [" ".join([hot] * rng.randint(0, 3) + ["".join(rng.choice("aeiorst\né") for _ in range(rng.randint(1, 12)))
                                                                    for _ in range(rng.randint(0, 9))]) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")                # equal pre-tokens lie in several batches
    try:
        found = token_counts.token_counts(docs, PIECES, known=1)
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in found.collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {i: (len((t or "").encode()), len(sp.encode(t or ""))) for i, t in enumerate(texts)}
    # no second pass over them for the distinct ones, and no join with these
    plan = explain_text(found, "simple").split("Initial Plan")[0]
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1 and len(re.findall(r"Join (\[|Left|Inner)", plan)) == 1

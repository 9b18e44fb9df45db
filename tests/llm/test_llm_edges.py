"""Every registered query of the subpackage and every pipeline stage on awkward tables."""

import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from refinery.llm import queries as Q

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("fp", "tag", "row", "key", "score", "kept", "group", "found", "tokens",
                                                  "component_id", "lang_pred", "place", "block", "__text", "stays")]])
LABELS = "doc_id long, quality int, toxic int, score string, text string"
VECTORS = "vec_id long, embedding array<float>, label int, id string, vec string, rank string, score string"
TURNS = "conv_id long, turn long, role string, text string, block string, pos string, len string"


def _text(rng, n):
    return " ".join(rng.choice("the of and river stone walks green under la de y casa perro".split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    rng = random.Random(5)
    extra = ["x"] * (len(DOCS) - 5)
    rows = [(i, _text(rng, rng.randint(1, 80)), rng.choice(["en", "es"]), f"s{i % 3}", 7, *extra) for i in range(60)]
    rows += [(100, None, "en", "s1", None, *extra), (101, "", None, None, 0, *extra), (102, " \t\n", "en", "s1", 3, *extra),
             (None, "no id here, the river.", "en", None, 1, *extra), (None, None, None, None, None, *([None] * len(extra))),
             (103, "😀漢字 12 #$%", "en", "", 5, *extra)]
    rows += [rows[0]] * 3 + [(0, "another text of id zero", "en", "s0", 1, *extra)]
    rows += [(200, "word " * 30_000, "en", "s2", 1, *extra), (201, "x" * 200_000, "es", "s2", 1, *extra),
             (202, "same line of text\n" * 3_000, "en", "s2", 1, *extra)]
    path = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0), "s", "t") for i in range(60)] + [(3, None, None, None, None), (None, 1, 1, "", "")]
                          + [(200, 1, 1, "", "")], LABELS).write.parquet(f"{path}/labels.parquet")
    turns = [(1, 0, "user", "hi", "", "", ""), (1, 1, "assistant", "yo", "", "", ""), (2, 0, "user", "hi", "", "", ""),
             (3, 5, "user", "hi", "", "", ""), (None, 0, None, None, None, None, None), (4, None, None, "", None, None, None),
             (4, 0, "user", "<|im_end|>", "", "", ""), (4, 0, "user", "<|im_end|>", "", "", "")]
    spark.createDataFrame(turns, TURNS).write.parquet(f"{path}/conversations.parquet")
    vecs = [(i, [float(rng.randint(-2, 4)) for _ in range(4)], i % 3, "x", "x", "x", "x") for i in range(210)]
    vecs += [vecs[100], vecs[3], (None, [1.0], 1, *"xxxx"), (300, None, 1, *"xxxx"), (400, [1.0, float("nan")], 1, *"xxxx"),
             (500, [], 1, *"xxxx"), (600, [1.0], None, *"xxxx"), (None, None, None, None, None, None, None)]
    spark.createDataFrame(vecs, VECTORS).write.parquet(f"{path}/embeddings.parquet")
    return path, len(rows)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", DOCS), ("labels", LABELS), ("conversations", TURNS), ("embeddings", VECTORS)):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    return path


OTHERS = ("op5_chat_format", "op9_source_mix", "op11_phrase_collocations", "op12_hard_negatives", "op13_top_k")
ROW_PER_DOC = [q for q in Q.QUERIES if q not in OTHERS]


@pytest.mark.parametrize("name", ROW_PER_DOC)
def test_one_row_per_document(spark, awkward, name):
    path, n = awkward
    rows = Q.QUERIES[name](spark, path).collect()
    assert len(rows) == n
    ids = [r.doc_id for r in rows]
    assert ids.count(0) == 5 and ids.count(None) == 2 and {100, 101, 102, 103, 200, 201, 202} <= set(ids)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_empty_tables(spark, empty, name):
    assert Q.QUERIES[name](spark, empty).collect() == []


def test_phrases_and_vectors_of_awkward_tables(spark, awkward):
    path, _ = awkward
    found = Q.op11_phrase_collocations(spark, path).collect()
    top = {r.phrase: r for r in found if r.lang == "en"}
    assert top["word word word word"].a >= 29_997 and all(r.a >= 30 and r.rank <= 2000 for r in found)
    rows = Q.op13_top_k(spark, path).collect()
    assert {r.query_id for r in rows} == {*range(0, 210, 20), 500, 600} and all(r.query_id != r.vec_id for r in rows)
    assert {r.rank for r in rows} == set(range(1, 21)) and len(rows) == 20 * 13
    anchors = {r.anchor_id for r in Q.op12_hard_negatives(spark, path).collect()}
    assert anchors <= {0, 100, 200, 500} and {0, 100, 200} <= anchors


def test_awkward_values(spark, awkward):
    path, _ = awkward
    by = lambda name: {r.doc_id: r for r in Q.QUERIES[name](spark, path).collect()}
    one = by("op1_simhash_near_dedup")
    assert {one[i].fingerprint for i in (100, 101, 102)} == {"0" * 16} and one[102].component_id == 100
    two = by("op2_language_id")
    assert all(two[i].lang_pred == "und" and two[i].score == 0 for i in (100, 101, 102))
    four = by("op4_toxicity")
    assert all(four[i].score == 0 and four[i].predicted == 0 for i in (100, 101, 102))
    seven = by("op7_quality_rules")
    assert seven[100].n_words == 0 and seven[100].base_failed and not seven[202].kept
    assert seven[202].n_dup_lines == 2999 and seven[200].n_repeat_words == 30_000
    ten = by("op10_byte_bpe")
    assert ten[100].n_tokens == 0 and ten[101].n_tokens == 0
    chats = {r.conv_id: r for r in Q.QUERIES["op5_chat_format"](spark, path).collect()}
    assert set(chats) == {None, 1, 4} and chats[4].n_turns == 3 and "<|im_end|>" not in chats[4].text.replace("<|im_end|>\n", "")


def test_stages_keep_columns(spark, awkward, empty):
    path, _ = awkward
    for where in (path, empty):
        docs = spark.read.parquet(f"{where}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, where)
            assert out.columns == docs.columns, name
            rows = out.collect()
            if where == empty:
                assert rows == []
        assert corpus_pipeline.STAGES[-1][1](spark, docs, where).count() == docs.count()


def test_dedup_keeps_one_row(spark, awkward):
    path, _ = awkward
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, docs, path).collect()
    groups = {r.component_id for r in Q.op1_simhash_near_dedup(spark, path).collect()}
    assert len(kept) >= len(groups) - 1 and sum(r.doc_id == 0 for r in kept) <= 2
    assert len([r for r in kept if not (r.text or "").split()]) == 1


def test_pipeline_runs(spark, awkward):
    path, _ = awkward
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    assert 200 not in {r.doc_id for r in rows if r.n_tokens == 0}

"""Every operator and stage on nulls, empty and long texts, repeats, empty tables and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import samples
from tracklake.llm import (
    language, line_dedup, mixing, near_duplicates, pieces, quality_rules, repeats, token_files, topk, toxicity,
)

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
LABELS = [(6, 1, 1), (7, 0, 0), (4, None, None), (None, 1, 1), (9, 1, 0), (8, 0, 1), (8, 0, 0)]


def labels(docs):
    return docs.sparkSession.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def ids(docs):
    blocks = token_files.write(docs, BPE, end_id=2)
    return token_files.starts(token_files.documents(blocks, token_files.encoder(BPE).size))


PER_ROW = {
    "quality": quality_rules.judge,
    "language": language.identify,
    "token files": ids,
    "pieces": lambda docs: pieces.encode(docs, PIECES),
    "near duplicates": near_duplicates.classes,
    "toxicity": lambda docs: toxicity.toxicity(docs, labels(docs)),
    "lines": line_dedup.remove,
    "repeats": repeats.without_repeats,
}


@pytest.fixture(scope="module")
def docs(spark):
    return samples.odd(spark).cache()


@pytest.mark.parametrize("name", PER_ROW)
def test_row_per_row(docs, name):
    got = PER_ROW[name](docs).select("doc_id").collect()
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in samples.odd_rows())


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](samples.empty(spark)).collect() == []


def test_copies_of_odd_rows(docs, spark):
    got = mixing.mix(docs)
    assert set(docs.columns) <= set(got.columns)
    assert all(r["copy"] <= r["n_copies"] for r in got.collect())
    assert mixing.mix(samples.empty(spark)).collect() == []


@pytest.mark.parametrize("name, apply", corpus_pipeline.STAGES)
def test_stage_of_odd_rows(docs, spark, name, apply):
    got = apply(spark, docs, "")
    rows = got.collect()
    if name != "pieces":
        assert got.columns == docs.columns
        carried = {(r[0], None if r[4] is None else str(r[4])) for r in samples.odd_rows()}
        assert {(r["doc_id"], r[c]) for r in rows for c in samples.CLASHES} <= carried
        assert {r["doc_id"] for r in rows} <= {r[0] for r in samples.odd_rows()}
    assert apply(spark, samples.empty(spark), "").collect() == []


def test_top_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [9.0, 9.0]),
        (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, []), (100, []), (4, [-1.0, 0.5, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("v", F.lit("x"))
    got = [tuple(r) for r in topk.top(df, F.col("id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 1, 5 * 64 * 64), (0, 2, 2, 5 * 64 * 64), (0, 3, 2, 5 * 64 * 64), (100, 1, 0, 0), (100, 2, 1, 0), (100, 3, 2, 0),
    ]
    assert topk.top(df.limit(0), F.col("id") % 20 == 0).collect() == []


def test_defined_results(docs):
    quality = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert quality[1]["n_words"] == 0 and quality[1]["base_failed"] and not quality[1]["kept"]
    lang = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert lang[1] == lang[2] == lang[3] == "und"
    near = {(r["doc_id"], r["class_id"]) for r in near_duplicates.classes(docs).collect()}
    assert {(1, 1), (2, 1), (3, 1), (6, 6), (7, 6), (None, 6), (None, None)} <= near
    lines = {r["doc_id"]: r["text"] for r in line_dedup.remove(docs).collect()}
    assert lines[1] is None and lines[2] == ""
    assert all(r["same"] for r in pieces.encode(docs, PIECES).collect())


def test_every_text_of_a_repeated_id_is_compared(spark):
    rows = []
    for k in range(12):
        first, second = (samples.words(100, 100 * k + j, 10**6) for j in (1, 2))
        rows += [(1000 + k, first), (1000 + k, second), (2000 + k, second + " and more"), (10 + k, first + " or less")]
    rows += [(5, "one and the same text of a few words")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.classes(docs).collect()
    want = {1000 + k: {10 + k, 1000 + k} for k in range(12)}
    assert {r["class_id"] for r in got if 2000 <= r["doc_id"] < 2012} == {*range(1000, 1012)}
    assert all({r["class_id"] for r in got if r["doc_id"] == i} == c for i, c in want.items())
    kept = sorted((r["doc_id"], r["text"]) for r in near_duplicates.keep_one(docs).collect())
    stay = [(i, t) for i, t in rows if i < 1000] + [(i, t) for n, (i, t) in enumerate(rows) if 1000 <= i < 2000 and n % 4 == 1]
    assert kept == sorted(stay)

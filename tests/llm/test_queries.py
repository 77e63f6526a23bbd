"""The queries against their SQL, or against plain Python on the same small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import compare
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.samples import FOLDER, HAS_DATA
from tracklake.llm import queries
from tracklake.session import stage

pytestmark = pytest.mark.skipif(not HAS_DATA, reason="no test data")
LEAST = 400


@pytest.fixture(scope="module")
def rows(spark):
    return [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("name", queries.SQL)
def test_sql(spark, name):
    assert compare.difference(compare.oracle(FOLDER), spark, FOLDER, name, queries.QUERIES, queries.SQL) == ""


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_languages_of_held_out_documents(spark, rows):
    got = {r["doc_id"]: r for r in run(spark, "op2_language_filters")}
    assert all(got[r["doc_id"]]["held_out"] == held_out(r["doc_id"]) for r in rows)
    unseen = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows if held_out(r["doc_id"])]
    assert len(unseen) > 20 and np.mean(unseen) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_token_files_against_the_library(spark, rows):
    from tokenizers import Tokenizer

    tokenizer, at, want = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), 0, []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, run(spark, "op3_token_files"))) == want


def test_piece_counts_and_round_trip(spark, rows):
    got = {r["doc_id"]: r for r in run(spark, "op4_piece_paths")}
    assert len(got) == len(rows) and all(r["same"] for r in got.values())
    assert all(got[r["doc_id"]]["n_bytes"] == len((r["text"] or "").encode()) for r in rows)


def test_piece_paths_hand_on_the_ids(spark, tmp_path):
    """A short, a long and an empty text, written and read back: the ids are there and decode to the text."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    texts = ["A few words, then é and 日本語.", "some words that go on and on " * 700, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op4_piece_paths(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts):
        ids = np.frombuffer(got[k]["ids"], "<u4").tolist()
        assert len(ids) == got[k]["n_pieces"] and got[k]["same"]
        assert library.decode(ids) == text.rstrip() or library.decode(ids) == text


def brute_classes(rows, least=0.8):
    """Components of all pairs with a Jaccard similarity of the distinct five-word shingles."""
    sets, inverted = {}, defaultdict(list)
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", r["text"] or "") if x]
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
        for s in sets[r["doc_id"]]:
            inverted[s].append(r["doc_id"])
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for near in {(a, b) for ids in inverted.values() for a in ids for b in ids if a < b}:
        a, b = (sets[x] for x in near)
        if len(a & b) >= least * len(a | b):
            x, y = sorted(map(root, near))
            parent[y] = x
    return {d: root(d) for d in sets}


def test_near_duplicates_against_all_pairs(spark, rows):
    assert dict(map(tuple, run(spark, "op5_weighted_near_duplicates"))) == brute_classes(rows)


def test_toxicity_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in run(spark, "op7_string_kernel_toxicity")}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == held_out(d) for d, r in got.items())


def brute_repeats(rows):
    seen = defaultdict(int)
    for r in rows:
        b = (r["text"] or "").encode()
        for i in range(len(b) - LEAST + 1):
            seen[b[i : i + LEAST]] += 1
    out = []
    for r in rows:
        b = (r["text"] or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - LEAST + 1):
            if seen[b[i : i + LEAST]] > 1:
                gone[i : i + LEAST] = True
        gone = gone[:-1]
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((r["doc_id"], len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def test_repeats_against_all_strings(spark, rows):
    assert sorted(map(tuple, run(spark, "op9_suffix_repeats"))) == brute_repeats(rows)


def test_pipeline_stage_by_stage(spark, rows):
    """Each stage against plain Python on what the one before has left."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, FOLDER), "tried")
        after[name] = [r.asDict() for r in docs.collect()]
        assert name == "pieces" or docs.columns == columns
    known = [r for r in rows if re.search(r"[^\W\d_]", r["text"] or "")]
    assert {r["doc_id"] for r in after["language ID"]} == {r["doc_id"] for r in known}
    sites = defaultdict(set)
    for r in after["language ID"]:
        for line in r["text"].split("\n"):
            sites[line].add(r["source"])
    common = {x for x, s in sites.items() if len(s) >= 10 and len(x.strip(" ")) >= 20}
    for r, got in zip(*(sorted(after[n], key=lambda r: r["doc_id"]) for n in ("language ID", "line dedup"))):
        lines = r["text"].split("\n")
        rest = [x for x in lines if x not in common]
        size = lambda xs: sum(len(x.strip(" ")) for x in xs)
        assert got["text"] == ("\n".join(rest) if 2 * size(rest) >= size(lines) else r["text"])
    classes = brute_classes(after["line dedup"])
    assert {r["doc_id"] for r in after["near duplicates"]} == set(classes.values())
    kept = {r["doc_id"]: r["text"] for r in after["near duplicates"]}
    assert all(kept[r["doc_id"]] == r["text"] for r in after["mixing"])
    assert sorted(r["doc_id"] for r in after["pieces"]) == sorted(r["doc_id"] for r in after["mixing"])
    assert all(r["same"] and r["n_pieces"] * 4 == len(r["ids"]) for r in after["pieces"])

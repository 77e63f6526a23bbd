"""The parts of the methods, on arrays and strings alone."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import words
from tracklake.llm import mixing, near_duplicates, pieces, repeats, suffix_order, token_files, toxicity
from tracklake.llm.batches import Rolling, slices, word_bounds
from tracklake.llm.graph import components
from tracklake.llm.language import Filters

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))


def packed(texts):
    encoded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(encoded), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)


def test_rolling_hashes_follow_the_bytes():
    data, offsets = packed(["abc abd abc", "abc"])
    rolling = Rolling(1)
    starts, ends = word_bounds(data, offsets)
    h = rolling.of(rolling.prefix(data), starts, ends)
    assert h[0] == h[2] == h[3] != h[1]


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    ids = np.tile(rng.integers(0, 50, 700), 6).astype(np.uint32)
    ends = np.array([1, 900, 901, 2500, len(ids)])
    symbols, starts, rules, expanded = token_files.compress(ids, ends, 1000, rounds=6, least=4)
    assert len(symbols) < 0.6 * len(ids) and len(rules)
    assert (token_files.expand(symbols, rules, 1000) == ids).all()
    for a, b in ((0, 5), (899, 903), (17, 2400), (4199, 4200)):
        assert (token_files.token_range(symbols, rules, expanded, 1000, a, b) == ids[a:b]).all()
    for start, first in zip(starts, [0, *ends[:-1]]):
        assert token_files.expand(symbols[:start], rules, 1000).size == first


def frequent_pairs(symbols, starts):
    """Pairs within documents that stand twice or more, none reaching into the one before."""
    seen, bounds = {}, [*starts.tolist(), len(symbols)]
    for a, b in zip(bounds, bounds[1:]):
        own = {}
        for k, pair in enumerate(zip(symbols[a:b].tolist(), symbols[a + 1 : b].tolist())):
            if own.get(pair) != k - 1:
                own[pair], seen[pair] = k, seen.get(pair, 0) + 1
    return [p for p, n in seen.items() if n > 1]


@pytest.mark.parametrize("kind", ["copies", "runs", "random", "words"])
def test_repair_goes_on_until_no_pair_stands_twice(kind):
    rng = np.random.default_rng(8)
    ids = {
        "copies": np.concatenate([np.tile(rng.integers(0, 50, 700), 6), rng.integers(0, 1000, 300)]),
        "runs": np.repeat(rng.integers(0, 4, 60), rng.integers(1, 300, 60)),
        "random": rng.integers(0, 9, 5000),
        "words": rng.zipf(1.3, 20_000) % 1000,
    }[kind].astype(np.uint32)
    ends = np.unique(np.append(rng.integers(1, len(ids), 12), len(ids)))
    symbols, starts, rules, expanded = token_files.compress(ids, ends, 1000)
    assert frequent_pairs(symbols, starts) == []
    assert (token_files.expand(symbols, rules, 1000) == ids).all()
    sizes = np.array([len(token_files.expand(np.array([1000 + k]), rules, 1000)) for k in range(0, len(rules), 7)])
    assert (sizes == expanded[::7]).all()
    for a, b in rng.integers(0, len(ids), (20, 2)):
        a, b = sorted((int(a), int(b) + 1))
        assert (token_files.token_range(symbols, rules, expanded, 1000, a, b) == ids[a:b]).all()


def best_sum(vocabulary, text):
    """Largest sum of scores by the textbook recursion."""
    shown = (" " + text).replace(" ", pieces.BLANK)
    best = [0.0] + [float("-inf")] * len(shown)
    for end in range(1, len(shown) + 1):
        for start in range(max(0, end - vocabulary.reach), end):
            score = vocabulary.scores.get(shown[start:end], (0, vocabulary.unknown if end == start + 1 else float("-inf")))[1]
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def sum_of(vocabulary, ids):
    score = {i: s for i, s in vocabulary.scores.values()}
    total, left = 0.0, 0
    for i in ids:
        if i in score:
            total += score[i]
        elif left:
            left -= 1
        else:  # the first byte of a character
            byte = vocabulary.shown[i][0]
            left = 3 if byte >= 0xF0 else 2 if byte >= 0xE0 else 1 if byte >= 0xC0 else 0
            total += vocabulary.unknown
    return total


TEXTS = ["", " ", "the there  then", "a\nb 日本語 😀 \t", "nospacesinthislongword" * 5, "unbelievable " * 20 + "é ê"]


def test_best_paths_have_the_largest_sum():
    vocabulary = pieces.vocabulary(PIECES)
    data, offsets = packed(TEXTS)
    ids, at = vocabulary.encode(data, offsets, np.ones(len(TEXTS), bool))
    for i, text in enumerate(TEXTS):
        want = best_sum(vocabulary, text) if text else 0.0
        assert sum_of(vocabulary, ids[at[i] : at[i + 1]].tolist()) == want
    back, bounds = vocabulary.decode(ids, at, np.ones(len(TEXTS), bool))
    assert [back[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])] == TEXTS


@pytest.mark.parametrize("chunk", [16, 20, 50])
def test_chunks_cut_where_the_whole_path_cuts(chunk):
    vocabulary = pieces.vocabulary(PIECES)
    for text in TEXTS[2:]:
        shown = " " + text
        parts = [(shown[max(0, a - vocabulary.reach + 1) : a], shown[a : a + chunk]) for a in range(0, len(shown), chunk)]
        cuts = pieces.crossings([vocabulary.matrix(*p) for p in parts])
        enter = [0, *cuts[:-1]]
        own = [before[len(before) - e :] + t[: len(t) - leave] for (before, t), e, leave in zip(parts, enter, cuts)]
        assert "".join(own) == shown
        data, offsets = packed(own)
        ids, _ = vocabulary.encode(data, offsets, np.zeros(len(own), bool))
        assert sum_of(vocabulary, ids.tolist()) == best_sum(vocabulary, text)


def test_matrices_combine_associatively():
    vocabulary = pieces.vocabulary(PIECES)
    text = " the unbelievably longish sentence"
    a, b, c = (vocabulary.matrix(text[max(0, i - vocabulary.reach + 1) : i], text[i : i + 11]) for i in (0, 11, 22))
    left, right = pieces.combine(pieces.combine(a, b), c), pieces.combine(a, pieces.combine(b, c))
    assert np.array_equal(left, right)


def best_ids(vocabulary, text):
    """Ids of the best path by the textbook recursion; of equal paths the one with the longer last piece, from the end."""
    shown = (" " + text).replace(" ", pieces.BLANK)
    none = (None, float("-inf"))
    best, start = [0.0] + [float("-inf")] * len(shown), [0] * (len(shown) + 1)
    for end in range(1, len(shown) + 1):
        for at in range(max(0, end - vocabulary.reach), end):
            score = vocabulary.scores.get(shown[at:end], (0, vocabulary.unknown) if end == at + 1 else none)[1]
            if best[at] + score > best[end]:
                best[end], start[end] = best[at] + score, at
    out, end = [], len(shown)
    while end:
        piece = shown[start[end] : end]
        known = vocabulary.scores.get(piece)
        out.append([known[0]] if known else vocabulary.byte_ids[list(piece.encode())].tolist())
        end = start[end]
    return [i for ids in reversed(out) for i in ids]


def digest(ids):
    return sum((k + 1) * i for k, i in enumerate(ids)) % pieces.PRIME


LONG = [words(700, 9), "unbelievably longish sentences, " * 150 + "é 日本語", "ab " * 5 + words(3, 1), "", None]


@pytest.mark.parametrize("group", [3, 64])
def test_long_documents_have_the_textbook_path(spark, group):
    vocabulary = pieces.vocabulary(PIECES)
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pieces.encode(docs, PIECES, chunk=40, with_ids=True, group=group).collect()}
    for k, text in enumerate(LONG):
        want = best_ids(vocabulary, text) if text else []
        assert np.frombuffer(got[k]["ids"], "<u4").tolist() == want
        assert (got[k]["n_pieces"], got[k]["digest"], got[k]["same"]) == (len(want), digest(want), True)


@pytest.mark.parametrize("group", [3, 64])
def test_words_across_many_chunks_have_the_largest_sum(spark, group):
    vocabulary = pieces.vocabulary(PIECES)
    rng = random.Random(4)
    texts = ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (39, 40, 41, 600, 2500)] + ["nospaces" * 200, "aaaa" * 100, " " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pieces.encode(docs, PIECES, chunk=40, with_ids=True, group=group).collect()}
    for k, text in enumerate(texts):
        ids = np.frombuffer(got[k]["ids"], "<u4").tolist()
        assert got[k]["same"] and sum_of(vocabulary, ids) == best_sum(vocabulary, text)
        assert (got[k]["n_pieces"], got[k]["digest"]) == (len(ids), digest(ids))


def test_suffix_order(spark):
    rng = random.Random(5)
    strings = {s: [rng.randrange(3) for _ in range(rng.randrange(1, 40))] for s in range(30)}
    strings[30] = strings[3]
    rows = [(s, 1, k, x, 1) for s, string in strings.items() for k, x in enumerate(string)]
    df = spark.createDataFrame(rows, "str long, half long, k long, sym long, len long")
    got = sorted((r["rank"], strings[r["str"]][r["k"] :]) for r in suffix_order.ranks(df, 1000).collect())
    assert [s for _, s in got] == sorted(s for _, s in got)
    assert all((a[0] == b[0]) == (a[1] == b[1]) for a, b in zip(got, got[1:]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (300, 50), (50, 7), (9, 9)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(41)) and got[102] == got[101] == 100 and got[300] == 0


def test_poisson_counts_follow_their_mean(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    got = {(r["source"], r["n"]): r["count"] for r in mixing.copies(docs, weights={"a": 3.0, "b": 1.0}).withColumn("source", F.col("row.source")).groupBy("source", F.col("n_copies").alias("n")).count().collect()}
    for source, rows, mean in (("a", 5000, 3.0), ("b", 15_000, 1 / 3)):
        p = [np.exp(-mean) * mean**k / float(np.prod(np.arange(1, k + 1))) for k in range(8)]
        assert all(abs(got.get((source, k), 0) / rows - p[k]) < 0.02 for k in range(8))


def test_large_means_are_split(spark):
    docs = spark.createDataFrame([(i, "t", "a" if i else "b") for i in range(200)], "doc_id long, text string, source string")
    got = mixing.copies(docs, weights={"a": 1e-9, "b": 1.0}, copies_per_row=5.0).where("id = 0").first()
    assert abs(got["n_copies"] - 1000) < 200


def test_samples_agree_as_often_as_sets_are_similar():
    sampler = near_duplicates.Sampler(np.full(1 << near_duplicates.BUCKET_BITS, 2000.0))
    both, seen = [], []
    for seed in range(150):
        a = words(200, seed, 10**6).split()
        b = a[:150] + words(50, seed + 1000, 10**6).split()
        data, offsets = packed([" ".join(a), " ".join(b)])
        h, bounds, _ = near_duplicates.shingles(sampler.rolling, data, offsets)
        keys, weight, at = sampler.weighted(h, bounds, sampler.sampled)
        _, each = sampler.samples(keys, weight, at)
        both.append((each[0] == each[1]).mean())
        seen.append(near_duplicates.similarity(keys[: at[1]], weight[: at[1]], keys[at[1] :], weight[at[1] :]))
    assert abs(np.mean(both) - np.mean(seen)) < 0.03


def test_bloom_slices_name_all_languages():
    rows = [(g, "x") for g in range(5000)] + [(g, "y") for g in range(2500, 7500)]
    filters = Filters(rows, {"x": 2, "y": 1})
    grams = np.array([0, 3000, 7000, 10**6])
    shares = filters.shares(grams, np.arange(5))
    assert (shares[:3] > 0.99).tolist() == [[True, False], [True, True], [False, True]] and shares[3].max() == 0


def test_kernel_tolerates_gaps_and_inserted_letters():
    texts = [f"{words(8, i)} you are an idiot {words(4, -i)}" for i in range(60)] + [f"{words(8, 999 + i)} you are a friend {words(4, -i)}" for i in range(60)]
    machine = toxicity.fit(texts, np.array([True] * 60 + [False] * 60), 0.5)
    tried = ["what an id-iot he is", "what an i d i o t he is", "what an idxiot he is", "what a friend he is"]
    scores = machine.documents(*packed(tried))
    assert scores[:3].min() > scores[3] + 0.2


def test_repeats_after_16_mib_of_one_text(spark):
    rng = np.random.default_rng(7)
    letters = lambda n: (rng.integers(0, 26, n, dtype=np.uint8) + 97).tobytes().decode()
    again, size = letters(500), (16 << 20) + 5000
    text = letters(size) + again + letters(3000) + again + letters(2000)
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeats.without_repeats(docs).drop("kept").collect()}
    assert (got[1]["n_bytes"], got[1]["n_removed"], got[1]["n_spans"], got[2]["n_removed"]) == (len(text), 1000, 2, 0)


def test_least_hashes_of_windows():
    rng = np.random.default_rng(8)
    for n in (repeats.WINDOW, 1000, 5003):
        grams = rng.integers(0, 50, n, dtype=np.uint64)  # with ties
        starts = np.arange(n - repeats.WINDOW + 1)
        want = [i + int(np.argmin(grams[i : i + repeats.WINDOW])) for i in starts]
        assert repeats.leftmost_least(grams, starts).tolist() == want


def test_anchors_of_a_slice_of_many_texts_take_little_memory():
    """Four megabytes of texts: no more than a slice's numbers are held at once, and each start has its window's anchor."""
    rng = np.random.default_rng(9)
    texts = ["".join(map(chr, rng.integers(97, 101, n))) for n in (0, 399, 400, 2000, *[5000] * 800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["rid", "text"])
    hashes, seen = repeats.Hashes(), 0
    hashes.first.prefix(np.zeros(1, np.uint8))  # its tables
    tracemalloc.start()
    for _, data, offsets in slices([batch], 1, repeats.SLICE):
        a = repeats.Anchors(hashes, data, offsets, repeats.LEAST)
        seen += len(a.starts)
        if seen < 10_000:
            grams = hashes.first.of(a.prefix, np.arange(len(data) - 15), np.arange(16, len(data) + 1))
            assert hashes.first.grams(a.prefix, 16).tolist() == grams.tolist()
            assert a.at[a.of_start].tolist() == repeats.leftmost_least(grams, a.starts).tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == sum(max(0, len(t) - repeats.LEAST + 1) for t in texts)
    assert peak < 64 << 20


def test_samples_in_a_group_of_a_third_follow_the_deciding_similarity():
    own, bits = near_duplicates.Rolling(23), 64 - near_duplicates.BUCKET_BITS
    agreed, decided = [], []
    for seed in range(60):
        base = words(400, seed, 10**6).split()
        data, offsets = packed([" ".join(base), " ".join(base[:361] + words(39, seed + 1000, 10**6).split())])
        h, bounds, _ = near_duplicates.shingles(own, data, offsets)
        rarity = np.full(1 << near_duplicates.BUCKET_BITS, 2.0**20 / 400)
        rarity[(np.intersect1d(h[: bounds[1]], h[bounds[1] :]) >> np.uint64(bits)).astype(np.int64)] = 3
        sampler = near_duplicates.Sampler(rarity)
        keys, weight, at = sampler.weighted(h, bounds, sampler.sampled)
        _, each = sampler.samples(keys, weight, at)
        agreed.append((each[0] == each[1]).mean())
        weight = sampler.weighted(h, bounds, sampler.compared)[1]
        decided.append(near_duplicates.similarity(keys[: at[1]], weight[: at[1]], keys[at[1] :], weight[at[1] :]))
    assert 0.74 < np.mean(decided) < 0.84 and abs(np.mean(agreed) - np.mean(decided)) < 0.03


def test_values_are_found_whatever_slots_they_share(monkeypatch):
    rng = np.random.default_rng(9)
    for bits in (18, 4):  # with sixteen slots most numbers go to a later table
        monkeypatch.setattr(token_files, "SLOT_BITS", bits, raising=False)
        found = np.unique(rng.integers(0, 500, 200, dtype=np.uint64) << np.uint64(32) | np.uint64(7))
        values = rng.integers(0, 600, 5000, dtype=np.uint64) << np.uint64(32) | np.uint64(7)
        at, place = token_files.places_of(found, values)
        assert np.array_equal(np.sort(at), np.flatnonzero(np.isin(values, found)))
        assert np.array_equal(found[place], values[at])
    assert [len(x) for x in token_files.places_of(found[:0], values)] == [0, 0]


def test_taken_places_are_heavier_than_their_neighbours():
    weight = np.array([0, 3, 3, 5, 1, 0, 2, 2, 2, 2, 0, 0, 9])
    assert np.flatnonzero(token_files.without_overlaps(weight)).tolist() == [1, 3, 6, 8, 12]
    assert not token_files.without_overlaps(weight[:1]).any()

"""Operators on vectors and the ranked search against plain Python, on odd rows too."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import samples
from tracklake.llm import hard_negatives, lexical, topk, vector_links

SCHEMA = "vec_id long, embedding array<float>, label int, id string, e string, n string, v string, list string, score string"
NAN, INF = float("nan"), float("inf")


def rows(seed=0, n=240, width=12):
    """Clusters with near and exact copies, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    out = []
    for i in range(n):
        x = centres[i % 6] + rng.normal(size=width) * (0.02 if i % 3 else 0.4)
        out.append([i, [float(v) for v in x.astype(np.float32)], i % 4])
    out += [[n + i, list(out[7][1]), 1] for i in range(40)]
    out += [[5, list(out[5][1]), 1], [5, list(out[5][1]), 1], [5, list(out[9][1]), 2], [None, list(out[5][1]), 1], [300, list(out[5][1]), None]]
    out += [[400, None, 1], [401, [], 2], [402, [0.0] * width, 3], [403, [NAN] * width, 1], [404, [INF, 1.0], 1], [405, [None, 1.0], 1], [406, [1.0, 2.0], 0]]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in data], SCHEMA)


def good(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def test_subset_sums_and_bit_planes():
    rng = np.random.default_rng(1)
    for most, width in ((3, 1), (200, 13), (10**9, 64), (1, 8)):
        x, a = rng.integers(-most, most + 1, (50, width)), rng.integers(-most, most + 1, (7, width))
        assert (hard_negatives.scores(hard_negatives.tables_of(a), hard_negatives.planes_of(x)) == x @ a.T).all()
    assert (hard_negatives.scores(hard_negatives.tables_of(a[:, :3]), hard_negatives.planes_of(x)) == x[:, :3] @ a[:, :3].T).all()


def brute_negatives(data, every):
    own = [(i, lab, [math.floor(256 * v) for v in x]) for i, x, lab in data if i is not None and lab is not None and good(x)]
    out = Counter()
    for a_id, a_label, a in {(i, lab, tuple(x)) for i, lab, x in own if i % every == 0}:
        scored = sorted(((-inner(a, x), i, lab) for i, lab, x in own if i != a_id), key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == a_label][:5]:
            fit = [r for r in scored if r[2] != a_label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out.update((a_id, p, k, r[1], -s, -r[0]) for k, r in enumerate(fit, 1))
    return out


def test_hard_negatives_of_odd_rows(spark):
    got = hard_negatives.mine(frame(spark, rows()), F.col("id") % 5 == 0)
    assert Counter(tuple(r)[:6] for r in got.collect()) == brute_negatives(rows(), 5)
    assert hard_negatives.mine(frame(spark, []), F.col("id") % 5 == 0).collect() == []


def brute_links(data, least):
    own = [np.array(x, float) if good(x) and any(x) else None for _, x, _ in data]
    width = max(len(x) for x in own if x is not None)
    own = [None if x is None else np.pad(x, (0, width - len(x))) for x in own]
    n, parent = [0] * len(data), list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(own):
        for j, y in enumerate(own[:i]):
            if x is not None and y is not None and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                n[i], n[j] = n[i] + 1, n[j] + 1
                parent[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(data):
        ids.setdefault(root(i), []).append(r[0])
    of = [min((k for k in ids[root(i)] if k is not None), default=None) for i in range(len(data))]
    return Counter((r[0], n[i], of[i], r[0] == of[i]) for i, r in enumerate(data))


@pytest.mark.parametrize("part, in_ball", [(4096, 16), (16, 1000), (16, 4)])
def test_links_of_odd_rows(spark, monkeypatch, part, in_ball):
    """Large and small parts, with and without balls, several lists."""
    for name, value in (("PART", part), ("LEAST_IN_BALL", in_ball), ("PER_LIST", 40)):
        monkeypatch.setattr(vector_links, name, value)
    got = vector_links.classes(frame(spark, rows()))
    assert Counter(map(tuple, got.collect())) == brute_links(rows(), 0.95)


def test_links_of_no_rows(spark):
    assert vector_links.classes(frame(spark, [])).collect() == []
    only = vector_links.classes(frame(spark, [[1, None, 1], [2, [0.0], 1]])).collect()
    assert sorted(map(tuple, only)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_planted_copies_of_64_dimensions_are_found():
    """Recall of the probes alone, with cosines from 0.95 on: lists of either that the other looks into."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    index = vector_links.Index(x[:4096], 60_000, 64, 0.95)
    (hx, _, _, px), (hy, codes, rest, py) = index.encode(x), index.encode(y)
    found = px[np.arange(6000), hy] | py[np.arange(6000), hx]
    assert len(index.centres) > 100 and found.mean() > 0.999 and px.mean() < 0.2
    # The codes alone rule out no linked pair.
    left = y - index.centre(hy) - np.concatenate([w[codes[:, g]] for g, w in enumerate(index.words)], axis=1)
    assert np.allclose(np.sqrt((left**2).sum(axis=1)), rest)


def test_fewer_scores_than_pairs():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8))
    centres *= 900 / np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.floor(centres[np.arange(6000) % 20] + rng.normal(size=(6000, 8)) * 5).astype(np.int64)
    largest = float((x**2).sum(1).max())
    search = topk.Search(topk.Pivots(np.arange(0, 6000, 3), x[::3], largest), np.arange(6000), x)
    row, ids, scores = search.best(np.arange(100), x[:100], 5)
    assert search.evaluated < 0.5 * 100 * 6000
    full = x[:100] @ x.T
    for q in range(100):
        want = sorted((-int(s), i) for i, s in enumerate(full[q]) if i != q)[:5]
        assert sorted(zip((-scores[row == q]).tolist(), ids[row == q].tolist())) == want


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total = len(own), sum(size for _, _, size in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = Counter()
    for item_id, text in set(items):
        found = []
        for doc_id, c, size in own:
            m = 10 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            found += [(-score, doc_id is None, doc_id)] if score > 0 else []
        found.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out.update((item_id, rank, doc_id, -s) for rank, (s, _, doc_id) in enumerate(found[:k], 1))
    return out


ITEMS = [(1, samples.words(12, 1)), (1, samples.words(12, 1)), (1, "b7 É x1"), (2, None), (3, "?! "), (4, "É 日本語 A A a"), (5, "nowhere"), (None, samples.words(5, 2))]


@pytest.mark.parametrize("block, leaf, chunk", [(4096, 8, 1 << 22), (5, 1, 50)])
def test_search_of_odd_rows(spark, monkeypatch, block, leaf, chunk):
    for name, value in (("BLOCK_DOCS", block), ("LEAF", leaf), ("CHUNK", chunk)):
        monkeypatch.setattr(lexical, name, value)
    more = [(100 + i, samples.words(30 + i % 7, i, 40), "en", "s", 0) for i in range(60)] + [(300 + i, samples.words(30, 3, 40), "en", "s", 0) for i in range(30)]
    docs = samples.odd(spark).unionByName(spark.createDataFrame(more, samples.SCHEMA), allowMissingColumns=True)
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, score string")
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(docs, items).collect())
    assert got == brute_search([r[:2] for r in samples.odd_rows() + more], ITEMS, 10)
    assert lexical.search(samples.empty(spark), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []


def test_tries_leave_documents_out():
    rng = np.random.default_rng(7)
    n, size = 3000, 400
    own = [np.sort(rng.choice(size, rng.integers(5, 40), replace=False, p=np.arange(size, 0, -1) / (size * (size + 1) / 2))) for _ in range(n)]
    counts, lengths = [rng.integers(1, 6, len(t)) for t in own], rng.integers(20, 400, n)
    df = np.bincount(np.concatenate(own), minlength=size)
    items = lexical.Items([np.sort(rng.choice(size, 4, replace=False)) for _ in range(30)], df, n, int(lengths.sum()), 10)
    best = lexical.Best(30, 10)
    trie = lexical.Trie(items, np.arange(n), np.ones(n, bool), lengths, own, counts)
    assert trie.search(items, best) < 0.8 * 30 * n
    m = items.length_norm(lengths)
    for item in range(30):
        entry = items.item == item
        scores = []
        for d in range(n):
            tf = dict(zip(own[d].tolist(), counts[d].tolist()))
            scores.append((-sum(int(w) * (10**9 * tf[t] // (1000 * tf[t] + 8 * int(m[d]))) for t, w in zip(items.term[entry].tolist(), items.weight[entry]) if t in tf), d))
        want = [(-s, d) for s, d in sorted(scores)[:10] if s < 0]
        assert [(int(s), int(d)) for s, d in zip(best.scores[item], best.ids[item]) if s > 0] == want

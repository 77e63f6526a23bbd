"""Blocks of a large bucket hand on a pair per document, with the same components as all links."""

import numpy as np
import pytest

from tracklake.llm import near_duplicates as near
from tracklake.llm.graph import components


def of_pairs(docs, pairs):
    """The least document that each one is reached from."""
    label = {d: d for d in docs}
    while True:
        now = dict(label)
        for a, b in pairs:
            now[a] = now[b] = min(now[a], now[b])
        if now == label:
            return label
        label = now


def block(rng, first, n, families):
    """Documents of which those of a family share most shingles, and each lacks some."""
    sets = []
    for d in range(first, first + n):
        base = np.arange(40, dtype=np.uint64) + np.uint64(1000 * (d % families))
        sets.append(np.sort(base[rng.random(40) < 0.93]))
    weights = [(1 + (s % np.uint64(7)).astype(np.float32) / 8).astype(np.float32) for s in sets]
    samples = np.repeat(np.arange(first, first + n, dtype=np.int32)[:, None] % families, near.ROWS * near.BANDS, 1)
    return np.arange(first, first + n), samples, sets, weights


@pytest.mark.parametrize("same", [True, False])
def test_tied_documents_make_the_components_of_all_links(same):
    rng = np.random.default_rng(3)
    x = block(rng, 0, 60, 5)
    y = x if same else block(rng, 40, 60, 5)
    links = [
        (int(a), int(b)) for a, ak, aw in zip(x[0], *x[2:]) for b, bk, bw in zip(y[0], *y[2:])
        if a % 5 == b % 5 and a != b and near.similarity(ak, aw, bk, bw) >= 0.8
    ]
    docs = sorted({*x[0].tolist(), *y[0].tolist()})
    a, b = near.tied(x, y, 0.8, same)
    assert of_pairs(docs, zip(a.tolist(), b.tolist())) == of_pairs(docs, links)
    assert 0 < len(a) < len(docs) < len(links)


def test_a_bucket_of_near_copies_hands_on_a_pair_per_document(spark):
    """A hundred documents that are all linked: 4,950 links, of which 99 are enough."""
    docs, samples, sets, weights = block(np.random.default_rng(4), 0, 100, 1)
    sets, weights = [sets[0]] * 100, [weights[0]] * 100
    rows = [(int(d), s.tolist(), k.tobytes(), w.tobytes(), 12 * len(k)) for d, s, k, w in zip(docs, samples, sets, weights)]
    stored = spark.createDataFrame(rows, "doc long, samples array<int>, keys binary, weights binary, size long")
    members = stored.selectExpr("1L as key", "doc")
    tied = near.linked_blocks(members, members, stored.select("doc", "samples"), stored.drop("samples"), 0.8)
    assert tied.count() == 99
    assert {r["component"] for r in components(tied).collect()} == {0}
    apart = members.where("doc >= 50")
    tied = near.linked_blocks(members, apart, stored.select("doc", "samples"), stored.drop("samples"), 0.8)
    assert {tuple(r) for r in tied.collect()} == {(0, d) for d in range(1, 100)}


def test_a_large_bucket_without_a_common_sample_has_a_pivot(spark):
    """300 members that agree in nothing but their band: no sample stands out, and the least member is the pivot."""
    n = near.ROWS * near.BANDS
    samples = spark.range(300).selectExpr("id + 7 as doc", f"transform(sequence(0, {n - 1}), k -> cast(id * {n} + k as int)) as samples")
    members = samples.selectExpr("1L as key", "doc")
    assert [tuple(r) for r in near.pivots_of(members, samples).collect()] == [(1, 7)]

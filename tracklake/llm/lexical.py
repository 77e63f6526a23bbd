"""Ranked lexical search: the best documents of each item, found by branch and bound in tries of documents.

Terms are the stretches of letters, digits and bytes beyond ASCII, A-Z lower-cased. A document is seen as its vector
of term counts, restricted to the terms of the items; one pass over the texts writes these vectors. Terms are put in the
order of their document frequency, and the vectors of a block of documents into a trie, in which vectors with the
same frequent terms share a path. Each node holds, for its subtree, the greatest count of each term, the smallest m
and the smallest id. As a term's part in a score grows with its count and falls with m, they give an upper bound of the
scores below the node. The trie is searched depth first, for each item down to the nodes whose bound
reaches its k-th best score so far; the documents there are scored exactly, in whole numbers. A task keeps the best k of
each item from block to block and hands on these.

Items are taken in blocks of at most ITEM_TERMS terms, each a pass over the documents, so what is broadcast has that bound.

Defined results: null texts have no terms; documents without terms count for nothing. Items without terms, and items that share
no term with a document, have no rows. Rows that repeat item and text are one item; items with one id and different texts are
ranked apart. Rows that repeat a document are documents each. Equal scores go by the smaller id, null ids last. A very long
text is counted in chunks. Sums must fit a long. An empty table gives an empty result.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.session import stage

K = 10
ITEM_TERMS = 1 << 20
CHUNK = 1 << 22
BLOCK_DOCS, BLOCK_TERMS = 4096, 1 << 20
LEAF = 8
NODE_CELLS = 1 << 24
NO_ID = np.iinfo(np.int64).max
# Lower-cases A-Z and makes a space of every byte that is in no term.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: bytes):
    """Lists of the terms of a text, chunk by chunk."""
    text, at = text.translate(TERM_BYTES), 0
    while at < len(text):
        end = len(text)
        if end - at > CHUNK:
            end = text.find(b" ", at + CHUNK)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def bytes_of(column: pa.Array):
    return (c.as_buffer().to_pybytes() if c.is_valid else b"" for c in column)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms) with distinct terms in order."""

    def run(batches):
        for batch in batches:
            terms = [sorted({w for words in words_of(t) for w in words}) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(run, f"item_id {kind}, terms array<binary>")


def counted(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts): the number of all terms, and the counts of those in the vocabulary."""

    def run(batches):
        place = vocabulary.value.get
        for batch in batches:
            n, terms, counts, bounds = [], [], [], [0]
            for text in bytes_of(batch.column(1)):
                own, total = Counter(), 0
                for words in words_of(text):
                    total += len(words)
                    own.update(map(place, words))
                own.pop(None, None)
                n.append(total)
                terms.extend(own.keys())
                counts.extend(own.values())
                bounds.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents with each term; a task adds up its own, and a term is one row per task."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["term", "df"])

    found = vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    return df


class Items:
    """Terms of the items as entries (item, term, weight), and the order of terms by frequency."""

    def __init__(self, terms: list[np.ndarray], df: np.ndarray, n_docs: int, n_terms: int, k: int):
        self.k, self.n, self.n_docs, self.n_terms = k, len(terms), n_docs, n_terms
        self.item = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        self.term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
        self.weight = np.array(weights, np.int64)[self.term] if len(self.term) else np.zeros(0, np.int64)
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))

    def length_norm(self, n: np.ndarray) -> np.ndarray:
        return 100 - 90 + (90 * n * self.n_docs) // max(self.n_terms, 1)


def part(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Best:
    """The best k documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.scores = np.zeros((items, k), np.int64)
        self.ids = np.full((items, k), NO_ID)
        self.known = np.zeros((items, k), bool)

    def reached(self, which: np.ndarray, bound: np.ndarray, least_id: int) -> np.ndarray:
        floor = self.scores[which, -1]
        return (bound > floor) | ((bound == floor) & (bound > 0) & (least_id < self.ids[which, -1]))

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        some = (scores >= np.maximum(self.scores[which, -1], 1)[:, None]).any(axis=1)
        which, scores = which[some], scores[some]
        s = np.concatenate([self.scores[which], scores], axis=1)
        i = np.concatenate([self.ids[which], np.broadcast_to(ids, scores.shape)], axis=1)
        known = np.concatenate([self.known[which], np.broadcast_to(known, scores.shape)], axis=1)
        # Places that are still open have score 0 and stand last.
        order = np.lexsort((~known, i, -s), axis=1)[:, : self.scores.shape[1]]
        for name, values in (("scores", s), ("ids", i), ("known", known)):
            getattr(self, name)[which] = np.take_along_axis(values, order, axis=1)


class Trie:
    """Documents of a block in the order of their paths; a node is a range of them."""

    def __init__(self, items: Items, ids, known, n, terms: list[np.ndarray], counts: list[np.ndarray]):
        by_rank = [np.argsort(items.rank[t]) for t in terms]
        paths = [items.rank[t[o]].astype(">u4") for t, o in zip(terms, by_rank)]
        keys = [p.tobytes() for p in paths]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.ids, self.known = ids[order], known[order]
        self.m = items.length_norm(n[order])
        paths = [paths[d] for d in order]
        shared = [self._shared(a, b) for a, b in zip(paths[:-1], paths[1:])]
        columns, place = np.unique(np.concatenate([terms[d] for d in order]), return_inverse=True)
        self.columns, self.place, self.count = columns, place, np.concatenate([counts[d] for d in order]).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum([len(terms[d]) for d in order])])
        self._grow(np.array([0, *shared], np.int64))

    @staticmethod
    def _shared(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        other = a[:n] != b[:n]
        return int(other.argmax()) if other.any() else n

    def dense(self, first: int, last: int) -> np.ndarray:
        """Counts (document, column)."""
        out = np.zeros((last - first, len(self.columns)), np.int64)
        cut = slice(self.at[first], self.at[last])
        out[np.repeat(np.arange(last - first), np.diff(self.at[first : last + 1])), self.place[cut]] = self.count[cut]
        return out

    def _grow(self, shared: np.ndarray) -> None:
        """Nodes in the order of a depth-first walk, each with its range, where its subtree ends, and its maxima."""
        docs = len(self.ids)
        leaf = max(LEAF, docs * len(self.columns) // NODE_CELLS + 1)
        todo, ranges, parents = [(0, docs, -1)], [], []
        while todo:
            first, last, parent = todo.pop()
            me = len(ranges)
            ranges.append((first, last))
            parents.append(parent)
            if last - first <= leaf:
                continue
            inner = shared[first + 1 : last]
            cuts = [first, *(np.flatnonzero(inner == inner.min()) + first + 1).tolist(), last]
            # Neighbouring small branches share a leaf.
            merged = [cuts[0]]
            for a, b in zip(cuts[1:-1], cuts[2:]):
                if b - merged[-1] > leaf:
                    merged.append(a)
            merged.append(last)
            merged = sorted(set(merged))
            if len(merged) == 2:
                merged = [first, (first + last) // 2, last]
            todo.extend((a, b, me) for a, b in zip(merged[-2::-1], merged[:0:-1]))
        self.ranges, nodes = ranges, len(ranges)
        self.most = np.zeros((nodes, len(self.columns)), np.int32)
        self.least_m, self.least_id = np.full(nodes, NO_ID), np.full(nodes, NO_ID)
        self.leaf, self.end = np.ones(nodes, bool), np.arange(1, nodes + 1)
        self.leaf[[p for p in parents if p >= 0]] = False
        for me in range(nodes - 1, -1, -1):
            if self.leaf[me]:
                first, last = ranges[me]
                cut = slice(self.at[first], self.at[last])
                np.maximum.at(self.most[me], self.place[cut], self.count[cut].astype(np.int32))
                self.least_m[me], self.least_id[me] = self.m[first:last].min(), self.ids[first:last].min()
            up = parents[me]
            if up >= 0:
                np.maximum(self.most[up], self.most[me], out=self.most[up])
                self.least_m[up] = min(self.least_m[up], self.least_m[me])
                self.least_id[up] = min(self.least_id[up], self.least_id[me])
                self.end[up] = max(self.end[up], self.end[me])

    def search(self, items: Items, best: Best) -> int:
        """Adds what is found to best; the number of scored pairs of item and document."""
        place = np.searchsorted(self.columns, items.term)
        here = place < len(self.columns)
        here[here] = self.columns[place[here]] == items.term[here]
        item, place, weight = items.item[here], place[here], items.weight[here]
        evaluated, node, left_at = 0, 0, [(0, len(self.ranges), item, place, weight)]
        while left_at:
            node, end, item, place, weight = left_at.pop()
            while node < end:
                if not len(item):
                    break
                # Entries are in the order of items, so that each item's are one stretch.
                starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
                which = item[starts]
                values = part(self.most[node, place].astype(np.int64), self.least_m[node]) * weight
                reached = best.reached(which, np.add.reduceat(values, starts), self.least_id[node])
                if not reached.any():
                    node = self.end[node]
                    continue
                stays = np.repeat(reached, np.diff(np.append(starts, len(item))))
                own = (item[stays], place[stays], weight[stays])
                if not self.leaf[node]:
                    left_at.append((self.end[node], end, item, place, weight))
                    node, end, item, place, weight = node + 1, self.end[node], *own
                    continue
                first, last = self.ranges[node]
                starts = np.flatnonzero(np.concatenate([[True], own[0][1:] != own[0][:-1]]))
                values = part(self.dense(first, last)[:, own[1]], self.m[first:last, None]) * own[2]
                found = np.add.reduceat(values, starts, axis=1).T
                best.add(own[0][starts], found, self.ids[first:last], self.known[first:last])
                evaluated += found.size
                node += 1
        return evaluated


def searched(vectors: DataFrame, items) -> DataFrame:
    """(item, doc_id, score) of the best documents of each item in a task."""

    def run(batches):
        own = items.value
        best, held, size = Best(own.n, own.k), [], 0

        def search():
            ids, known, n, terms, counts = zip(*held)
            Trie(own, np.array(ids), np.array(known), np.array(n), list(terms), list(counts)).search(own, best)

        for batch in batches:
            bounds, terms, counts = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            for row, (doc_id, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                cut = slice(bounds[row], bounds[row + 1])
                if cut.start == cut.stop:
                    continue
                held.append((NO_ID if doc_id is None else doc_id, doc_id is not None, n, terms[cut], counts[cut]))
                size += cut.stop - cut.start
                if len(held) == BLOCK_DOCS or size > BLOCK_TERMS:
                    search()
                    held, size = [], 0
        if held:
            search()
        item, place = np.nonzero(best.scores > 0)
        ids = pa.array(best.ids[item, place], mask=~best.known[item, place])
        yield pa.RecordBatch.from_arrays([pa.array(item), ids, pa.array(best.scores[item, place])], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, doc_id long, score long")


def search_block(docs: DataFrame, terms: list[list[bytes]], k: int) -> DataFrame:
    """(item, doc_id, score, rank) for items given as lists of terms, numbered from 0."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in terms for t in own}))}
    vectors = stage(counted(docs, spark.sparkContext.broadcast(vocabulary)), "term-vectors")
    n_docs, n_terms = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = document_frequencies(vectors, len(vocabulary))
    places = [np.array(sorted(vocabulary[t] for t in own), np.int64) for own in terms]
    items = spark.sparkContext.broadcast(Items(places, df, n_docs, n_terms or 0, k))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return searched(vectors, items).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id="doc_id", text="text", item_id="item_id", item_text="text") -> DataFrame:
    """(item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    asked = items.select(items[item_id].alias("item_id"), items[item_text].alias("text")).distinct()
    # Numbered when written; the numbers of a block are those of its rows.
    asked = stage(item_terms(asked).where(F.size("terms") > 0).withColumn("number", F.monotonically_increasing_id()), "items")
    total = asked.agg(F.sum(F.size("terms").cast("long"))).first()[0] or 0
    blocks = max(-(-total // ITEM_TERMS), 1)
    results = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).orderBy("number").collect()
        numbers = spark.createDataFrame([(i, r["number"]) for i, r in enumerate(rows)], "item long, number long")
        found = search_block(own, [[bytes(t) for t in r["terms"]] for r in rows], k)
        named = found.join(numbers, "item").join(asked.select("number", "item_id"), "number")
        results.append(named.select("item_id", "rank", "doc_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out

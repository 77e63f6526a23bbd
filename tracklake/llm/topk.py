"""Exact top-k by inner product, with candidates ruled out by distances to pivots.

Each component x becomes floor(64 * x). With M the largest norm, a candidate v is seen as
(v, sqrt(M^2 - |v|^2)) and a query q as (q, 0); the inner product is then large where the distance is
small. Distances to all pivots are computed once per vector. By the triangle inequality the largest
difference of two vectors' distances to a pivot is a lower bound of their distance, which gives
an upper bound of the score.

A query starts with a floor: its k-th best score among the vectors of a bounded sample, whose members are candidates
too. A grid of tasks holds groups of candidates against groups of queries. In a task, candidates are ordered by their nearest
pivot and cut into blocks, for which the least and the greatest distance to each pivot bound all
their scores. Queries go through the blocks in the order of the bounds, and leave out those below their floor; in the
others only candidates whose own bound reaches a floor are evaluated, exactly. The floor rises with the best k
found; what is below it cannot enter the result. Pivots and sample change the work, not the result.

Defined results: vectors that are null, or hold null or non-finite components, and rows with a null id
take no part. Missing components of shorter vectors count as 0. A candidate with the id of the
query is the query's own. Rows that repeat id and vector are one query, but each is a candidate.
Sums must fit a long. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.vectors import floored, in_grid, matrix, usable
from tracklake.session import stage

SCALE = 64
PIVOTS, SAMPLE = 16, 2048
QUERY_BLOCK, BLOCK = 256, 512
# Candidates of a task are evaluated as they come where more than this share of a block stays.
MOST_STAY = 0.7


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    own = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[embedding].alias("e"))
    return own.where(F.col("id").isNotNull() & usable(F.col("e"))).select("id", floored(F.col("e"), SCALE).alias("v"))


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, max(width - x.shape[1], 0))))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products (q, c) of whole numbers, exact."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**52:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


class Pivots:
    """Pivots, and the sample that gives queries their first floor."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, largest: float):
        self.largest, self.ids, self.sample = largest, ids, sample
        self.vectors = sample[:PIVOTS].astype(float)
        self.height = np.sqrt(np.maximum(largest - (self.vectors**2).sum(1), 0))

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        width = max(x.shape[1], self.vectors.shape[1])
        x, p = widened(x.astype(float), width), widened(self.vectors, width)
        norm = (x**2).sum(1)
        height = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.largest - norm, 0))
        length = norm + height**2
        square = length[:, None] + self.largest - 2 * (x @ p.T + height[:, None] * self.height[None, :])
        return np.sqrt(np.maximum(square, 0))

    def floor(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """k-th best score of each query among the sample; none where the sample has fewer."""
        width = max(q.shape[1], self.sample.shape[1])
        scores = products(widened(q, width), widened(self.sample, width)).astype(float)
        scores[ids[:, None] == self.ids[None, :]] = -np.inf
        if scores.shape[1] < k:
            return np.full(len(q), -np.inf)
        return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


class Search:
    """Candidates of a task in blocks with bounds."""

    def __init__(self, pivots: Pivots, ids: np.ndarray, x: np.ndarray):
        far = pivots.distances(x, False)
        nearest = far.argmin(axis=1) if far.shape[1] else np.zeros(len(x), np.int64)
        order = np.lexsort((ids, far[np.arange(len(x)), nearest], nearest)) if far.shape[1] else np.argsort(ids)
        self.pivots, self.evaluated = pivots, 0
        self.blocks = []
        for first in range(0, len(order), BLOCK):
            own = order[first : first + BLOCK]
            own = own[np.argsort(ids[own], kind="stable")]
            self.blocks.append((ids[own], x[own], far[own].astype(np.float32), far[own].min(axis=0), far[own].max(axis=0)))

    def bound(self, room: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Greatest score at a distance of `least`; a little above, for the rounding of distances."""
        return (room - np.maximum(least * (1 - 1e-5) - 1e-3, 0) ** 2) / 2 + 1e-6 * room + 1e-3

    def best(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of what may be among the k best of each query."""
        far = self.pivots.distances(q, True)
        room = (q.astype(float) ** 2).sum(axis=1) + self.pivots.largest
        floor = self.pivots.floor(q_ids, q, k)
        bounds = np.stack([
            self.bound(room, np.maximum(np.maximum(far - most, least - far), 0).max(axis=1, initial=0)) for _, _, _, least, most in self.blocks
        ], axis=1)
        narrow = far.astype(np.float32)
        row, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
        for b in np.argsort(-bounds.max(axis=0), kind="stable"):
            c_ids, c, c_far, _, _ = self.blocks[b]
            active = np.flatnonzero(bounds[:, b] >= floor)
            if not len(active):
                continue
            least = np.zeros((len(active), len(c)), np.float32)
            for p in range(far.shape[1]):
                apart = narrow[active, p, None] - c_far[None, :, p]
                np.maximum(least, np.abs(apart, out=apart), out=least)
            # The farthest a candidate may be from the query to reach its floor.
            reach = np.sqrt(np.maximum(room[active] - 2 * (floor[active] - 1e-6 * room[active] - 1e-3), 0)) * (1 + 1e-5) + 2e-3
            may = least <= reach[:, None]
            some = np.flatnonzero(may.any(axis=0))
            if len(some) > MOST_STAY * len(c):
                some = np.arange(len(c))
            width = max(q.shape[1], c.shape[1])
            found = products(widened(q[active], width), widened(c[some], width))
            self.evaluated += found.size
            good = (found >= floor[active, None]) & (c_ids[some][None, :] != q_ids[active, None])
            u, v = np.nonzero(good)
            if not len(u):
                continue
            row, ids, scores = np.concatenate([row, active[u]]), np.concatenate([ids, c_ids[some][v]]), np.concatenate([scores, found[u, v]])
            if len(row) > 64 * k * len(q) or len(active) == len(q):
                row, ids, scores, floor = self._kept(row, ids, scores, floor, k)
        row, ids, scores, _ = self._kept(row, ids, scores, floor, k)
        return row, ids, scores

    @staticmethod
    def _kept(row, ids, scores, floor, k):
        order = np.lexsort((ids, -scores, row))
        row, ids, scores = row[order], ids[order], scores[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == k - 1
        floor = floor.copy()
        floor[row[last]] = np.maximum(floor[row[last]], scores[last])
        keep = place < k
        return row[keep], ids[keep], scores[keep], floor


def cell(pivots, k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        search = Search(pivots.value, candidates["id"].to_numpy(), matrix(candidates["v"]))
        q_ids, no, q = queries["id"].to_numpy(), queries["no"].to_numpy(), matrix(queries["v"])
        parts = []
        for first in range(0, len(q), QUERY_BLOCK):
            own = slice(first, first + QUERY_BLOCK)
            row, ids, scores = search.best(q_ids[own], q[own], k)
            parts.append((row + first, ids, scores))
        row, ids, scores = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
        return pa.table({"query_id": q_ids[row], "no": no[row], "vec_id": ids, "score": scores})

    return run


def top(vectors: DataFrame, is_query: Column, k: int = 20, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); is_query is a condition on the column id."""
    spark = vectors.sparkSession
    own = stage(whole_numbers(vectors, vec_id, embedding), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, largest = own.agg(F.count(F.lit(1)), F.max(norm)).first()
    # About SAMPLE rows, numbered as they were written.
    number = F.xxhash64(F.lit("sample"), F.monotonically_increasing_id())
    sample = own.where(F.pmod(number, F.lit(max(-(-n // SAMPLE), 1))) == 0).orderBy("id", "v").toArrow()
    shuffled = np.random.default_rng(37).permutation(len(sample))
    chosen = Pivots(sample["id"].to_numpy()[shuffled], matrix(sample["v"])[shuffled], largest or 0.0)
    pivots = spark.sparkContext.broadcast(chosen)
    same_id = Window.partitionBy("id").orderBy("v")
    queries = stage(own.where(is_query).distinct().withColumn("no", F.row_number().over(same_id).cast("long")), "queries")
    found = in_grid(own, queries, cell(pivots, k), "query_id long, no long, vec_id long, score long")
    ranked = Window.partitionBy("query_id", "no").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

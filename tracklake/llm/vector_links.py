"""Links between vectors of high cosine, found by product quantisation, and their classes.

Equal vectors are one from the start, with the number of their rows. The rest is brought to length one; two
such vectors have a cosine of `least` or more if they are no farther apart than r = sqrt(2 - 2 least).

An index is fitted on a sample of about SAMPLE vectors: centres of coarse lists, and code words for groups of
eight dimensions of what is left beside the centre. Every vector gets the list of its nearest centre, a byte per
group, and its distance to what these bytes stand for. The probes of a vector x are all lists j whose centre is nearest,
or nearly: with i the list of x, those where x is closer to i by less than r |c_i - c_j| min(1/2, DEVIATIONS / sqrt(d)). In d <= 16
dimensions one of two linked vectors always probes the other's list; beyond, both miss only if their
difference has more than twice as many deviations along c_i - c_j as a random direction would. In a list, distances between
the query and the code words are looked up and added; a candidate whose sum is farther than r plus its own
distance to its code cannot be linked, and all others are compared by exact cosine. So only probes can lose links.

Large groups of near copies are not compared in pairs: where LEAST_IN_BALL vectors of the sample or more lie within r / 2
of one of them, it becomes the centre of a ball. Vectors within r / 2 of such a centre are all linked with each other, without
a comparison; they leave the coarse lists, and other vectors probe a ball if they are within 1.5 r of its centre.
Lists with many candidates or queries are cut into parts. A task holds one part of each and hands on counts, and
a forest of the links it found, never pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing, nor does
a vector with itself; rows that repeat id and vector are linked with each other. Missing components of shorter vectors
count as 0. Rows with a null id link as others do; a class is named by its least id, null if all are null. A row with a null
id is kept if its class is null. Null ids of unlinked rows stay null. An empty table gives an empty result.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.graph import components
from tracklake.llm.vectors import matrix, usable
from tracklake.session import stage

LEAST = 0.95
SAMPLE = 1 << 14
PER_LIST, MOST_LISTS = 256, 1024
DEVIATIONS = 2.0
GROUP, WORDS = 8, 256
LEAST_IN_BALL = 16
PART, BLOCK = 4096, 1024
# Above the bounds, for the rounding of distances in single precision.
SLACK = 1e-3


def units(column) -> np.ndarray:
    x = matrix(column, np.float64)
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True) if x.shape[1] else x
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, max(width - x.shape[1], 0))))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + BLOCK] @ centres.T - half, axis=1) for i in range(0, len(x), BLOCK)] or [np.zeros(0, np.int64)])


def centres_of(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    """Means of k groups (Lloyd's rounds); a group that loses all its members keeps its centre."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        of = nearest(x, centres)
        order = np.argsort(of, kind="stable")
        there, first = np.unique(of[order], return_index=True)
        if len(there):
            centres[there] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
    return centres


class Index:
    """Centres of lists and balls, and code words of groups of dimensions."""

    def __init__(self, sample: np.ndarray, n: int, width: int, least: float):
        rng = np.random.default_rng(31)
        self.width = -(-max(width, 1) // GROUP) * GROUP
        self.r = math.sqrt(max(2 - 2 * least, 0))
        sample = widened(sample, self.width)
        self.balls = self._balls(sample)
        free = sample[self.ball_of(sample) < 0]
        if not len(free):
            free = np.zeros((1, self.width))
        k = max(1, min(n // PER_LIST, len(free) // 16, MOST_LISTS))
        self.centres = centres_of(free, k, 8, rng) if k > 1 else free.mean(axis=0, keepdims=True)
        left = free - self.centres[nearest(free, self.centres)]
        groups = left.reshape(len(left), -1, GROUP)
        self.words = [centres_of(groups[:, g], WORDS, 5, rng) for g in range(groups.shape[1])]
        square = (self.centres**2).sum(axis=1)
        apart = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * self.centres @ self.centres.T, 0))
        self.margin = self.r * apart * min(0.5, DEVIATIONS / math.sqrt(self.width)) + 1e-9

    def _balls(self, sample: np.ndarray) -> np.ndarray:
        near = 1 - (self.r / 2 - 1e-6) ** 2 / 2
        small = sample.astype(np.float32)
        counts = np.concatenate([((small[i : i + 512] @ small.T) >= near).sum(axis=1) for i in range(0, len(small), 512)] or [np.zeros(0, np.int64)])
        centres = []
        for i in np.argsort(-counts, kind="stable"):
            if counts[i] < LEAST_IN_BALL:
                break
            if not centres or (np.array(centres) @ sample[i]).max() < near:
                centres.append(sample[i])
        return np.array(centres).reshape(-1, self.width)

    def to_balls(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (self.balls**2).sum(axis=1)[None, :] - 2 * x @ self.balls.T, 0))

    def ball_of(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest ball that holds each vector, or -1."""
        if not len(self.balls) or not len(x):
            return np.full(len(x), -1)
        far = self.to_balls(x)
        best = far.argmin(axis=1)
        return np.where(far[np.arange(len(x)), best] <= self.r / 2 - 1e-6, best, -1)

    def centre(self, of: np.ndarray) -> np.ndarray:
        return np.concatenate([self.centres, self.balls])[of]

    def encode(self, x: np.ndarray):
        """Home list, code bytes, distance to the code, and which lists are probed (a mask) of each vector."""
        score = x @ self.centres.T - (self.centres**2).sum(axis=1) / 2
        voronoi = score.argmax(axis=1)
        probed = score[np.arange(len(x)), voronoi][:, None] - score <= self.margin[voronoi]
        ball = self.ball_of(x)
        home = np.where(ball >= 0, len(self.centres) + ball, voronoi)
        if len(self.balls):
            close = self.to_balls(x) <= 1.5 * self.r + 1e-6
            close[np.flatnonzero(ball >= 0), ball[ball >= 0]] = False
            probed = np.concatenate([probed, close], axis=1)
        left = (x - self.centre(home)).reshape(len(x), -1, GROUP)
        codes = np.stack([nearest(left[:, g], w) for g, w in enumerate(self.words)], axis=1).astype(np.uint8)
        rest = np.concatenate([left[:, g] - w[codes[:, g]] for g, w in enumerate(self.words)], axis=1)
        return home, codes, np.sqrt((rest**2).sum(axis=1)), probed

    def tables(self, x: np.ndarray, of: int) -> list[np.ndarray]:
        """Squared distances (word, query) between what is left of the queries and the words of each group."""
        left = (x - self.centre(of)).reshape(len(x), -1, GROUP)
        out = []
        for g, w in enumerate(self.words):
            part = left[:, g]
            out.append(((part**2).sum(axis=1)[None, :] + (w**2).sum(axis=1)[:, None] - 2 * w @ part.T).astype(np.float32))
        return out


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Forest after the links (a, b); a node points to a lesser one."""
    while True:
        u, v = parent[a], parent[b]
        apart = u != v
        if not apart.any():
            return parent
        a, b, u, v = a[apart], b[apart], u[apart], v[apart]
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
        parent = roots(parent)


def cosines(y: np.ndarray, x: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    if len(u) * 8 > len(y) * len(x):
        return (y @ x.T)[u, v]
    step = 1 << 14
    return np.concatenate([np.einsum("ij,ij->i", y[u[i : i + step]], x[v[i : i + step]]) for i in range(0, len(u), step)] or [np.zeros(0)])


def cell(index, least: float):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        own = index.value
        of, lists = key[0].as_py(), len(own.centres) + len(own.balls)
        y, x = (widened(units(t), own.width) for t in (candidates["e"], queries["q_e"]))
        c_node, q_node = candidates["node"].to_numpy(), queries["q_node"].to_numpy()
        c_n, q_n, home = candidates["n"].to_numpy(), queries["q_n"].to_numpy(), queries["q_home"].to_numpy().astype(np.int64)
        code = np.frombuffer(b"".join(candidates["code"].to_pylist()), np.uint8).reshape(len(y), -1)
        reach = (own.r + SLACK + candidates["rest"].to_numpy()).astype(np.float32) ** 2
        probes = candidates["probes"].combine_chunks()
        probed = np.repeat(np.arange(len(y)), probes.value_lengths().to_numpy()) * lists + probes.flatten().to_numpy()
        nodes, at = np.unique(np.concatenate([c_node, q_node]), return_inverse=True)
        c_at, q_at = at[: len(y)], at[len(y) :]
        links, parent = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for first in range(0, len(x), BLOCK):
            tables = own.tables(x[first : first + BLOCK], of)
            for start in range(0, len(y), BLOCK):
                some = slice(start, start + BLOCK)
                far = tables[0][code[some, 0]]
                for g in range(1, len(tables)):
                    far += tables[g][code[some, g]]
                u, v = np.nonzero(far <= reach[some, None])
                u, v = u + start, v + first
                u, v = (z[c_node[u] != q_node[v]] for z in (u, v))
                hit = cosines(y[some], x[first : first + BLOCK], u - start, v - first) >= least
                u, v = u[hit], v[hit]
                np.add.at(links, q_at[v], c_n[u])
                # The candidate does not look into the query's list: it learns of the link here.
                back = ~np.isin(u * lists + home[v], probed)
                np.add.at(links, c_at[u[back]], q_n[v[back]])
                parent = joined(parent, c_at[u], q_at[v])
        some = np.flatnonzero((links > 0) | (parent != np.arange(len(nodes))))
        return pa.table({"node": nodes[some], "links": links[some], "other": nodes[parent[some]]})

    return run


def encoded(reps: DataFrame, index) -> DataFrame:
    def run(batches):
        own = index.value
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(i, BLOCK)
                home, code, rest, probed = own.encode(widened(units(rows.column(1)), own.width))
                row, which = np.nonzero(probed)
                bounds = np.searchsorted(row, np.arange(len(home) + 1)).astype(np.int32)
                probes = pa.ListArray.from_arrays(bounds, pa.array(which.astype(np.int32)))
                arrays = [
                    rows.column(0), rows.column(1), rows.column(2), pa.array(home.astype(np.int32)),
                    pa.array([c.tobytes() for c in code], pa.binary()), pa.array(rest), probes,
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "e", "n", "home", "code", "rest", "probes"])

    kind = reps.schema["e"].dataType.simpleString()
    return reps.select("node", "e", "n").mapInArrow(run, f"node long, e {kind}, n long, home int, code binary, rest double, probes array<int>")


def in_cells(rows: DataFrame, index, least: float) -> DataFrame:
    """(node, links, other) found in each pair of a part of a list's candidates and a part of its queries."""
    spark = rows.sparkSession
    # Names of their own, because both sides of the cells come from the same rows.
    queries = rows.select(F.explode("probes").alias("list"), *(F.col(c).alias(f"q_{c}") for c in ("node", "e", "n", "home")))
    # A row per list: at most MOST_LISTS and the number of balls.
    candidates = rows.groupBy(F.col("home").alias("list")).agg(F.count(F.lit(1)).alias("c"))
    asked = rows.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("q"))
    sizes = candidates.join(asked, "list").select(
        "list", F.ceil(F.col("c") / PART).cast("int").alias("of_c"), F.ceil(F.col("q") / PART).cast("int").alias("of_q")
    )
    sizes = stage(sizes, "lists")
    cells = sizes.agg(F.sum(F.col("of_c").cast("long") * F.col("of_q"))).first()[0] or 1
    tasks = int(min(cells, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.withColumnRenamed("home", "list").join(F.broadcast(sizes), "list")
    left = left.withColumn("a", F.pmod(F.xxhash64("node"), "of_c").cast("int")).withColumn("b", every("of_q"))
    right = queries.join(F.broadcast(sizes), "list")
    right = right.withColumn("b", F.pmod(F.xxhash64("q_node"), "of_q").cast("int")).withColumn("a", every("of_c"))
    key = ("list", "a", "b")
    left = left.select(*key, "node", "e", "n", "code", "rest", "probes").repartition(tasks, *key)
    right = right.select(*key, "q_node", "q_e", "q_n", "q_home").repartition(tasks, *key)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(cell(index, least), "node long, links long, other long")


def classes(vectors: DataFrame, least: float = LEAST, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    own = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[embedding].alias("e"))
    linkable = usable(F.col("e")) & F.exists("e", lambda x: x != 0)
    seed = lambda k: F.when(linkable, F.xxhash64(F.lit(k), "e"))
    hashed = own.select("id", seed(1).alias("f1"), seed(2).alias("f2"), F.when(linkable, F.col("e")).alias("e"))
    same = hashed.where("f1 is not null").groupBy("f1", "f2").agg(F.any_value("e").alias("e"), F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    reps = stage(same.withColumn("node", F.monotonically_increasing_id()), "vectors")

    n, width = reps.agg(F.count(F.lit(1)), F.max(F.size("e"))).first()
    every = max(-(-n // SAMPLE), 1)
    sample = reps.where(F.pmod(F.xxhash64("f1", F.lit("sample")), F.lit(every)) == 0).orderBy("f1", "f2").select("e").toArrow()
    index = spark.sparkContext.broadcast(Index(units(sample["e"]), n, width or 1, least))
    rows = stage(encoded(reps, index), "codes")
    found = stage(in_cells(rows, index, least), "links")

    lists = len(index.value.centres)
    # A row per ball, of which the sample bounds the number.
    balls = rows.where(F.col("home") >= lists).groupBy("home").agg(F.sum("n").alias("in_ball"), F.min("node").alias("least_node"))
    members = rows.join(F.broadcast(balls), "home").select("node", (F.col("in_ball") - F.col("n")).alias("links"), F.col("least_node").alias("other"))
    found = found.unionByName(members)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    of = reps.select("node", "first", "n", "f1", "f2").join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = of.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = of.join(named, "component").join(counts, "node", "left")
    placed = placed.select("f1", "f2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    known = hashed.select("id", "f1", "f2").join(placed, ["f1", "f2"], "left")
    component = F.when(F.col("f1").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return known.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )

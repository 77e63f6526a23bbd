"""Columns of vectors, and a grid of tasks that holds queries against candidates."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDIDATES, LEAST_CANDIDATES, QUERIES = 1 << 16, 1 << 11, 1 << 10


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, lambda x: bad(x.cast("double")))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def matrix(column: pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width).astype(kind)
    out = np.zeros((len(column), width), kind)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def in_grid(candidates: DataFrame, queries: DataFrame, evaluate: Callable, schema: str) -> DataFrame:
    """evaluate(candidates, queries) on every pair of a group of candidates and a group of queries.

    Both frames must be read from files, so that a task that runs again numbers its rows as before.
    Groups are dealt by row number: rows that repeat cannot gather in one. A cell holds at most
    CANDIDATES and QUERIES rows or little more; on few rows groups are smaller, to keep all cores busy.
    """
    spark = candidates.sparkSession
    n, n_queries = candidates.count(), queries.count()
    wanted = max(LEAST_CANDIDATES, min(CANDIDATES, n // (2 * spark.sparkContext.defaultParallelism) + 1))
    g, h = -(-n // wanted) or 1, -(-n_queries // QUERIES) or 1
    number = F.monotonically_increasing_id()
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = candidates.withColumn("g", (number % g).cast("int")).withColumn("h", every(h)).repartition(g * h, "g", "h")
    right = queries.withColumn("h", (number % h).cast("int")).withColumn("g", every(g)).repartition(g * h, "g", "h")
    return left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(evaluate, schema)


def best_rows(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest valid scores of each row; of equal ones the first columns."""
    columns = scores.shape[1]
    if not columns or not len(scores):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if int(np.abs(scores).max()) < 2**62 // columns:
        key = np.where(valid, scores.astype(np.int64) * columns + np.arange(columns - 1, -1, -1), np.iinfo(np.int64).min)
        if columns > k:
            best = np.argpartition(key, columns - k, axis=1)[:, columns - k :]
        else:
            best = np.broadcast_to(np.arange(columns), scores.shape)
    else:
        best = np.lexsort((np.broadcast_to(np.arange(columns), scores.shape), -scores, ~valid), axis=1)[:, :k]
    row = np.repeat(np.arange(len(scores)), best.shape[1])
    column = best.ravel()
    there = valid[row, column]
    return row[there], column[there]

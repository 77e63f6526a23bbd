"""Hard negatives of anchors, scored by table look-ups (the method of the Four Russians).

Each component x becomes floor(SCALE * x); a score is the inner product of whole numbers, exact. For every
anchor and group of eight dimensions a table holds the sums of all 256 subsets of the anchor's eight
components. A candidate's components are cut into bit planes, and the eight bits of a plane and a group are
packed into a byte, which is the index into the table. The sums found for a plane are added, shifted and
added to those of the next; the highest plane is the sign and counts negative. So a score takes one look-up
per plane and group and no multiplication. Tables of many anchors stand side by side: a look-up fetches a row of sums.

A grid of tasks scores groups of candidates against groups of anchors, twice: first for the positives, the
highest rows of the anchor's label, then for the negatives, the highest rows of other labels whose score is
between LOW and HIGH percent of a positive's. Each task hands on its best rows per anchor or positive only.

Defined results: rows with a null id or label, with a null vector or null or non-finite components, take no
part. Missing components of shorter vectors count as 0. Rows with the id of the anchor are the anchor's own
and are neither positives nor negatives. Rows that repeat id, label and vector are one anchor, but each is a
candidate. An anchor without positives, or a positive without negatives, has no rows. Equal scores go by
the smaller id. A positive of score 0 allows negatives of score 0, one below 0 allows none. Sums must
fit a long. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.vectors import best_rows, floored, in_grid, matrix, usable
from tracklake.session import stage

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
GROUP = 8
BLOCK, ANCHOR_BLOCK = 2048, 256


def planes_of(x: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers, packed: (plane, group, row) bytes, the sign plane last."""
    most = int(max(x.max(initial=0), ~x.min(initial=0)))
    groups = -(-x.shape[1] // GROUP)
    x = np.pad(x, ((0, 0), (0, groups * GROUP - x.shape[1])))
    out = np.zeros((most.bit_length() + 1, groups, len(x)), np.uint8)
    for plane in range(len(out)):
        bits = ((x >> plane) & 1).astype(np.uint8).reshape(len(x), groups, GROUP)
        out[plane] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return out


def tables_of(anchors: np.ndarray) -> np.ndarray:
    """Subset sums: (group, byte, anchor)."""
    groups = -(-anchors.shape[1] // GROUP)
    anchors = np.pad(anchors, ((0, 0), (0, groups * GROUP - anchors.shape[1])))
    subsets = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    return np.stack([subsets @ anchors[:, GROUP * g : GROUP * (g + 1)].T for g in range(groups)]) if groups else np.zeros((0, 256, len(anchors)), np.int64)


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor) inner products; planes go from the highest to the lowest."""
    groups = min(tables.shape[0], planes.shape[1])
    # No partial sum is larger than the sum of the anchor's absolute components, shifted by all planes.
    most = int((tables.max(axis=1, initial=0) - tables.min(axis=1, initial=0)).sum(axis=0).max(initial=0)) << len(planes)
    kind = np.int32 if most < 2**31 else np.int64
    tables = tables.astype(kind)
    total = np.zeros((planes.shape[2], tables.shape[2]), kind)
    found = np.empty_like(total)
    for plane in range(len(planes) - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[plane, g], axis=0, out=found, mode="clip")
            total += found
        if plane == len(planes) - 1:
            np.negative(total, out=total)
    return total


def blocks_of(table: pa.Table):
    """(ids, labels, planes) of blocks of candidates in ascending order of ids."""
    ids = table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, labels, x = ids[order], table["label"].to_numpy()[order], matrix(table["v"])[order]
    for first in range(0, len(ids), BLOCK):
        cut = slice(first, first + BLOCK)
        yield ids[cut], labels[cut], planes_of(x[cut])


class Kept:
    """The best rows so far of each (anchor, place): id and score."""

    def __init__(self, k: int):
        self.k, self.parts, self.n = k, [], 0

    def add(self, of: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
        self.parts.append((of, ids, values))
        self.n += len(of)
        if self.n > 1 << 20:
            self.parts = [self.result()]
            self.n = len(self.parts[0][0])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of, ids, values = (np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((ids, -values, of))
        of, ids, values = of[order], ids[order], values[order]
        first = np.searchsorted(of, of)
        keep = np.arange(len(of)) - first < self.k
        return of[keep], ids[keep], values[keep]


def best_positives(k: int):
    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        a_id, a_no, a_label = (anchors[c].to_numpy() for c in ("id", "no", "label"))
        kept, x = Kept(k), matrix(anchors["v"])
        tables = [(first, tables_of(x[first : first + ANCHOR_BLOCK])) for first in range(0, len(x), ANCHOR_BLOCK)]
        for ids, labels, planes in blocks_of(candidates):
            for first, table in tables:
                found = np.ascontiguousarray(scores(table, planes).T)
                own = slice(first, first + ANCHOR_BLOCK)
                valid = (labels[None, :] == a_label[own, None]) & (ids[None, :] != a_id[own, None])
                row, column = best_rows(found, valid, k)
                kept.add(row + first, ids[column], found[row, column].astype(np.int64))
        of, ids, values = kept.result()
        return pa.table({"id": a_id[of], "no": a_no[of], "positive_id": ids, "positive_score": values})

    return run


def best_negatives(k: int, low: int, high: int):
    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        a_id, a_no, a_label = (anchors[c].to_numpy() for c in ("id", "no", "label"))
        score, there = matrix(anchors["scores"]), anchors["scores"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        places = score.shape[1]
        kept, x = Kept(k), matrix(anchors["v"])
        tables = [(first, tables_of(x[first : first + ANCHOR_BLOCK])) for first in range(0, len(x), ANCHOR_BLOCK)]
        for ids, labels, planes in blocks_of(candidates):
            for first, table in tables:
                found = np.ascontiguousarray(scores(table, planes).T).astype(np.int64)
                own = slice(first, first + ANCHOR_BLOCK)
                other = (labels[None, :] != a_label[own, None]) & (ids[None, :] != a_id[own, None])
                for place in range(places):
                    least, most = (p * score[own, place, None] for p in (low, high))
                    valid = other & (100 * found >= least) & (100 * found <= most) & (there[own, None] > place)
                    rows = np.flatnonzero(valid.any(axis=1))
                    row, column = best_rows(found[rows], valid[rows], k)
                    kept.add((rows[row] + first) * places + place, ids[column], found[rows[row], column])
        of, ids, values = kept.result()
        of, place = np.divmod(of, max(places, 1))
        return pa.table({"id": a_id[of], "no": a_no[of], "place": place.astype(np.int32), "negative_id": ids, "negative_score": values})

    return run


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE, vec_id="vec_id", embedding="embedding", label="label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    is_anchor is a condition on the column id.
    """
    own = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[label].cast("long").alias("label"), vectors[embedding].alias("e"))
    own = own.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("e")))
    own = stage(own.select("id", "label", floored(F.col("e"), scale).alias("v")), "vectors")
    same_id = Window.partitionBy("id").orderBy("label", "v")
    anchors = own.where(is_anchor).distinct().withColumn("no", F.row_number().over(same_id).cast("long"))
    anchors = stage(anchors, "anchors")

    found = in_grid(own, anchors, best_positives(positives), "id long, no long, positive_id long, positive_score long")
    order = Window.partitionBy("id", "no").orderBy(F.desc("positive_score"), "positive_id")
    found = stage(found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives), "positives")
    scored = found.groupBy("id", "no").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("s"))
    asked = stage(anchors.join(scored.select("id", "no", F.col("s.positive_score").alias("scores")), ["id", "no"]), "asked")

    below = in_grid(own, asked, best_negatives(negatives, low, high), "id long, no long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("id", "no", "place").orderBy(F.desc("negative_score"), "negative_id")
    below = below.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return below.join(found, ["id", "no", "place"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        (F.col("place") + 1).alias("positive_rank"),
    )

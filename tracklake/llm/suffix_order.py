"""Order of all suffixes of many strings of numbers, by a difference cover modulo three.

Positions whose place in their string is 1 or 2 modulo 3 are the sample. Their triples are sorted and
named; the strings of names, one per residue, are ordered by the same procedure; the remaining suffixes
follow from their first symbol and the rank after it, and are merged with the sample. All of it is
sorts by range, grouped counts and joins, so no task holds more than its part of a sort.

Suffixes need only be told apart up to a length in bytes, which the symbols bring with them: recursion
ends once each repeated name covers it. Suffixes that agree up to there share a rank. Within recursion,
only names that are still ambiguous go on, with the one that follows them: a name that stands once, or
covers enough, ends any comparison.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.session import scope, stage

END = -1  # stands after the last symbol; symbols are 0 or more


def running(df: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """A row per distinct keys, with the sums of the counts and `before_` sums of all lesser keys."""
    grouped = df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
    ordered = grouped.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join([*(f"{c} long" for c in keys + counts), *(f"before_{c} long" for c in counts), "part int"])

    def add(batches):
        from pyspark import TaskContext

        part, carry = TaskContext.get().partitionId(), np.zeros(len(counts), np.int64)
        for batch in batches:
            columns = list(batch.columns)
            for j in range(len(counts)):
                n = batch.column(len(keys) + j).to_numpy(zero_copy_only=False)
                total = np.cumsum(n)
                columns.append(pa.array(total - n + carry[j], pa.int64()))
                carry[j] += total[-1] if len(total) else 0
            columns.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    done = stage(ordered.select(*(F.col(c).cast("long") for c in keys + counts)).mapInArrow(add, schema), "running")
    # A row per partition of the sort.
    totals = done.groupBy("part").agg(*(F.sum(c).alias(f"of_{c}") for c in counts))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(F.col("part"), *(F.coalesce(F.sum(f"of_{c}").over(so_far), F.lit(0)).alias(f"of_{c}") for c in counts))
    moved = done.join(F.broadcast(shifts), "part")
    return moved.select(*keys, *counts, *((F.col(f"before_{c}") + F.col(f"of_{c}")).alias(f"before_{c}") for c in counts))


def following(df: DataFrame, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Adds values of later places of the same string; END where there are none."""
    place = Window.partitionBy("str", "half").orderBy("k")
    return df.withColumns({name: F.coalesce(F.lead(c, n).over(place), F.lit(END)) for name, (c, n) in columns.items()})


def ambiguous(strings: DataFrame, enough: int) -> DataFrame:
    """Symbols that stand more than once and do not cover enough."""
    repeated = strings.groupBy("sym").agg(F.count(F.lit(1)).alias("n"), F.min("len").alias("len"))
    return stage(repeated.where((F.col("n") > 1) & (F.col("len") < enough)).select("sym"), "ambiguous")


def refine(names: DataFrame, open_names: DataFrame, enough: int) -> DataFrame:
    """Ranks of strings of names, of which only some are ambiguous.

    A name is the number of lesser ones, so there is room for its suffixes up to the next name.
    """
    place = Window.partitionBy("str", "half").orderBy("k")
    marked = names.join(open_names.withColumn("open", F.lit(1)), "sym", "left").withColumn("before", F.lag("open").over(place))
    runs = marked.where("open is not null or before is not null").withColumn(
        "first", F.last(F.when(F.col("open").isNotNull() & F.col("before").isNull(), F.col("k")), ignorenulls=True).over(place)
    )
    runs = runs.select(
        F.xxhash64("str", "half", "first").alias("run"), (F.col("k") - F.col("first")).alias("place"), "str", "half", "k", "sym", "len", "open"
    )
    runs = stage(runs, "runs")
    strings = runs.select(F.col("run").alias("str"), F.lit(1).cast("long").alias("half"), F.col("place").alias("k"), "sym", "len")
    order = difference_cover(strings, enough).select(F.col("str").alias("run"), F.col("k").alias("place"), "rank")
    found = stage(runs.where("open is not null").join(order, ["run", "place"]).select("str", "half", "k", "sym", "rank"), "refined")
    least = found.groupBy("sym").agg(F.min("rank").alias("least"))
    within = found.join(least, "sym").select("str", "half", "k", (F.col("sym") + F.col("rank") - F.col("least")).alias("rank"))
    return names.join(within, ["str", "half", "k"], "left").select("str", "half", "k", F.coalesce("rank", "sym").alias("rank"))


def ranks(strings: DataFrame, enough: int) -> DataFrame:
    """(str, half, k, rank) for strings (str, half, k, sym, len): str and half name a string, k a place.

    Places count from 0. half is 1 at first, and gets a bit more for each level of recursion.

    len is the number of bytes that a symbol covers; `enough` that it reaches the end.
    """
    if ambiguous(strings, enough).isEmpty():
        return strings.select("str", "half", "k", F.col("sym").alias("rank"))
    return difference_cover(strings, enough)


def difference_cover(strings: DataFrame, enough: int) -> DataFrame:
    """As ranks, by the ranks of the sample; a rank is the number of lesser suffixes."""
    with scope(strings.sparkSession) as keep:
        ahead = stage(following(strings, {"s1": ("sym", 1), "s2": ("sym", 2), "l1": ("len", 1), "l2": ("len", 2)}), "ahead")
        covered = F.when(F.col("s2") == END, F.lit(enough)).otherwise(F.least(F.col("len") + F.col("l1") + F.col("l2"), F.lit(enough)))
        sample = ahead.where("k % 3 <> 0").select("str", "half", "k", "sym", "s1", "s2", covered.cast("long").alias("len"), F.lit(1).alias("one"))
        names = running(sample, ["sym", "s1", "s2"], ["one"]).select("sym", "s1", "s2", F.col("before_one").alias("name"))
        named = sample.join(names, ["sym", "s1", "s2"]).select(
            "str", (F.col("half") * 2 + F.col("k") % 3 - 1).alias("half"), F.floor(F.col("k") / 3).cast("long").alias("k"), F.col("name").alias("sym"), "len"
        )
        named = stage(named, "names")
        left = ambiguous(named, enough)
        inner = named.withColumn("rank", F.col("sym")) if left.isEmpty() else refine(named, left, enough)
        back = inner.select(
            "str", F.shiftright("half", 1).alias("half"), (F.col("k") * 3 + F.col("half") % 2 + 1).alias("k"), "rank"
        )
        all_ranks = ahead.select("str", "half", "k", "sym", "s1").join(back, ["str", "half", "k"], "left")
        known = stage(following(all_ranks, {"r1": ("rank", 1), "r2": ("rank", 2)}), "ranked")
        kind = lambda n: (F.col("k") % 3 == n).cast("long")
        counted = known.withColumns({"n0": kind(0), "n1": kind(1), "n2": kind(2), "one": F.lit(1).cast("long")})
        # Where the sample stands among itself, and the rest among the rest and among each half of the sample.
        itself = running(counted.where("k % 3 <> 0"), ["rank"], ["one"]).select("rank", F.col("before_one").alias("b12"))
        first = running(counted.where("k % 3 <> 2"), ["sym", "r1"], ["n0", "n1"]).select(
            "sym", "r1", F.col("before_n0").alias("b0"), F.col("before_n1").alias("b1")
        )
        second = running(counted.where("k % 3 <> 1"), ["sym", "s1", "r2"], ["n0", "n2"]).select(
            "sym", "s1", "r2", F.col("before_n0").alias("b0"), F.col("before_n2").alias("b2")
        )
        zero = known.where("k % 3 = 0").join(first, ["sym", "r1"]).join(second.drop("b0"), ["sym", "s1", "r2"])
        one = known.where("k % 3 = 1").join(first.drop("b1"), ["sym", "r1"]).join(itself, "rank")
        two = known.where("k % 3 = 2").join(second.drop("b2"), ["sym", "s1", "r2"]).join(itself, "rank")
        merged = zero.select("str", "half", "k", (F.col("b0") + F.col("b1") + F.col("b2")).alias("rank"))
        for part in (one, two):
            merged = merged.union(part.select("str", "half", "k", (F.col("b0") + F.col("b12")).alias("rank")))
        return keep(stage(merged, "ranks"))

"""Rows by their number, at any depth."""

import re

from pyspark.sql import functions as F

from tracklake.operators.positions import sorted_ranges


def test_rows_far_down(spark):
    df = spark.range(0, 50_000, numPartitions=7).select((F.col("id") * 7919 % 50_000).alias("x"), F.col("id").alias("y"))
    ordered = sorted_ranges(df, ["x"], ranges=20)
    assert ordered.total == 50_000
    for first, last in ((1, 5), (24_990, 25_013), (49_996, 50_100), (50_001, 50_010), (3, 2), (-4, 2)):
        got = sorted((r.position, r.x) for r in ordered.between(first, last).collect())
        assert got == [(n, n - 1) for n in range(max(first, 1), min(last, 50_000) + 1)]


def test_only_ranges_that_hold_the_rows_are_read(spark):
    ordered = sorted_ranges(spark.range(100_000), ["id"], ranges=25)
    page = ordered.between(60_000, 60_010)
    which = ordered.holding(60_000, 60_010)
    assert 1 <= len(which) <= 2 and len(ordered.starts) == 25
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_range", plan)
    files = ordered.rows.where(F.col("_range").isin(which)).select("_metadata.file_path").distinct().count()
    assert files <= 2 * len(which)


def test_equal_rows_are_split_over_ranges(spark):
    """A third of all rows are equal, missing values come first, and each number is given once."""
    df = spark.range(0, 30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("x"))
    ordered = sorted_ranges(df, ["x"], ranges=10)
    sizes = [b - a for a, b in zip(ordered.starts.values(), [*list(ordered.starts.values())[1:], ordered.total])]
    assert max(sizes) < 6_000
    rows = sorted((r.position, r.x) for r in ordered.between(1, 30_000).collect())
    assert [n for n, _ in rows] == list(range(1, 30_001))
    values = [x for _, x in rows]
    assert values[:10_000] == [None] * 10_000 and values[10_000:] == sorted(values[10_000:])


def test_no_rows(spark):
    ordered = sorted_ranges(spark.range(0), ["id"], ranges=4)
    assert (ordered.total, ordered.between(1, 10).count(), ordered.between(1, 10).columns) == (0, 0, ["id", "position"])


def test_descending(spark):
    ordered = sorted_ranges(spark.range(1000), [F.desc("id")], ranges=5)
    assert {(r.position, r.id) for r in ordered.between(500, 501).collect()} == {(500, 500), (501, 499)}

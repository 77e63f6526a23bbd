"""Rows by their number in a sorted order, at any depth.

Rows are written once in ordered ranges, a folder for each. Their sizes tell which ranges hold rows m to n, and only
those folders are read, so a page far down costs as much as the first one.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.session import stage

RANGE, TIE = "_range", "_tie"


@dataclass
class SortedRanges:
    """Ordered ranges in the shared folder, and the number of rows before each."""

    rows: DataFrame
    order: list[Column | str]
    starts: dict[int, int]
    total: int

    def holding(self, first: int, last: int) -> list[int]:
        """The ranges that hold rows number first to last."""
        after = dict(zip(self.starts, [*list(self.starts.values())[1:], self.total]))
        return [r for r, start in self.starts.items() if start < last and after[r] >= first]

    def between(self, first: int, last: int, position: str = "position") -> DataFrame:
        """Rows number first to last, counted from 1, with their numbers. Beyond the last row there is nothing."""
        which = self.holding(max(first, 1), last)
        spark = self.rows.sparkSession
        # A row per range, so no more than there are partitions.
        starts = spark.createDataFrame([(r, self.starts[r]) for r in which], f"{RANGE} int, _start bigint")
        within = F.row_number().over(Window.partitionBy(RANGE).orderBy(*self.order, TIE))
        part = self.rows.where(F.col(RANGE).isin(which)).withColumn(position, within.cast("bigint"))
        part = part.join(F.broadcast(starts), RANGE).withColumn(position, F.col(position) + F.col("_start"))
        return part.where(F.col(position).between(first, last)).drop(RANGE, TIE, "_start")


def sorted_ranges(df: DataFrame, order: list[Column | str], ranges: int | None = None) -> SortedRanges:
    """Rows in ordered ranges. Rows equal in the order follow each other as they were read.

    The place of a row where it was read breaks ties, so equal rows are split over ranges as well. There are as many
    ranges as shuffle partitions if no number is given.
    """
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(count, *order, TIE)
    placed = placed.withColumn(RANGE, F.spark_partition_id()).sortWithinPartitions(RANGE, *order, TIE)
    rows = stage(placed, "ranges", by=(RANGE,))
    starts, total = {}, 0
    for r in sorted(rows.groupBy(RANGE).agg(F.count("*").alias("num")).collect()):
        starts[r[0]] = total
        total += r[1]
    return SortedRanges(rows, list(order), starts, total)

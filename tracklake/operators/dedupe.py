"""Duplicate events: groups of equal keys, the row to keep, and reports on them.

A group may be very large, so nothing here gathers one: counts and maxima are built per task
before the shuffle, and the ranking drops the losers of each task before the shuffle too.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.times import millis_text, to_unit
from tracklake.functions.values import missing, present, round_even, value_count
from tracklake.operators.joins import BROADCAST_BYTES, is_small, join_facts
from tracklake.session import checkpointed, stage

KEYS = ("study_id", "individual_id", "tag_id", "sensor_type_id")
TIME_UNIT = "ts_unit"
# The keys of a group as one struct: unlike plain columns, structs with equal gaps are equal,
# so rows with a missing key meet their group in a join.
GROUP = "_group"


def with_time_unit(df: DataFrame, unit: str | None, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(TIME_UNIT, to_unit(F.col(ts), unit))


def with_group(df: DataFrame, keys=KEYS, last: str = TIME_UNIT) -> DataFrame:
    return df.withColumn(GROUP, F.struct(*keys, last))


def join_groups(
    df: DataFrame, groups: DataFrame, keys=KEYS, how: str = "inner", last: str = TIME_UNIT, **options
) -> DataFrame:
    """Join rows to values of their groups. Both sides have the key columns and `last`."""
    side = with_group(groups, keys, last).drop(*keys, last)
    return join_facts(with_group(df, keys, last), side, [GROUP], how, **options).drop(GROUP)


def duplicate_groups(df: DataFrame, keys=KEYS, unit: str | None = "second") -> DataFrame:
    """Key groups with more than one row, and how many rows they have."""
    return (
        with_time_unit(df, unit)
        .groupBy(*keys, TIME_UNIT)
        .agg(F.count("*").alias("num"))
        .where(F.col("num") > 1)
    )


def with_group_id(groups: DataFrame, keys=KEYS) -> DataFrame:
    """An id per group from its keys; needs no order between groups."""
    return groups.withColumn("dup_id", F.xxhash64(*keys, TIME_UNIT))


def number_groups(groups: DataFrame, order: list[str], name: str = "dup_id") -> DataFrame:
    """Number rows 1, 2, 3, ... in order, without sorting them in one task.

    Rows are split into ordered ranges, numbered within each range, and shifted by the size of
    the ranges before. The split is checkpointed: it must be the same in both readings.
    """
    ranges = checkpointed(
        groups.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    # One row per range, so as many as there are shuffle partitions.
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.join(shifts, "_range")
        .withColumn(name, (within + F.col("_shift")).cast("bigint"))
        .drop("_range", "_shift")
    )


def duplicate_events(df: DataFrame, keys=KEYS, unit: str | None = "second") -> DataFrame:
    """All rows of groups with more than one row, with the group size and id."""
    groups = stage(with_group_id(duplicate_groups(df, keys, unit), keys), "groups")
    return join_groups(with_time_unit(df, unit), groups, keys)


def with_group_size(df: DataFrame, keys=KEYS, unit: str | None = "second") -> DataFrame:
    """Every row with the size of its group."""
    marked = with_time_unit(df, unit)
    sizes = marked.groupBy(*keys, TIME_UNIT).agg(F.count("*").alias("num"))
    return join_groups(marked, sizes, keys, small=False)


def richest_rows(df: DataFrame, keys=KEYS, unit: str | None = "second", counted=None) -> DataFrame:
    """The rows with the most values of each group; several where they tie."""
    counted = list(counted or df.columns)
    marked = with_time_unit(df.withColumn("numvals", value_count(df, counted)), unit)
    best = marked.groupBy(*keys, TIME_UNIT).agg(F.max("numvals").alias("_best"))
    richest = F.col("numvals") == F.col("_best")
    return join_groups(marked, best, keys, condition=richest, small=False).drop("_best")


def dedupe_events(
    df: DataFrame,
    keys=KEYS,
    unit: str | None = "second",
    counted: list[str] | None = None,
    order=("timestamp", "event_id"),
    ties: str = "first",
) -> DataFrame:
    """One row per group: the one with the most values, then the first in `order`.

    ties="distinct" is the older rule: of the richest rows, those that agree in everything but
    the event id (numbers rounded to 8 decimals) are one; rows that differ all stay.
    """
    counted = list(counted or df.columns)
    if ties == "distinct":
        rich = richest_rows(df, keys, unit, counted)
        # Missing values are equal to each other here, as null and NaN would otherwise differ.
        same = [F.when(present(df, n), _rounded(df, n)) for n in df.columns if n != "event_id"]
        rank = F.row_number().over(Window.partitionBy(*same).orderBy(*order))
        return rich.withColumn("_rank", rank).where("_rank = 1").select(*df.columns)
    if ties != "first":
        raise ValueError(f"unknown way to break ties: {ties}")
    ranking = Window.partitionBy(*keys, TIME_UNIT).orderBy(F.desc("numvals"), *order)
    return (
        with_time_unit(df.withColumn("numvals", value_count(df, counted)), unit)
        .withColumn("_rank", F.row_number().over(ranking))
        .where("_rank = 1")
        .select(*df.columns)
    )


def dedupe_stored(
    df: DataFrame, groups: DataFrame, keys=KEYS, unit: str | None = "second",
    broadcast_bytes: int = BROADCAST_BYTES, **options
) -> DataFrame:
    """As dedupe_events, for events in a table and their duplicate groups, known already.

    Where the groups are few enough to broadcast, only rows of those groups are ranked. All other
    rows, nearly all as a rule, pass without being shuffled; the price is a second reading of
    the table. Where they are not, all rows are ranked in one shuffle, as by dedupe_events.
    """
    small = is_small(with_group(groups, keys).select(GROUP), broadcast_bytes)
    if not small:
        return dedupe_events(df, keys, unit, **options)
    marked = with_time_unit(df, unit)
    side = groups.select(*keys, TIME_UNIT)
    single = join_groups(marked, side, keys, "left_anti", small=small).drop(TIME_UNIT)
    repeated = join_groups(marked, side, keys, "left_semi", small=small).drop(TIME_UNIT)
    return single.unionByName(dedupe_events(repeated, keys, unit, **options))


def _rounded(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return round_even(c, 8)
    return c


def removed_duplicates(df: DataFrame, kept: DataFrame, on=("study_id", "event_id")) -> DataFrame:
    """The rows that de-duplication dropped."""
    return join_facts(df, kept.select(*on), list(on), "left_anti", small=False)


def speed_by_group(df: DataFrame, keys=KEYS) -> DataFrame:
    """For groups with exactly equal times: how their ground speeds differ."""
    speed = F.when(present(df, "ground_speed"), F.col("ground_speed"))
    return (
        with_time_unit(df, None)
        .groupBy(*keys, TIME_UNIT)
        .agg(
            F.count("*").alias("num"),
            F.every(missing(df, "ground_speed")).alias("allna"),
            F.count(speed).alias("numnotna"),
            F.count_distinct(F.struct(round_even(speed, 5))).alias("uniq"),
        )
        .where(F.col("num") > 1)
    )


def duplicates_per_individual(
    df: DataFrame, individual: DataFrame, keys=KEYS, unit: str | None = "second"
) -> DataFrame:
    """Number of duplicate groups of each individual; zero where there is none."""
    owner = [k for k in ("study_id", "individual_id") if k in keys]
    counts = duplicate_groups(df, keys, unit).groupBy(*owner).agg(F.count("*").alias("num"))
    people = individual.select("study_id", "individual_id", "local_identifier")
    return people.join(counts, owner, "left").withColumn("num", F.coalesce("num", F.lit(0)))


def duplicate_total(df: DataFrame, keys=KEYS, unit: str | None = "second") -> DataFrame:
    return duplicate_groups(df, keys, unit).agg(F.count("*").alias("num"))


def groups_larger_than(df: DataFrame, size: int, keys=KEYS, unit: str | None = "second") -> DataFrame:
    groups = duplicate_groups(df, keys, unit)
    return groups.where(F.col("num") > size).agg(F.count("*").alias("num"))


def without_exact_duplicates(df: DataFrame, keys=KEYS) -> DataFrame:
    """Events that share their exact time with no other event of the same keys."""
    groups = stage(duplicate_groups(df, keys, None), "groups")
    marked = with_time_unit(df, None)
    return join_groups(marked, groups, keys, "left_anti").drop(TIME_UNIT)


def near_duplicate_groups(df: DataFrame, keys=KEYS) -> DataFrame:
    """Groups that print the same millisecond although no times are exactly equal.

    Events with an exact copy are left out: exact groups of one are what remains.
    """
    singles = (
        with_time_unit(df, None)
        .groupBy(*keys, TIME_UNIT)
        .agg(F.count("*").alias("_n"))
        .where("_n = 1")
    )
    return (
        singles.groupBy(*keys, millis_text(F.col(TIME_UNIT)).alias("ts_ms"))
        .agg(F.count("*").alias("num"))
        .where(F.col("num") > 1)
    )


def near_duplicate_events(df: DataFrame, keys=KEYS) -> DataFrame:
    """The events of those groups."""
    marked = df.withColumn("ts_ms", millis_text(F.col("timestamp")))
    groups = stage(near_duplicate_groups(df, keys), "near-groups")
    return join_groups(marked, groups, keys, last="ts_ms")

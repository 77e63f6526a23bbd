"""Joining event-sized data to smaller tables without assuming how keys are spread."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.session import stage

# A side is broadcast only when counting it shows that it stays below this many bytes. The driver holds it
# several times over, as often as a plan joins it.
BROADCAST_BYTES = 8 * 1024 * 1024
# A key with more event rows than this is spread over several tasks.
HOT_ROWS = 5_000_000
# Rows without a key match nothing; they are spread over this many tasks.
NULL_KEY_SPREAD = 1024


def _flat_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            out += _flat_columns(f.dataType, f"{prefix}{f.name}.")
        else:
            out.append((prefix + f.name, f.dataType))
    return out


def measured_bytes(df: DataFrame) -> int | None:
    """Size of a frame from one counting pass, or None where a nested type hides it."""
    columns = _flat_columns(df.schema)
    if any(isinstance(kind, (T.ArrayType, T.MapType)) for _, kind in columns):
        return None
    texts = [name for name, kind in columns if isinstance(kind, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.sum(F.octet_length(n)), F.lit(0)) for n in texts]
    row = df.agg(F.count("*"), *sizes).first()
    return row[0] * 16 * (len(columns) + 1) + sum(row[1:])


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= limit


def hot_keys(facts: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than hot_rows rows, and over how many tasks to spread each.

    Counts are built per task before the shuffle. There are at most (rows / hot_rows) such keys.
    """
    return (
        facts.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_spread"))
    )


def staged_hot_keys(facts: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    return stage(hot_keys(facts.na.drop(subset=on), on, hot_rows), "hot-keys")


def join_facts(
    facts: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "inner",
    condition: Column | None = None,
    small: bool | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join event-sized facts with a side table on equal keys.

    A side shown to be small is broadcast, so the facts are not shuffled. Otherwise both are
    shuffled on the keys; the rows of a hot key are spread by a hash of the whole fact row and
    its partition, and the side rows of that key (only those) are repeated once per part. Each fact row is in
    exactly one part, so every join type keeps its meaning. `condition` is a further predicate
    on the matched pair; it refers to columns by name. `small` tells what an earlier size check
    found, or that the side is as large as the facts; `hot` holds the hot keys where they were counted before.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat side rows")
    if small is None:
        small = is_small(side, broadcast_bytes)
    if small:
        return _join(facts, F.broadcast(side), on, how, condition)

    if hot is None:
        hot = staged_hot_keys(facts, on, hot_rows)
    any_hot = not hot.isEmpty()
    keeps_unmatched = how in ("left", "left_anti")
    if not any_hot and not keeps_unmatched:
        return _join(facts, side, on, how, condition)
    return _join(
        _spread_facts(facts, hot, on), _repeat_side(side, hot, on), [*on, "_part"], how, condition
    ).drop("_part")


def _spread_facts(facts: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """Give each fact row its part: by row hash for hot and for missing keys, else 0.

    The hash takes in the number of the partition that holds the row, so equal rows go to as many
    parts as they lie in partitions; a task that runs again gives its rows the same parts.
    """
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(n) for n in facts.columns])
    part = (
        F.when(no_key, F.pmod(row_hash, F.lit(NULL_KEY_SPREAD)))
        .when(F.col("_spread").isNotNull(), F.pmod(row_hash, F.col("_spread")))
        .otherwise(F.lit(0))
    )
    marked = facts.join(_hint_if_small(hot), on, "left")
    return marked.withColumn("_part", part.cast("int")).drop("_spread")


def _repeat_side(side: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """Repeat the side rows of hot keys once per part."""
    parts = F.sequence(F.lit(0), F.coalesce("_spread", F.lit(1)) - 1)
    marked = side.join(_hint_if_small(hot), on, "left")
    return marked.withColumn("_part", F.explode(parts)).drop("_spread")


def _hint_if_small(hot: DataFrame) -> DataFrame:
    return F.broadcast(hot) if is_small(hot) else hot


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, condition) -> DataFrame:
    if condition is None:
        return left.join(right, on, how)
    if how == "inner":
        return left.join(right, on, how).where(condition)
    # The predicate belongs to the match, so the key columns of the side get other names.
    renamed = right.withColumnsRenamed({n: f"_side_{n}" for n in on})
    match = condition
    for n in on:
        match = match & (F.col(n) == F.col(f"_side_{n}"))
    return left.join(renamed, match, how).drop(*[f"_side_{n}" for n in on])



"""The tables: Parquet folders, filled by loads that become visible together.

Rows lie under `<root>/<entity>/load_id=<load>/study_id=<study>/`. The folder
`<root>/commits` lists which (load, study, table) are live. A load writes all its rows first;
one small append to the commits then shows all six tables of all its studies at once, and a
delete is an append as well. Readers prune to live folders.
"""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators.joins import is_small, join_facts
from tracklake.operators.shape import conform
from tracklake.schema import ENTITIES, EVENT_STATS_SCHEMA, PRIMARY_KEY, empty_table, table_schema
from tracklake.session import stage
from tracklake.sources.raw import balanced_by_study

# Buckets of the ids of a table; a store keeps the number it was made with.
ID_BUCKETS = {"event": 64}
FEW_BUCKETS = 8
COMMIT_SCHEMA = "seq bigint, load_id string, study_id bigint, entity string, state string"
STATE_SCHEMA = (
    "load_id string, study_id bigint, individual_id bigint, num bigint, ts_min timestamp, ts_max timestamp, lon_min double, "
    "lon_max double, lon_sum double, lon_num bigint, lat_min double, lat_max double, lat_sum double, lat_num bigint"
)
SORT_WITHIN = {"event": ("individual_id", "timestamp")}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something under a path, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables with their fixed columns, where there are none yet."""
    for entity in ENTITIES:
        empty = empty_table(spark, entity).withColumn("load_id", F.lit(""))
        _writer(empty).mode("ignore").parquet(f"{root}/{entity}")
    spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").parquet(f"{root}/commits")
    spark.createDataFrame([], STATE_SCHEMA).write.mode("ignore").parquet(f"{root}/event_states")
    spark.createDataFrame([], EVENT_STATS_SCHEMA).write.mode("ignore").parquet(f"{root}/event_indiv_stats")


def _writer(df: DataFrame):
    return df.write.partitionBy("load_id", "study_id")


def new_load_id() -> str:
    return uuid.uuid4().hex


def append_rows(df: DataFrame, root: str, entity: str, load_id: str) -> DataFrame:
    """Write rows of a load, by column name. Returns the rows written per study.

    The count reads what was written (file footers), so it holds after lost executors too.
    """
    rows = conform(df, entity)
    balanced = balanced_by_study(rows, SORT_WITHIN.get(entity, ()))
    _writer(balanced.withColumn("load_id", F.lit(load_id))).mode("append").parquet(f"{root}/{entity}")
    written = staged_rows(df.sparkSession, root, entity, load_id)
    _append_ids(written, root, entity, load_id)
    return written.groupBy("study_id").agg(F.count("*").alias("num"))


@contextmanager
def _id_table(spark: SparkSession, root: str, entity: str, buckets: int):
    """A name for the bucketed folder of ids, known to the catalog for a moment only."""
    name = f"ids_{uuid.uuid4().hex}"
    spark.sql(
        f"create table {name} (id bigint, load_id string, study_id bigint) using parquet "
        f"clustered by (id) sorted by (id) into {buckets} buckets location '{root}/ids/{entity}-{buckets}'"
    )
    try:
        yield name
    finally:
        spark.sql(f"drop table {name}")


def _buckets_of(spark: SparkSession, root: str, entity: str) -> int | None:
    """Number of buckets that the ids of a table are kept in, which is part of the folder's name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/ids/{entity}-*")
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
    return int(found[0].getPath().getName().rsplit("-", 1)[1]) if found else None


def _append_ids(rows: DataFrame, root: str, entity: str, load_id: str) -> None:
    """Add the ids of a load to the index: hashed into buckets and sorted."""
    spark = rows.sparkSession
    buckets = _buckets_of(spark, root, entity) or ID_BUCKETS.get(entity, FEW_BUCKETS)
    ids = rows.select(F.col(PRIMARY_KEY[entity]).alias("id"), F.lit(load_id).alias("load_id"), "study_id").where("id is not null")
    with _id_table(spark, root, entity, buckets) as name:
        ids.repartition(buckets, "id").write.insertInto(name)


def id_index(spark: SparkSession, root: str) -> dict[str, tuple[DataFrame, int]]:
    """Live ids (id, load_id, study_id) of each table and their number of buckets; a join on id does not move them."""
    live = stage(live_parts(spark, root), "live")
    small, out = is_small(live), {}
    for entity in ENTITIES:
        buckets = _buckets_of(spark, root, entity)
        if buckets is None:
            continue
        with _id_table(spark, root, entity, buckets) as name:
            ids = spark.table(name)
        parts = live.where(F.col("entity") == entity).select("load_id", "study_id")
        out[entity] = join_facts(ids, parts, ["load_id", "study_id"], "left_semi", small=small), buckets
    return out


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("study_id",)) -> int:
    """Append to one plain table by column name; returns how many rows it grew by."""
    spark = df.sparkSession
    schema = df.schema
    before = spark.read.schema(schema).parquet(path).count() if exists(spark, path) else 0
    balanced = balanced_by_study(df) if partition_by == ("study_id",) else df
    balanced.write.mode("append").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path).count() - before


def _all_rows(spark: SparkSession, root: str, entity: str) -> DataFrame:
    schema = T.StructType([*table_schema(entity).fields, T.StructField("load_id", T.StringType())])
    return spark.read.schema(schema).parquet(f"{root}/{entity}")


def staged_rows(spark: SparkSession, root: str, entity: str, load_id: str) -> DataFrame:
    """Rows of one load, whether visible or not."""
    rows = _all_rows(spark, root, entity).where(F.col("load_id") == load_id)
    return rows.select(*table_schema(entity).names)


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/commits")


def live_parts(spark: SparkSession, root: str, entity: str | None = None) -> DataFrame:
    """The (load, study, table) that count: those whose latest commit says so."""
    commits = read_commits(spark, root)
    if entity is not None:
        commits = commits.where(F.col("entity") == entity)
    latest = commits.groupBy("load_id", "study_id", "entity").agg(F.max_by("state", "seq").alias("state"))
    return latest.where(F.col("state") == "live").drop("state")


def _visible(spark: SparkSession, root: str, entity: str, live: DataFrame, small: bool) -> DataFrame:
    parts = live.where(F.col("entity") == entity).select("load_id", "study_id")
    rows = _all_rows(spark, root, entity)
    rows = join_facts(rows, parts, ["load_id", "study_id"], "left_semi", small=small)
    return rows.select(*table_schema(entity).names)


def read_table(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The visible rows of a table."""
    live = live_parts(spark, root, entity)
    return _visible(spark, root, entity, live, is_small(live))


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    live = stage(live_parts(spark, root), "live")
    small = is_small(live)
    return {entity: _visible(spark, root, entity, live, small) for entity in ENTITIES}


def commit(parts: DataFrame, root: str) -> None:
    """Append (load, study, table, state) lines in one file: all of them show, or none."""
    spark = parts.sparkSession
    last = read_commits(spark, root).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    lines = parts.select(
        F.lit(last + 1).cast("bigint").alias("seq"), "load_id", "study_id", "entity", "state"
    )
    lines.coalesce(1).write.mode("append").parquet(f"{root}/commits")


def append_states(spark: SparkSession, root: str, load_id: str) -> None:
    """Partial statistics per individual of a load's events, which can be merged with those of other loads."""
    events = staged_rows(spark, root, "event", load_id)
    parts = [F.count("*").alias("num"), F.min("timestamp").alias("ts_min"), F.max("timestamp").alias("ts_max")]
    for c in ("lon", "lat"):
        parts += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_num")]
    states = events.groupBy("study_id", "individual_id").agg(*parts).withColumn("load_id", F.lit(load_id))
    states.select(*[f.split()[0] for f in STATE_SCHEMA.split(", ")]).write.mode("append").parquet(f"{root}/event_states")


def merged_stats(spark: SparkSession, root: str) -> DataFrame:
    """Statistics per individual over all live loads, from the stored states alone.

    A deleted study's states are not live any more, so nothing has to be taken back.
    """
    states = spark.read.schema(STATE_SCHEMA).parquet(f"{root}/event_states")
    live = live_parts(spark, root, "event").select("load_id", "study_id")
    states = join_facts(states, live, ["load_id", "study_id"], "left_semi")
    mean = lambda c: (F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_num"), F.lit(0))).alias(f"{c}_mean")
    sides = [x for c in ("lon", "lat") for x in (F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"), mean(c))]
    merged = states.groupBy("individual_id").agg(F.min("ts_min").alias("ts_min"), F.max("ts_max").alias("ts_max"), *sides)
    return merged.select(*[f.split()[0] for f in EVENT_STATS_SCHEMA.split(", ")])


def write_event_stats(stats: DataFrame, root: str) -> None:
    """Append rows to the statistics table; its key is the individual, which must be new to it."""
    spark, path = stats.sparkSession, f"{root}/event_indiv_stats"
    if exists(spark, path):
        known = read_event_stats(spark, root).select("individual_id")
        if not join_facts(known, stats.select("individual_id"), ["individual_id"], "left_semi").isEmpty():
            raise ValueError("the table has statistics of some of these individuals")
    names = [f.split()[0] for f in EVENT_STATS_SCHEMA.split(", ")]
    stats.select(*names).write.mode("append").parquet(f"{root}/event_indiv_stats")


def read_event_stats(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(EVENT_STATS_SCHEMA).parquet(f"{root}/event_indiv_stats")


def keep_as_view(df: DataFrame, name: str) -> DataFrame:
    """A named result other queries reuse, such as event counts per individual."""
    kept = df.persist()
    kept.createOrReplaceTempView(name)
    return kept

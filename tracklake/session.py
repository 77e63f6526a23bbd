"""Session settings the library relies on, and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


# What a task reads of a shuffle (of files four times that), and into how many parts a shuffle is cut before small ones are put together.
TASK_BYTES = 8 * 1024 * 1024
SHUFFLE_PARTS = 512
# Spark goes by the size of files, of which rows in memory take a multiple; larger sides are broadcast by join_facts alone.
AUTO_BROADCAST_BYTES = 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """All times are UTC; adaptive execution stays on for skewed joins and writes, with tasks of bounded size.

    Left to itself it makes as few parts as there are cores, and a task's memory grows with the tables.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(SHUFFLE_PARTS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(4 * TASK_BYTES))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(AUTO_BROADCAST_BYTES))
    return spark


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tracklake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tracklake-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local folder would not be seen by the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# Folders staged in the open scope, by the frame that reads them.
_staged: ContextVar[dict[int, str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The result no longer depends on how it was computed, so losing executors later costs a
    re-read, and readers take only the columns they need. Within a scope() the folder is removed at its end.
    There is a folder for each value of the columns `by`.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if (own := _staged.get()) is not None:
        own[id(out)] = path
    return out


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scope(spark: SparkSession):
    """Removes what is staged inside once the block ends, but for the frames given to the function it yields.

    Those stay for the scope around it, or for good. Only frames that were returned by stage() can be kept, and
    nothing that reads the others may be used later. Shuffle files of finished jobs go with them.
    """
    own: dict[int, str] = {}
    token, kept = _staged.set(own), {}

    def keep(frame: DataFrame) -> DataFrame:
        kept[id(frame)] = own.pop(id(frame))
        return frame

    try:
        yield keep
    finally:
        _staged.reset(token)
        if (around := _staged.get()) is not None:
            around.update(kept)
        for path in own.values():
            remove_folder(spark, path)
        spark._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()

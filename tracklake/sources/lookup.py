"""Small control files: which studies to run, sensor types, and the status log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.schema import SENSOR_TYPE_SCHEMA, STATUS_SCHEMA


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the studies marked to run. Other columns of the file do not matter."""
    return studies_to_run(spark.read.csv(path, header=True))


def studies_to_run(control: DataFrame) -> DataFrame:
    run = F.trim(F.col("run").cast("string")).try_cast("int")
    return control.where(run == 1).select(F.col("study_id").cast("string").try_cast("bigint").alias("study_id"))


def read_sensor_types(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SENSOR_TYPE_SCHEMA, enforceSchema=False)


def append_status(status: DataFrame, path: str) -> None:
    """Add lines (study, step, result) to the log."""
    status.select("study_id", "step", "result").coalesce(1).write.mode("append").csv(path, header=True)


def job_state(spark: SparkSession, path: str) -> DataFrame:
    """(study_id, step, result, at): the latest line of each study and step, and when it was added.

    A line is as old as its file; every append makes files of its own.
    """
    lines = spark.read.csv(path, header=True, schema=STATUS_SCHEMA)
    lines = lines.select("*", F.col("_metadata.file_modification_time").alias("at"))
    return lines.groupBy("study_id", "step").agg(F.max_by("result", "at").alias("result"), F.max("at").alias("at"))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=STATUS_SCHEMA)

"""Settings that keep tasks and the driver small."""

from pyspark.sql import functions as F

from tracklake import session


def test_a_shuffle_is_cut_by_its_size_not_by_the_cores(spark, monkeypatch):
    """Twenty megabytes and more of keys, in tasks of one."""
    groups = spark.range(2_000_000).select(F.xxhash64("id").alias("key")).groupBy("key").agg(F.count("*").alias("num"))
    monkeypatch.setattr(session, "TASK_BYTES", 1024 * 1024, raising=False)
    session.configure(spark)
    try:
        # More than the four partitions of the test session.
        assert groups.rdd.getNumPartitions() > 8
    finally:
        monkeypatch.undo()
        session.configure(spark)


def test_files_of_a_few_megabytes_are_not_broadcast_unmeasured(spark, tmp_path):
    """Random numbers of 2 to 4 MB: rows in memory take far more."""
    for name in ("left", "right"):
        spark.range(250_000).select("id", F.rand(1).alias("x")).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    session.configure(spark)
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    joined = left.join(right.select("id"), "id", "left_semi")
    assert "Broadcast" not in joined._jdf.queryExecution().sparkPlan().toString()

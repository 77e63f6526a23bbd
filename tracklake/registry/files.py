"""Raw files with other headers, lost values and broken lines (A1 to A3, K3)."""

from pyspark.sql import functions as F

from tracklake.plans.load import run
from tracklake.registry import jobs  # noqa: F401  (its relations come first)
from tracklake.registry.base import query
from tracklake.registry.mapping import AS_OF, Testbed
from tracklake.schema import ENTITIES
from tracklake.session import scratch_path
from tracklake.sources import files, raw


def write_headers(df, root: str, entity: str, names: list[str]) -> None:
    """One folder per study, columns under these names and in this order."""
    df.select(*names, "study_id").write.mode("append").partitionBy("study_id").csv(f"{root}/{entity}", header=True)


def read(t: Testbed, root: str):
    return files.read_files(t.spark, files.list_raw(t.spark, root, "partitions"), "partitions")


def tags_in_three_orders(t: Testbed, root: str) -> None:
    tag = t.tag.withColumnRenamed("tag_id", "id").withColumn("colour", F.lit("red")).withColumn("model", F.lit(None).cast("string"))
    orders = (
        ["id", "local_identifier", "manufacturer_name", "model"],
        ["colour", "manufacturer_name", "local_identifier", "id"],
        ["model", "id", "local_identifier"],
    )
    for rest, names in enumerate(orders):
        write_headers(tag.where(f"study_id % 3 = {rest}"), root, "tag", names)


@query(
    "A1 A2",
    "select tag_id, local_identifier, case when study_id % 3 <> 2 then manufacturer_name end as manufacturer_name, study_id from m_tag",
)
def tags_by_header(t: Testbed):
    """Columns swapped, missing and added, by study."""
    root = scratch_path(t.spark, "raw")
    tags_in_three_orders(t, root)
    return files.without_marks(read(t, root).tables["tag"]).select("tag_id", "local_identifier", "manufacturer_name", "study_id")


@query(
    "A1 A18",
    "select study_id, 'manufacturer_name' as column, count(distinct study_id) > 0 as found from m_tag where study_id % 3 = 2 group by 1 "
    "union all select study_id, 'model', true from m_tag where study_id % 3 = 1 group by 1",
)
def missing_columns(t: Testbed):
    root = scratch_path(t.spark, "raw")
    tags_in_three_orders(t, root)
    lines = read(t, root).problems.where("kind = 'column' and column in ('manufacturer_name', 'model')")
    return lines.groupBy("study_id", "column").agg((F.sum("num") > 0).alias("found"))


def _events_with_broken_cells(t: Testbed, root: str) -> None:
    broken = {"ground_speed": ("event_id % 13 = 0", "fast"), "lon": ("event_id % 17 = 0", "1,5"), "timestamp": ("event_id % 23 = 0", "noon")}
    events = raw.time_columns_as_text(t.raw_event)
    for name, (where, text) in broken.items():
        events = events.withColumn(name, F.when(F.expr(where), F.lit(text)).otherwise(F.col(name).cast("string")))
    raw.write_raw(events, root, "event")


@query(
    "A3 K3",
    "select study_id, 'value' as kind, 'ground_speed' as column, count(*) as num from m_raw where event_id % 13 = 0 and study_id is not null group by 1 "
    "union all select study_id, 'value', 'location_long', count(*) from m_raw where event_id % 17 = 0 and study_id is not null group by 1 "
    "union all select study_id, 'value', 'timestamp', count(*) from m_raw where event_id % 23 = 0 and study_id is not null group by 1",
)
def lost_values(t: Testbed):
    """Text that did not fit its column, counted per file and column."""
    root = scratch_path(t.spark, "raw")
    _events_with_broken_cells(t, root)
    lost = files.lost_in(read(t, root).tables["event"], "event")
    return lost.groupBy("study_id", "kind", "column").agg(F.sum("num").alias("num"))


@query(
    "C21 K1 K3",
    "select study_id, count(*) filter (where event_id % 13 = 0) as lost_speeds, count(*) filter (where event_id % 17 = 0) as lost_places "
    "from m_raw where study_id is not null group by 1 having lost_speeds > 0 or lost_places > 0",
)
def problems_of_cleaning(t: Testbed):
    """The same, as cleaning reports it from the events it has written anyway."""
    root = scratch_path(t.spark, "raw")
    _events_with_broken_cells(t, root)
    for entity in ENTITIES:
        if entity != "event":
            raw.write_raw(t.raw[entity], root, entity)
    found = read(t, root)
    lines = jobs.clean(found.tables, as_of=AS_OF, problems=found.problems).problems.where("kind = 'value'")
    of = lambda name: F.sum(F.when(F.col("column") == name, F.col("num")).otherwise(0))
    counts = lines.groupBy("study_id").agg(of("ground_speed").alias("lost_speeds"), of("location_long").alias("lost_places"))
    return counts.where("lost_speeds > 0 or lost_places > 0")


def _sensors_with_broken_lines(t: Testbed):
    """Every seventh sensor's line has a cell too many, every eleventh other one too few."""
    line = (
        "case when sensor_id % 7 = 0 then concat(sensor_id, ',', sensor_type_id, ',', tag_id, ',x') "
        "when sensor_id % 11 = 0 then concat(sensor_id, ',', sensor_type_id) else concat(sensor_id, ',', sensor_type_id, ',', tag_id) end"
    )
    lines = t.sensor.selectExpr("study_id", "1 as place", f"{line} as value")
    heads = t.study.selectExpr("study_id", "0 as place", "'id,sensor_type_id,tag_id' as value").join(lines, "study_id", "left_semi")
    root = scratch_path(t.spark, "raw")
    ordered = heads.unionByName(lines).repartition("study_id").sortWithinPartitions("study_id", "place")
    ordered.select("study_id", "value").write.partitionBy("study_id").text(f"{root}/sensor")
    return root


@query(
    "A3 K3",
    "select study_id, case when sensor_id % 7 = 0 then concat(sensor_id, ',', sensor_type_id, ',', tag_id, ',x') "
    "else concat(sensor_id, ',', sensor_type_id) end as line from m_sensor where sensor_id % 7 = 0 or sensor_id % 11 = 0",
)
def broken_lines(t: Testbed):
    """Lines with another number of cells, set aside with their study."""
    root = _sensors_with_broken_lines(t)
    return files.lines_in(read(t, root).tables["sensor"], "sensor").select("study_id", "line")


@query(
    "A1 K3",
    "select sensor_id, sensor_type_id, tag_id, study_id from m_sensor where sensor_id % 7 <> 0 and sensor_id % 11 <> 0",
)
def rows_beside_broken_lines(t: Testbed):
    root = _sensors_with_broken_lines(t)
    return files.without_marks(read(t, root).tables["sensor"]).select("sensor_id", "sensor_type_id", "tag_id", "study_id")


_BAD = "(study_id in (select study_id from m_failed) or study_id in (4, 8))"


@query(
    "K2 K3",
    f"select study_id, 'clean' as step, case when {_BAD} then 'fail' else 'success' end as result from m_study "
    f"union all select study_id, 'import', 'success' from m_study where not {_BAD}",
)
def load_with_unreadable_files(t: Testbed):
    """Study 4's tags have no id, study 8 names a column of its sensors twice; the others go on."""
    root = scratch_path(t.spark, "raw")
    for entity in ENTITIES:
        df = t.raw[entity]
        raw.write_raw(df.where("study_id is not null and study_id not in (4, 8)") if entity in ("tag", "sensor") else df, root, entity)
    names = ["local_identifier", "manufacturer_name"]
    write_headers(t.tag.where("study_id = 4"), root, "tag", names)
    write_headers(t.tag.where("study_id = 8").withColumnRenamed("tag_id", "id"), root, "tag", ["id", *names])
    sensor = t.sensor.withColumnRenamed("sensor_id", "id")
    write_headers(sensor.where("study_id = 4"), root, "sensor", ["id", "sensor_type_id", "tag_id"])
    twice = sensor.where("study_id = 8").select("id", F.col("id").alias("id "), "sensor_type_id", "tag_id", "study_id")
    twice.write.mode("append").partitionBy("study_id").option("ignoreTrailingWhiteSpace", True).csv(f"{root}/sensor", header=True)
    clean_root, table_root = scratch_path(t.spark, "clean"), scratch_path(t.spark, "tables")
    return run(t.spark, root, clean_root, table_root, "ci", as_of=AS_OF, layout="partitions")

"""Scans and sinks (A1 to A18): the mapped tables go out to files and come back."""

from pyspark.sql import functions as F

from tracklake.functions.values import present
from tracklake.operators import reports
from tracklake.operators.filters import event_rules, keep_valid
from tracklake.operators.shape import conform
from tracklake.registry.base import query
from tracklake.registry.joins import located
from tracklake.registry.mapping import AS_OF, RAW_EVENT, Testbed
from tracklake.session import scratch_path
from tracklake.sources import lookup, raw, tables


def snapshot(t: Testbed, entity: str):
    """Raw rows written as CSV, one folder per study, and read again."""
    root = scratch_path(t.spark, "raw")
    raw.write_raw(t.raw[entity], root, entity)
    return raw.read_raw_snapshot(t.spark, root, entity)


@query(
    "A1 A18",
    "select individual_id, local_identifier, nick_name, study_id, sex, taxon_canonical_name from m_individual",
)
def raw_individuals(t: Testbed):
    return snapshot(t, "individual").select(
        "individual_id", "local_identifier", "nick_name", "study_id", "sex", "taxon_canonical_name"
    )


@query("A1 A18", "select tag_id, local_identifier, manufacturer_name, study_id from m_tag")
def raw_tags(t: Testbed):
    return snapshot(t, "tag").select("tag_id", "local_identifier", "manufacturer_name", "study_id")


@query("A1 A18", "select sensor_id, sensor_type_id, tag_id, study_id from m_sensor")
def raw_sensors(t: Testbed):
    return snapshot(t, "sensor").select("sensor_id", "sensor_type_id", "tag_id", "study_id")


@query(
    "A1 A18",
    "select deployment_id, nullif(local_identifier, 'NA') as local_identifier, individual_id, tag_id, "
    "{{ts:deploy_on_timestamp}} as deploy_on_timestamp, {{ts:deploy_off_timestamp}} as deploy_off_timestamp, study_id from m_deployment",
)
def raw_deployments(t: Testbed):
    """The text NA comes back as missing."""
    return snapshot(t, "deployment").select(
        "deployment_id", "local_identifier", "individual_id", "tag_id",
        "deploy_on_timestamp", "deploy_off_timestamp", "study_id",
    )


@query(
    "A2 A18",
    "select study_id, study_name, number_of_individuals, {{ts:timestamp_first_deployed_location}} as timestamp_first_deployed_location from m_study",
)
def raw_studies(t: Testbed):
    return snapshot(t, "study").select(
        "study_id", "study_name", "number_of_individuals", "timestamp_first_deployed_location"
    )


MILLIS_SQL = "date_trunc('millisecond', timestamp + interval 500 microseconds)"
_DOUBLES = ("lat", "ground_speed", "eobs_horizontal_accuracy_estimate")


def _raw_event_sql() -> str:
    out = []
    for c in [*RAW_EVENT, "study_id"]:
        if c == "timestamp":
            out.append("{{ts:%s}} as timestamp" % MILLIS_SQL)
        elif c in _DOUBLES:
            out.append(f"case when isnan({c}) then null else {c} end as {c}")
        else:
            out.append(c)
    return f"select {', '.join(out)} from m_raw"


def without_nan(df, names):
    return df.withColumns({n: F.when(present(df, n), F.col(n)) for n in names})


@query("A3 A18", _raw_event_sql())
def raw_events(t: Testbed):
    """All 24 raw columns of all events through CSV; NaN is compared as missing."""
    return without_nan(snapshot(t, "event"), _DOUBLES).select(*RAW_EVENT, "study_id")


@query(
    "A4 H1 H2",
    "select event_id, strftime(timestamp + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g') as ts_str, "
    "{{ts:" + MILLIS_SQL + "}} as timestamp from m_raw",
)
def raw_event_times(t: Testbed):
    root = scratch_path(t.spark, "raw")
    raw.write_raw(t.raw_event, root, "event")
    events = raw.read_raw(t.spark, root, "event", layout="partitions", time_as_text=True)
    return events.select("event_id", "ts_str", "timestamp")


@query("A1 C11", "select tag_id, study_id from m_tag where study_id in (3, 8)")
def raw_tags_of_studies(t: Testbed):
    root = scratch_path(t.spark, "raw")
    raw.write_raw(t.tag, root, "tag")
    return raw.read_raw_by_header(t.spark, root, "tag", [3, 8], layout="partitions").select("tag_id", "study_id")


@query("A7", "select cast(n_nationkey as bigint) as study_id from nation where n_nationkey % 3 = 1")
def control_studies(t: Testbed):
    path = scratch_path(t.spark, "control")
    marked = t.study.selectExpr("study_id", "study_name", "case when study_id % 3 = 1 then 1 else 0 end as run")
    marked.write.csv(path, header=True)
    return lookup.read_control(t.spark, path)


@query(
    "A9 B6",
    "select event_id, lon, lat, {{ts:" + MILLIS_SQL + "}} as timestamp, ground_speed, manually_marked_outlier, visible, "
    "tag_local_identifier, individual_local_identifier, sensor_type from m_ui",
)
def ui_export(t: Testbed):
    """An export whose headers have dashes and other names for the position."""
    path = scratch_path(t.spark, "ui")
    ui = t.ui_event.drop("study_id").withColumnsRenamed({"lon": "location_long", "lat": "location_lat"})
    ui = raw.time_columns_as_text(ui)
    ui.toDF(*[c.replace("_", "-") for c in ui.columns]).write.csv(path, header=True)
    return raw.read_ui_events(t.spark, path)


@query(
    "A10",
    "select event_id, individual_id, lon, lat, {{ts:" + MILLIS_SQL + "}} as timestamp, tag_id, sensor_type_id, study_id from m_good",
)
def clean_csv(t: Testbed):
    root = scratch_path(t.spark, "clean")
    raw.write_csv(conform(keep_valid(t.raw_event, event_rules(AS_OF)), "event"), root, "event")
    return raw.read_clean_csv(t.spark, root, "event").select(
        "event_id", "individual_id", "lon", "lat", "timestamp", "tag_id", "sensor_type_id", "study_id"
    )


@query("A8 A11 A16", "select tag_id, manufacturer_name, study_id from m_tag")
def table_scan(t: Testbed):
    """Two loads of one table, both committed."""
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    for rest in (0, 1):
        load = tables.new_load_id()
        rows = tables.append_rows(t.tag.where(f"study_id % 2 = {rest}"), root, "tag", load)
        parts = rows.selectExpr(f"'{load}' as load_id", "study_id", "'tag' as entity", "'live' as state")
        tables.commit(parts, root)
    return tables.read_table(t.spark, root, "tag").select("tag_id", "manufacturer_name", "study_id")


@query("A11", "select study_id, count(*) as num from m_raw group by study_id")
def appended_rows(t: Testbed):
    """Rows written per study, as counted after the append."""
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    return tables.append_rows(t.raw_event, root, "event", tables.new_load_id())


@query("A8 C11", "select individual_id, study_id from m_individual where study_id = 4")
def appended_table(t: Testbed):
    """A plain table, appended to twice, read for one study."""
    path = scratch_path(t.spark, "table")
    people = t.individual.select("individual_id", "study_id")
    for rest in (0, 1):
        tables.append_table(people.where(f"individual_id % 2 = {rest}"), path)
    return t.spark.read.parquet(path).where("study_id = 4").select(
        "individual_id", F.col("study_id").cast("bigint").alias("study_id")
    )


@query("A12", "select individual_id, local_identifier, nick_name, study_id from m_individual")
def imported_csv(t: Testbed):
    """A clean CSV file with a header, read by its header and appended."""
    folder = scratch_path(t.spark, "csv")
    conform(t.individual, "individual").write.csv(folder, header=True)
    path = scratch_path(t.spark, "table")
    tables.append_table(raw.read_csv_with_header(t.spark, folder, "individual"), path)
    read = t.spark.read.parquet(path)
    return read.select(
        "individual_id", "local_identifier", "nick_name", F.col("study_id").cast("bigint").alias("study_id")
    )


@query(
    "A13",
    "select study_id, 'clean' as step, case when study_id % 5 = 0 then 'fail' else 'success' end as result from m_study "
    "union all select study_id, 'import', 'success' from m_study where study_id % 5 <> 0",
)
def status_log(t: Testbed):
    path = scratch_path(t.spark, "status")
    cleaned = t.study.selectExpr(
        "study_id", "'clean' as step", "case when study_id % 5 = 0 then 'fail' else 'success' end as result"
    )
    lookup.append_status(cleaned, path)
    passed = cleaned.where("result = 'success'")
    lookup.append_status(passed.select("study_id", F.lit("import").alias("step"), "result"), path)
    return lookup.read_status(t.spark, path)


@query(
    "A14 E9",
    "select individual_id, {{ts:min(timestamp)}} as ts_min, {{ts:max(timestamp)}} as ts_max, min(lon) as lon_min, max(lon) as lon_max, "
    "avg(lon) as lon_mean, min(lat) as lat_min, max(lat) as lat_max, avg(lat) as lat_mean from m_ship group by individual_id",
)
def stored_stats(t: Testbed):
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    tables.write_event_stats(reports.individual_stats(t.ship), root)
    return tables.read_event_stats(t.spark, root)


@query(
    "A15 E11",
    "select i.study_id, study_name, count(*) as num from m_ship e join m_individual i on e.individual_id = i.individual_id "
    "join m_study s on i.study_id = s.study_id group by all",
)
def counts_from_view(t: Testbed):
    """Counts per individual kept as a view, then summed per study."""
    counts = reports.events_by_individual(t.ship).select("individual_id", "num")
    kept = tables.keep_as_view(counts, "event_ind_count")
    return reports.events_per_study_name(kept, t.individual, t.study)


@query("K6 A8", "select event_id, study_id from m_located")
def stored_located_events(t: Testbed):
    """Located fixes through the event table."""
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    load = tables.new_load_id()
    rows = tables.append_rows(located(t), root, "event", load)
    tables.commit(rows.selectExpr(f"'{load}' as load_id", "study_id", "'event' as entity", "'live' as state"), root)
    return tables.read_table(t.spark, root, "event").select("event_id", "study_id")

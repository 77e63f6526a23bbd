"""Exports resolved by time, loads that go on where they stopped, rows at any depth."""

from pyspark.sql import functions as F

from tracklake.operators.identify import identifier_violations, resolve_by_time
from tracklake.operators.positions import sorted_ranges
from tracklake.plans.export import clean_export
from tracklake.plans.load import resume, run
from tracklake.registry import jobs  # noqa: F401  (its relations come first)
from tracklake.registry.base import query
from tracklake.registry.mapping import AS_OF, BAD_SQL, GROUP, INSIDE_SQL, RELATIONS, Testbed
from tracklake.registry.sources import without_nan
from tracklake.schema import ENTITIES
from tracklake.session import scratch_path
from tracklake.sources import raw

# Tags of which individuals share a name in pairs, `{n}` being the number of the tag.
SHARED = {"many": "floor({n} / 8) % 3 = 1", "few": "floor({n} / 8) % 300 = 7"}
NUMBER = "cast(substr(tag_local_identifier, 3) as bigint)"


def shared_name(kind: str, number: str, name: str) -> str:
    return f"case when {SHARED[kind].format(n=number)} then concat('S-', cast(floor({number} / 2) as bigint)) else {name} end"


for _kind in SHARED:
    RELATIONS[f"x_tag_{_kind}"] = (
        f"select tag_id, {shared_name(_kind, 'tag_id', 'local_identifier')} as local_identifier, study_id from m_tag"
    )
    RELATIONS[f"x_named_{_kind}"] = (
        "select event_id, lon, lat, timestamp, ground_speed, manually_marked_outlier, visible, "
        f"{shared_name(_kind, NUMBER, 'tag_local_identifier')} as tag_local_identifier, individual_local_identifier, sensor_type, study_id from m_ui"
    )
    # Every deployment under the names at the time, without intervals.
    RELATIONS[f"x_match_{_kind}"] = (
        "select u.event_id, count(distinct d.tag_id) as candidates, min(d.tag_id) as tag_id, min(d.individual_id) as individual_id "
        f"from x_named_{_kind} u join x_tag_{_kind} t on u.tag_local_identifier = t.local_identifier and u.study_id = t.study_id "
        "join m_individual i on u.individual_local_identifier = i.local_identifier and u.study_id = i.study_id "
        "join m_deployment d on d.tag_id = t.tag_id and d.individual_id = i.individual_id and d.study_id = u.study_id "
        f"where {INSIDE_SQL} group by u.event_id"
    )
    RELATIONS[f"x_resolved_{_kind}"] = (
        "select u.event_id, u.study_id, u.lon, u.lat, u.timestamp, u.ground_speed, u.manually_marked_outlier, u.visible, "
        "case when m.candidates = 1 then m.tag_id end as tag_id, case when m.candidates = 1 then m.individual_id end as individual_id, "
        "cast(y.id as bigint) as sensor_type_id, case when s.n = 1 then s.sensor_id end as sensor_id, "
        "coalesce(m.candidates, 0) as candidates, coalesce(s.n, 0) as sensors "
        f"from x_named_{_kind} u left join x_match_{_kind} m on u.event_id = m.event_id "
        "left join m_sensor_type y on lower(y.name) = lower(u.sensor_type) left join "
        "(select study_id, tag_id, sensor_type_id, count(distinct sensor_id) as n, min(sensor_id) as sensor_id from m_sensor group by all) s "
        "on m.candidates = 1 and s.study_id = u.study_id and s.tag_id = m.tag_id and s.sensor_type_id = y.id"
    )
RELATIONS["x_located"] = (
    "select e.*, d.deploy_on_timestamp, d.deploy_off_timestamp from (select * from (select *, cast(null as varchar) as eobs_status "
    f"from x_resolved_few) where ({BAD_SQL}) is null and not coalesce(manually_marked_outlier, false)) e join m_kept_deployment d "
    f"on e.study_id = d.study_id and e.individual_id = d.individual_id and e.tag_id = d.tag_id where {INSIDE_SQL}"
)
RELATIONS["x_failed"] = (
    RELATIONS["m_failed"].replace("m_located", "x_located").replace("m_raw", "x_resolved_few")
    + " union select study_id from x_resolved_few where candidates > 1"
)


def shared_tags(t: Testbed, kind: str):
    name = F.expr(shared_name(kind, "tag_id", "local_identifier"))
    return t.tag.withColumn("local_identifier", name)


def named_export(t: Testbed, kind: str):
    return t.ui_event.withColumn("tag_local_identifier", F.expr(shared_name(kind, NUMBER, "tag_local_identifier")))


def by_time(t: Testbed):
    export = named_export(t, "many")
    return resolve_by_time(export, t.deployment, shared_tags(t, "many"), t.individual, t.sensor, t.sensor_types)


@query("D13 A9", "select event_id, tag_id, individual_id, sensor_type_id, sensor_id, candidates, sensors from x_resolved_many")
def identified_by_time(t: Testbed):
    """Tags of a third of the individuals share names; the one deployed at the time is meant."""
    return by_time(t).select("event_id", "tag_id", "individual_id", "sensor_type_id", "sensor_id", "candidates", "sensors")


@query(
    "J14",
    "select study_id, 'identifier_ambiguous' as check, cast(count(*) as varchar) as detail from x_resolved_many where candidates > 1 group by 1 "
    "union all select study_id, 'identifier_unknown', cast(count(*) as varchar) from x_resolved_many where candidates = 0 group by 1 "
    "union all select study_id, 'identifier_sensor', cast(count(*) as varchar) from x_resolved_many where candidates = 1 and sensors <> 1 group by 1",
)
def ambiguous_identifiers(t: Testbed):
    return identifier_violations(by_time(t)).select("study_id", "check", "detail")


@query(
    "A9 D13 K1",
    "select event_id, study_id, individual_id, tag_id, sensor_type_id, lon, lat, {{ts:timestamp}} as timestamp, "
    "case when isnan(ground_speed) then null else ground_speed end as ground_speed from (select *, row_number() over (partition by "
    f"{GROUP}, date_trunc('second', timestamp) order by (case when ground_speed is not null and not isnan(ground_speed) then 1 else 0 end) + "
    "(case when visible is not null then 1 else 0 end) + (case when manually_marked_outlier is not null then 1 else 0 end) desc, timestamp, event_id) as rn "
    "from x_located) where rn = 1 and study_id not in (select study_id from x_failed)",
)
def cleaned_export(t: Testbed):
    """From an export to clean events; studies with names that stay ambiguous fail."""
    entities = {**t.raw, "tag": shared_tags(t, "few")}
    event = clean_export(named_export(t, "few"), entities, t.sensor_types, as_of=AS_OF).tables["event"]
    return without_nan(event, ["ground_speed"]).select(
        "event_id", "study_id", "individual_id", "tag_id", "sensor_type_id", "lon", "lat", "timestamp", "ground_speed"
    )


_GOOD = "from m_study where study_id not in (select study_id from m_failed)"


@query(
    "K2 A13",
    "select study_id, 'clean' as step, 'fail' as result from m_failed union all "
    f"select study_id, 'import', 'success' {_GOOD} and study_id % 2 = 1 union all select study_id, 'validate', 'success' {_GOOD}",
)
def resumed_load(t: Testbed):
    """All studies were cleaned and those with even ids imported; the rest is taken up from the status log."""
    clean_root, table_root, log = (scratch_path(t.spark, n) for n in ("clean", "tables", "status"))
    run(t.spark, t.raw, clean_root, table_root, "c", status_path=log, as_of=AS_OF)
    run(t.spark, t.raw, clean_root, table_root, "i", t.study.where("study_id % 2 = 0"), status_path=log)
    return resume(t.spark, t.raw, clean_root, table_root, log, as_of=AS_OF)


@query(
    "K1 A11",
    "select study_id, 'clean' as step, case when study_id in (select study_id from m_failed) then 'fail' else 'success' end as result "
    "from m_study where study_id % 5 = 1 and study_id in (select study_id from m_raw)",
)
def changed_studies(t: Testbed):
    """A second run after the event files of every fifth study were written anew cleans those alone."""
    raw_root, clean_root, table_root, kept = (scratch_path(t.spark, n) for n in ("raw", "clean", "tables", "manifest"))
    for entity in ENTITIES:
        raw.write_raw(t.raw[entity], raw_root, entity)
    again = {"layout": "partitions", "manifest_path": kept, "as_of": AS_OF}
    run(t.spark, raw_root, clean_root, table_root, "c", **again)
    raw.write_raw(t.raw_event.where("study_id % 5 = 1"), raw_root, "event")
    return run(t.spark, raw_root, clean_root, table_root, "c", **again)


@query(
    "G4 G1",
    "select position, l_orderkey, l_linenumber, d from (select l_orderkey, l_linenumber, d, row_number() over "
    "(order by l_orderkey, l_linenumber, d) as position, count(*) over () as n from lineitem, (select unnest(range(0, 3)) as d)) "
    "where position > floor(n * 0.9) and position <= floor(n * 0.9) + 1000",
)
def deep_positions(t: Testbed):
    """A thousand rows from nine tenths of the way down: beyond row 1,600,000 at sf0.1."""
    rows = t.numbered(t.table("lineitem").select("l_orderkey", "l_linenumber"), "d", 3)
    ordered = sorted_ranges(rows, ["l_orderkey", "l_linenumber", "d"])
    before = ordered.total * 9 // 10
    return ordered.between(before + 1, before + 1000)

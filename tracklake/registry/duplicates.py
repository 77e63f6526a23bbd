"""Duplicate groups, de-duplication and their reports."""

from pyspark.sql import functions as F

from tracklake.functions.values import present, value_count
from tracklake.operators import dedupe
from tracklake.operators.shape import final_event_columns, merge_vendor_columns
from tracklake.registry.base import query
from tracklake.registry.joins import located
from tracklake.registry.mapping import FINAL_TEXT_SQL, GROUP, NUMVALS_SQL, RAW_EVENT, Testbed

SHIP_KEYS = ("individual_id", "tag_id", "sensor_type_id")
RAW_COLUMNS = list(RAW_EVENT)


@query("E5", f"select event_id, {NUMVALS_SQL} as numvals from m_raw")
def values_per_row(t: Testbed):
    return t.raw_event.select("event_id", value_count(t.raw_event, RAW_COLUMNS).alias("numvals"))


@query(
    "E6 E26",
    f"select {GROUP}, strftime(ts_unit, '%Y-%m-%d %H:%M:%S.%f') as ts_unit, num from (select {GROUP}, "
    f"date_trunc('second', timestamp) as ts_unit, count(*) as num from m_located group by all) where num > 1",
)
def duplicate_groups(t: Testbed):
    return dedupe.duplicate_groups(located(t))


@query(
    "E25",
    "select individual_id, tag_id, sensor_type_id, {{ts:timestamp}} as ts_unit, count(*) as num from m_ship "
    "group by individual_id, tag_id, sensor_type_id, timestamp having count(*) > 1",
)
def exact_duplicate_groups(t: Testbed):
    return dedupe.duplicate_groups(t.ship, SHIP_KEYS, None)


@query(
    "E26 unit",
    "select individual_id, tag_id, sensor_type_id, {{ts:date_trunc('hour', timestamp)}} as ts_unit, count(*) as num "
    "from m_raw where timestamp is not null group by individual_id, tag_id, sensor_type_id, date_trunc('hour', timestamp) having count(*) > 1",
)
def duplicate_groups_by_hour(t: Testbed):
    timed = t.raw_event.where(F.col("timestamp").isNotNull())
    return dedupe.duplicate_groups(timed, SHIP_KEYS, "hour")


@query(
    "F3",
    "select individual_id, tag_id, sensor_type_id, {{ts:timestamp}} as ts_unit, num, "
    "row_number() over (order by individual_id, tag_id, sensor_type_id, timestamp) as dup_id from "
    "(select individual_id, tag_id, sensor_type_id, timestamp, count(*) as num from m_ship group by all) where num > 1",
)
def numbered_groups(t: Testbed):
    groups = dedupe.duplicate_groups(t.ship, SHIP_KEYS, None)
    return dedupe.number_groups(groups, [*SHIP_KEYS, dedupe.TIME_UNIT])


@query(
    "F1",
    "select event_id, count(*) over (partition by study_id, individual_id, tag_id, sensor_type_id, "
    "date_trunc('second', timestamp)) as num from m_located",
)
def group_sizes(t: Testbed):
    return dedupe.with_group_size(located(t)).select("event_id", "num")


@query(
    "F2",
    "select event_id from (select *, max(numvals) over (partition by study_id, individual_id, tag_id, sensor_type_id, "
    f"date_trunc('second', timestamp)) as best from (select *, {NUMVALS_SQL} as numvals from m_located)) where numvals = best",
)
def richest_rows(t: Testbed):
    return dedupe.richest_rows(located(t), counted=RAW_COLUMNS).select("event_id")


@query("F4 J11", f"select {FINAL_TEXT_SQL} from m_unique")
def deduplicated_events(t: Testbed):
    """Valid, deployed, de-duplicated fixes in the final columns."""
    out = final_event_columns(merge_vendor_columns(dedupe.dedupe_events(located(t), counted=RAW_COLUMNS)))
    return out.withColumn("ground_speed", F.when(present(out, "ground_speed"), F.col("ground_speed")))


@query("F4 K1", "select event_id from m_unique")
def deduplicated_many_groups(t: Testbed):
    """The same events with their groups held to be too many to broadcast."""
    events = located(t)
    groups = dedupe.duplicate_groups(events)
    return dedupe.dedupe_stored(events, groups, counted=RAW_COLUMNS, broadcast_bytes=0).select("event_id")


SHIP_ORDER = ("timestamp", "lon", "lat", "ground_speed")


@query(
    "F4",
    "select individual_id, tag_id, {{ts:timestamp}} as timestamp, lon, lat, ground_speed from (select *, row_number() over "
    "(partition by individual_id, tag_id, sensor_type_id, date_trunc('month', timestamp) order by "
    "case when ground_speed is null then 0 else 1 end desc, timestamp, lon, lat, ground_speed nulls first) as rn from m_ship) where rn = 1",
)
def deduplicated_ships(t: Testbed):
    """The largest table, one row per tag and month; rows have no id, so all columns break ties."""
    out = dedupe.dedupe_events(t.ship, SHIP_KEYS, "month", order=SHIP_ORDER)
    return out.select("individual_id", "tag_id", "timestamp", "lon", "lat", "ground_speed")


@query(
    "2.13 unit",
    "select event_id from (select *, row_number() over (partition by study_id, individual_id, tag_id, sensor_type_id, timestamp "
    f"order by numvals desc, event_id) as rn from (select *, {NUMVALS_SQL} as numvals from m_located)) where rn = 1",
)
def deduplicated_exact(t: Testbed):
    return dedupe.dedupe_events(located(t), unit=None, counted=RAW_COLUMNS).select("event_id")


_SAME = ", ".join(
    f"round_even({c}, 8)" if c in ("lon", "lat", "ground_speed", "gps_dop") else c
    for c in ("individual_id", "lon", "lat", "timestamp", "tag_id", "sensor_type_id", "ground_speed", "gps_dop", "study_id")
)


@query(
    "2.13 ties",
    f"select event_id from (select *, row_number() over (partition by {_SAME} order by timestamp, event_id) as rn from "
    "(select *, max(numvals) over (partition by study_id, individual_id, tag_id, sensor_type_id, date_trunc('second', timestamp)) as best from "
    "(select event_id, individual_id, lon, lat, timestamp, tag_id, sensor_type_id, study_id, gps_dop, "
    "case when isnan(ground_speed) then null else ground_speed end as ground_speed, "
    "(case when ground_speed is null or isnan(ground_speed) then 0 else 1 end) + (case when gps_dop is null then 0 else 1 end) as numvals "
    "from m_located)) where numvals = best) where rn = 1",
)
def deduplicated_distinct(t: Testbed):
    names = [
        "event_id", "individual_id", "lon", "lat", "timestamp", "tag_id", "sensor_type_id",
        "ground_speed", "gps_dop", "study_id",
    ]
    events = located(t).select(*names)
    return dedupe.dedupe_events(events, counted=names, ties="distinct").select("event_id")


@query(
    "E7",
    "select individual_id, tag_id, sensor_type_id, {{ts:timestamp}} as ts_unit, count(*) as num, "
    "bool_and(ground_speed is null) as allna, count(ground_speed) as numnotna, "
    "count(distinct round_even(ground_speed, 5)) + max(case when ground_speed is null then 1 else 0 end) as uniq "
    "from m_ship group by individual_id, tag_id, sensor_type_id, timestamp having count(*) > 1",
)
def speed_by_group(t: Testbed):
    return dedupe.speed_by_group(t.ship, SHIP_KEYS)


@query(
    "E27",
    "select i.study_id, i.individual_id, i.local_identifier, coalesce(n, 0) as num from m_individual i left join "
    f"(select study_id, individual_id, count(*) as n from (select {GROUP}, date_trunc('second', timestamp) as s, count(*) as c "
    "from m_located group by all) where c > 1 group by all) g on i.study_id = g.study_id and i.individual_id = g.individual_id",
)
def duplicates_per_individual(t: Testbed):
    return dedupe.duplicates_per_individual(located(t), t.individual)


@query(
    "E27",
    "select i.study_id, i.individual_id, i.local_identifier, coalesce(n, 0) as num from m_individual i left join "
    "(select individual_id, count(*) as n from (select individual_id, tag_id, sensor_type_id, timestamp, count(*) as c "
    "from m_ship group by all) where c > 1 group by all) g on i.individual_id = g.individual_id",
)
def exact_duplicates_per_individual(t: Testbed):
    return dedupe.duplicates_per_individual(t.ship, t.individual, SHIP_KEYS, None)


@query(
    "E27",
    f"select count(*) as num from (select {GROUP}, date_trunc('second', timestamp) as s, count(*) as c from m_located group by all) where c > 1",
)
def duplicate_total(t: Testbed):
    return dedupe.duplicate_total(located(t))


@query(
    "E30",
    f"select count(*) as num from (select {GROUP}, date_trunc('second', timestamp) as s, count(*) as c from m_located group by all) where c > 2",
)
def large_groups(t: Testbed):
    return dedupe.groups_larger_than(located(t), 2)


NEAR_SQL = (
    "with near as (select user_id, event_type, ts + interval '1' microsecond * d as timestamp, event_id * 4 + d as event_id "
    "from events, (select unnest(range(0, 3)) as d) where d = 0 or (d = 1 and event_id % 7 = 0) or (d = 2 and event_id % 5 = 0)), "
    "printed as (select *, strftime(timestamp + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g') as ts_ms from near), "
    "single as (select *, count(*) over (partition by user_id, event_type, timestamp) as n from printed), "
    "groups as (select user_id, event_type, ts_ms, count(*) as num from single where n = 1 group by all having count(*) > 1) "
)


def near_copies(t: Testbed):
    """Events with copies a few microseconds apart."""
    copies = t.numbered(t.table("events"), "d", 3).where(
        "d = 0 or (d = 1 and event_id % 7 = 0) or (d = 2 and event_id % 5 = 0)"
    )
    return copies.selectExpr(
        "user_id",
        "event_type",
        "ts + interval '1' microsecond * d as timestamp",
        "event_id * 4 + d as event_id",
    )


@query("E28", NEAR_SQL + "select * from groups")
def near_duplicate_groups(t: Testbed):
    return dedupe.near_duplicate_groups(near_copies(t), ("user_id", "event_type"))


@query(
    "E28",
    NEAR_SQL + "select p.event_id, g.num from printed p join groups g on p.user_id = g.user_id "
    "and p.event_type = g.event_type and p.ts_ms = g.ts_ms",
)
def near_duplicate_events(t: Testbed):
    return dedupe.near_duplicate_events(near_copies(t), ("user_id", "event_type")).select("event_id", "num")

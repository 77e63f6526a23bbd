"""Joins (D1 to D15)."""

from pyspark.sql import functions as F

from tracklake.operators import dedupe, relate, reports
from tracklake.operators.filters import event_rules, keep_allowed_species, keep_valid
from tracklake.plans.remove import extract_study
from tracklake.registry.base import query
from tracklake.registry.mapping import AS_OF, INSIDE_SQL, Testbed

SHIP_KEYS = ("individual_id", "tag_id")
RULES = event_rules(AS_OF)


def reduced(t: Testbed):
    return relate.reduce_entities(keep_allowed_species(t.individual), t.tag, t.sensor, t.deployment)


def located(t: Testbed):
    """Valid fixes inside a deployment of an allowed individual."""
    return relate.interval_join(keep_valid(t.raw_event, RULES), reduced(t)["deployment"])


@query(
    "D1",
    "select s.individual_id, s.tag_id, deployment_id, lon, lat, {{ts:timestamp}} as timestamp from m_ship s "
    f"join m_ship_deployment d on s.individual_id = d.individual_id and s.tag_id = d.tag_id where {INSIDE_SQL}",
)
def interval_join(t: Testbed):
    joined = relate.interval_join(t.ship, t.ship_deployment, SHIP_KEYS)
    return joined.select("individual_id", "tag_id", "deployment_id", "lon", "lat", "timestamp")


@query(
    "D1",
    "select s.individual_id, s.tag_id, deployment_id, lon, lat, {{ts:timestamp}} as timestamp from m_ship s "
    f"join m_ship_deployment d on s.individual_id = d.individual_id and s.tag_id = d.tag_id where {INSIDE_SQL}",
)
def interval_join_spread(t: Testbed):
    """The way for a deployment table too large to broadcast: hot keys are spread."""
    joined = relate.interval_join(
        t.ship, t.ship_deployment, SHIP_KEYS, broadcast_bytes=0, hot_rows=8
    )
    return joined.select("individual_id", "tag_id", "deployment_id", "lon", "lat", "timestamp")


@query(
    "D1",
    "select s.individual_id, s.tag_id, deployment_id, lon, lat, {{ts:timestamp}} as timestamp from m_ship s "
    f"left join m_ship_deployment d on s.individual_id = d.individual_id and s.tag_id = d.tag_id and {INSIDE_SQL}",
)
def interval_join_keep_all(t: Testbed):
    joined = relate.interval_join(t.ship, t.ship_deployment, SHIP_KEYS, "left", broadcast_bytes=0, hot_rows=8)
    return joined.select("individual_id", "tag_id", "deployment_id", "lon", "lat", "timestamp")


@query(
    "D1",
    "select o_orderkey as deployment_id, count(*) as num from orders join lineitem on l_shipdate = o_orderdate group by 1",
)
def interval_join_binned(t: Testbed):
    """All ships on one pair of individual and tag, which each order deploys for a day.

    Ships of one time fall into the same deployments: they are counted before they are joined, and not each with each order.
    """
    one = {"individual_id": F.lit(1).cast("bigint"), "tag_id": F.lit(1).cast("bigint")}
    days = {"deploy_on_timestamp": F.expr("timestamp(o_orderdate)"), "deploy_off_timestamp": F.expr("timestamp(o_orderdate) + interval 1 day")}
    uses = t.table("orders").withColumn("deployment_id", F.col("o_orderkey")).withColumns({**one, **days})
    ships = t.ship.withColumns(one).groupBy(*SHIP_KEYS, "timestamp").agg(F.count("*").alias("n"))
    found = relate.binned_interval_join(ships, uses, SHIP_KEYS)
    return found.groupBy("deployment_id").agg(F.sum("n").alias("num"))


@query(
    "D1",
    "select s.individual_id, s.tag_id, deployment_id, lon, lat, {{ts:timestamp}} as timestamp from m_ship s "
    f"left join m_ship_deployment d on s.individual_id = d.individual_id and s.tag_id = d.tag_id and {INSIDE_SQL}",
)
def interval_join_binned_keep_all(t: Testbed):
    """Open ends, keys with few deployments and the others: the same as without bins."""
    joined = relate.binned_interval_join(t.ship, t.ship_deployment, SHIP_KEYS, "left", few=0)
    return joined.select("individual_id", "tag_id", "deployment_id", "lon", "lat", "timestamp")


@query(
    "D1 C1-C9 D2",
    "select event_id, study_id, deployment_id, {{ts:timestamp}} as timestamp from m_located",
)
def located_events(t: Testbed):
    return located(t).select("event_id", "study_id", "deployment_id", "timestamp")


@query(
    "C1-C9 D1 E3",
    "select individual_id, count(*) as num from m_located where study_id = 17 group by individual_id",
)
def located_events_per_individual(t: Testbed):
    """Locations per individual of one study, cleaned and deployed only."""
    return located(t).where("study_id = 17").groupBy("individual_id").agg(F.count("*").alias("num"))


@query("D2", "select deployment_id, individual_id, tag_id, study_id from m_kept_deployment")
def kept_deployments(t: Testbed):
    return reduced(t)["deployment"].select("deployment_id", "individual_id", "tag_id", "study_id")


@query("D3", "select individual_id, study_id from m_owner")
def kept_individuals(t: Testbed):
    return reduced(t)["individual"].select("individual_id", "study_id")


@query("D4", "select tag_id, study_id from m_kept_tag")
def kept_tags(t: Testbed):
    return reduced(t)["tag"].select("tag_id", "study_id")


@query("D5", "select sensor_id, tag_id, study_id from m_kept_sensor")
def kept_sensors(t: Testbed):
    return reduced(t)["sensor"].select("sensor_id", "tag_id", "study_id")


@query(
    "D6 G1 A6",
    "select sensor_type_id, name from (select distinct sensor_type_id from m_sensor) "
    "left join m_sensor_type on sensor_type_id = id",
)
def sensor_type_names(t: Testbed):
    return relate.name_sensor_types(t.sensor, t.sensor_types)


@query(
    "D7 F1",
    "select event_id, num from (select event_id, count(*) over (partition by study_id, individual_id, tag_id, "
    "sensor_type_id, date_trunc('second', timestamp)) as num from m_located) where num > 1",
)
def duplicate_events(t: Testbed):
    return dedupe.duplicate_events(located(t)).select("event_id", "num")


@query("D8", "select event_id from m_located where event_id not in (select event_id from m_unique)")
def removed_duplicates(t: Testbed):
    events = located(t)
    return dedupe.removed_duplicates(events, dedupe.dedupe_events(events)).select("event_id")


@query("D8", "select event_id, study_id from m_raw where event_id % 8 <> 0")
def without_rejects(t: Testbed):
    rejects = t.table("events").selectExpr("event_id * 4 as event_id").where("event_id % 8 = 0")
    return relate.without_rows(t.raw_event, rejects, ["event_id"]).select("event_id", "study_id")


@query(
    "D9",
    "select tag_id, study_id from m_tag t where not exists (select 1 from m_deployment d "
    "where d.tag_id = t.tag_id and d.study_id = t.study_id)",
)
def tags_never_deployed(t: Testbed):
    return relate.drop_matching(t.tag, t.deployment, ["study_id", "tag_id"]).select("tag_id", "study_id")


@query(
    "D10",
    "select e.tag_id, e.sensor_type_id, e.num, coalesce(s.n, 0) as sensors from "
    "(select study_id, tag_id, sensor_type_id, count(*) as num from m_located group by all) e left join "
    "(select study_id, tag_id, sensor_type_id, count(*) as n from m_kept_sensor group by all) s "
    "on e.study_id = s.study_id and e.tag_id = s.tag_id and e.sensor_type_id = s.sensor_type_id",
)
def sensors_of_events(t: Testbed):
    on = ["study_id", "tag_id", "sensor_type_id"]
    events = located(t).groupBy(*on).agg(F.count("*").alias("num"))
    sensors = reduced(t)["sensor"].groupBy(*on).agg(F.count("*").alias("sensors"))
    joined = events.join(sensors, on, "left").withColumn("sensors", F.coalesce("sensors", F.lit(0)))
    return joined.select("tag_id", "sensor_type_id", "num", "sensors")


@query(
    "D11 E17",
    "select s.study_id, count(distinct t.o_orderkey) as num from m_study s join m_individual i on s.study_id = i.study_id "
    "join m_ship_deployment d on i.individual_id = d.individual_id join orders t on d.tag_id = t.o_orderkey group by s.study_id",
)
def star_join(t: Testbed):
    """Study, individual, deployment, tag: the chain all per-study counts follow."""
    db = t.ships
    return reports.tags_per_study(db["individual"], db["deployment"], db["tag"])


@query(
    "D12",
    "select individual_id, tag_id, {{ts:timestamp}} as timestamp from m_ship where individual_id in "
    "(select individual_id from m_individual where study_id = 5)",
)
def events_of_members(t: Testbed):
    members = t.individual.where("study_id = 5")
    return relate.events_of_individuals(t.ship, members).select("individual_id", "tag_id", "timestamp")


_RESOLVED = (
    "from m_ui u left join m_tag t on u.study_id = t.study_id and u.tag_local_identifier = t.local_identifier "
    "left join m_individual i on u.study_id = i.study_id and u.individual_local_identifier = i.local_identifier "
    "left join m_sensor_type y on lower(u.sensor_type) = lower(y.name) "
    "left join m_sensor s on u.study_id = s.study_id and s.sensor_type_id = y.id and s.tag_id = t.tag_id"
)


def resolved(t: Testbed):
    return relate.resolve_identifiers(
        t.ui_event, t.tag, t.individual, t.sensor, t.sensor_types, by=("study_id",)
    )


@query(
    "D13",
    "select event_id, t.tag_id, i.individual_id, cast(y.id as bigint) as sensor_type_id, s.sensor_id " + _RESOLVED,
)
def resolved_identifiers(t: Testbed):
    return resolved(t).select("event_id", "tag_id", "individual_id", "sensor_type_id", "sensor_id")


@query(
    "D14",
    "select i.individual_id, i.study_id, num from m_individual i join (select individual_id, count(*) as num "
    "from m_ship group by individual_id) s on i.individual_id = s.individual_id",
)
def joined_to_counts(t: Testbed):
    counts = reports.events_by_individual(t.ship).select("individual_id", "num")
    return counts.join(t.individual.select("individual_id", "study_id"), "individual_id")


@query(
    "D15",
    "select individual_id, tag_id, lon, lat, {{ts:timestamp}} as timestamp from (select *, count(*) over "
    "(partition by individual_id, tag_id, sensor_type_id, timestamp) as n from m_ship) where n = 1",
)
def without_exact_duplicates(t: Testbed):
    keys = ("individual_id", "tag_id", "sensor_type_id")
    out = dedupe.without_exact_duplicates(t.ship, keys)
    return out.select("individual_id", "tag_id", "lon", "lat", "timestamp")


@query(
    "N1",
    "select deployment_id from m_ship_deployment where individual_id is null or tag_id is null "
    "or deployment_id % 10 = 0",
)
def deployments_without_keys(t: Testbed):
    """Every tenth deployment loses its tag first."""
    tag = F.when(F.col("deployment_id") % 10 != 0, F.col("tag_id"))
    return relate.null_keyed_deployments(t.ship_deployment.withColumn("tag_id", tag)).select("deployment_id")


@query("K6", "select sensor_id, tag_id from m_sensor s where tag_id in (select tag_id from m_deployment d join m_individual i on d.individual_id = i.individual_id where i.study_id = 17)")
def sensors_of_study(t: Testbed):
    return extract_study(t.raw, 17)["sensor"].select("sensor_id", "tag_id")


@query("K6", "select event_id, individual_id from m_raw where study_id = 17")
def events_of_study(t: Testbed):
    return extract_study(t.raw, 17)["event"].select("event_id", "individual_id")


@query(
    "K6",
    "select 'study' as entity, count(*) as num from m_study where study_id = 17 union all "
    "select 'individual', count(*) from m_individual where study_id = 17 union all "
    "select 'deployment', count(*) from m_deployment where individual_id in (select individual_id from m_individual where study_id = 17) union all "
    "select 'tag', count(*) from m_tag where tag_id in (select tag_id from m_deployment where individual_id in (select individual_id from m_individual where study_id = 17)) union all "
    "select 'sensor', count(*) from m_sensor where tag_id in (select tag_id from m_deployment where individual_id in (select individual_id from m_individual where study_id = 17)) union all "
    "select 'event', count(*) from m_raw where study_id = 17",
)
def rows_of_study(t: Testbed):
    out = None
    for entity, df in extract_study(t.raw, 17).items():
        part = df.agg(F.count("*").alias("num")).select(F.lit(entity).alias("entity"), "num")
        out = part if out is None else out.unionByName(part)
    return out

"""Reports over the tables."""

from pyspark.sql import functions as F

from tracklake.functions.times import millis_text
from tracklake.operators import reports as op
from tracklake.operators import shape
from tracklake.operators.joins import join_facts
from tracklake.registry.base import query
from tracklake.registry.joins import located
from tracklake.registry.mapping import Testbed

STUDY = 7
SPECIES = "BUILDING"


@query("Q1", "select study_id, study_name from m_study")
def study_list(t: Testbed):
    return op.study_list(t.study)


@query("E1", "select count(*) as num from m_ship")
def event_count(t: Testbed):
    return op.row_count(t.ship)


@query("E2", "select study_id, count(*) as num from m_individual group by study_id")
def individuals_per_study(t: Testbed):
    return op.individuals_per_study(t.individual)


@query(
    "E2 N5",
    "select s.study_id, study_name, count(*) as num from m_individual i join m_study s on i.study_id = s.study_id group by all",
)
def individuals_per_study_name(t: Testbed):
    return op.individuals_per_study_name(t.individual, t.study)


_PER_INDIVIDUAL = (
    "select e.individual_id, count(*) as num from m_ship e join m_individual i on e.individual_id = i.individual_id "
    f"where i.study_id = {STUDY} group by e.individual_id"
)


@query("E3", _PER_INDIVIDUAL)
def events_per_individual(t: Testbed):
    return op.events_per_individual(t.ship, t.individual, STUDY)


@query(
    "E3 D12",
    "select individual_id, count(*) as num from m_ship where individual_id in "
    f"(select individual_id from m_individual where study_id = {STUDY}) group by individual_id",
)
def events_per_individual_semi(t: Testbed):
    return op.events_per_individual_semi(t.ship, t.individual, STUDY)


@query(
    "E4 N4",
    "select i.study_id, {{ts:min(timestamp)}} as min_ts, {{ts:max(timestamp)}} as max_ts from m_ship e "
    "join m_individual i on e.individual_id = i.individual_id group by i.study_id",
)
def study_extents(t: Testbed):
    return op.study_extents(t.ship, t.individual)


@query(
    "E8",
    "select e.individual_id, count(*) as num, {{ts:min(timestamp)}} as min_ts, {{ts:max(timestamp)}} as max_ts from m_ship e "
    f"join m_individual i on e.individual_id = i.individual_id where i.study_id = {STUDY} group by e.individual_id",
)
def individual_extents(t: Testbed):
    return op.individual_extents(t.ship, t.individual, STUDY)


@query(
    "E9",
    "select individual_id, {{ts:min(timestamp)}} as ts_min, {{ts:max(timestamp)}} as ts_max, min(lon) as lon_min, max(lon) as lon_max, "
    "avg(lon) as lon_mean, min(lat) as lat_min, max(lat) as lat_max, avg(lat) as lat_mean from m_ship group by individual_id",
)
def individual_stats(t: Testbed):
    return op.individual_stats(t.ship)


@query(
    "E10",
    "with points as (select strftime(timestamp, '%Y') as year, individual_id, timestamp from m_ship where individual_id in "
    f"(select individual_id from m_individual where study_id = {STUDY} and taxon_canonical_name = '{SPECIES}')) "
    "select year, count(distinct individual_id) as individuals, count(*) as obs, {{ts:min(timestamp)}} as min_ts, "
    "{{ts:max(timestamp)}} as max_ts from points group by year",
)
def years_of_study(t: Testbed):
    return op.years_of_study(t.ship, t.individual, STUDY, SPECIES)


_PER_STUDY = (
    "select i.study_id, count(*) as num from m_ship e join m_individual i on e.individual_id = i.individual_id group by i.study_id"
)


@query("E11", _PER_STUDY)
def events_per_study(t: Testbed):
    return op.events_per_study(t.ship, t.individual)


@query("E11 D14", _PER_STUDY)
def events_per_study_spread(t: Testbed):
    """Every event joined by its key alone, as if individuals were hot and owners too many to broadcast."""
    owners = t.individual.select("individual_id", "study_id")
    joined = join_facts(t.ship.select("individual_id"), owners, ["individual_id"], broadcast_bytes=0, hot_rows=20)
    return joined.groupBy("study_id").agg(op.num())


@query(
    "E11",
    "select i.study_id, study_name, count(*) as num from m_ship e join m_individual i on e.individual_id = i.individual_id "
    "join m_study s on i.study_id = s.study_id group by all",
)
def events_per_study_join_first(t: Testbed):
    return op.events_per_study_join_first(t.ship, t.individual, t.study)


@query(
    "E12",
    "with points as (select study_id, individual_id, strftime(timestamp, '%Y') as year from m_ship join "
    "(select individual_id, study_id from m_individual) using (individual_id)), "
    "totals as (select study_id, count(distinct individual_id) as num_individuals, count(*) as num_points, "
    "min(year) as min_year, max(year) as max_year from points group by study_id) "
    "select totals.*, study_name from totals join (select study_id, study_name from m_study) using (study_id)",
)
def study_summary(t: Testbed):
    return op.study_summary(t.ship, t.individual, t.study)


@query(
    "E13 G1",
    "with names as (select individual_id, study_id, study_name, local_identifier, nick_name from m_individual "
    "join (select study_id, study_name from m_study) using (study_id)) "
    "select names.*, count(timestamp) as num, {{ts:min(timestamp)}} as min_ts, {{ts:max(timestamp)}} as max_ts "
    "from names join (select individual_id, timestamp from m_ship) using (individual_id) group by all",
)
def individual_summary(t: Testbed):
    return op.individual_summary(t.ship, t.individual, t.study)


@query(
    "E14 G1",
    "select s.study_id, study_name, taxon_canonical_name, count(*) as num from m_study s join m_individual i on s.study_id = i.study_id group by all",
)
def individuals_per_study_and_species(t: Testbed):
    return op.individuals_per_study_and_species(t.individual, t.study)


@query(
    "E15 G1",
    "select taxon_canonical_name, count(*) as num from m_study s join m_individual i on s.study_id = i.study_id group by all",
)
def individuals_per_species(t: Testbed):
    return op.individuals_per_species(t.individual, t.study)


@query("E16 G8", "select distinct taxon_canonical_name from m_individual")
def species(t: Testbed):
    return op.species(t.individual)


@query(
    "E17",
    "select i.study_id, count(distinct t.tag_id) as num from m_individual i join m_deployment d on i.individual_id = d.individual_id "
    "join m_tag t on d.tag_id = t.tag_id group by i.study_id",
)
def tags_per_study(t: Testbed):
    return op.tags_per_study(t.individual, t.deployment, t.tag)


@query(
    "E17",
    "select i.study_id, count(distinct s.sensor_id) as num from m_individual i join m_deployment d on i.individual_id = d.individual_id "
    "join m_tag t on d.tag_id = t.tag_id join m_sensor s on t.tag_id = s.tag_id group by i.study_id",
)
def sensors_per_study(t: Testbed):
    return op.sensors_per_study(t.individual, t.deployment, t.tag, t.sensor)


@query(
    "E18 C12",
    "select count(*) as num from m_ship e join m_individual i on e.individual_id = i.individual_id "
    f"where i.study_id = {STUDY} and timestamp >= timestamp '1996-04-01' and timestamp < timestamp '1998-09-01'",
)
def points_in_period(t: Testbed):
    return op.points_in_period(t.ship, t.individual, STUDY, "1996-04-01", "1998-09-01")


@query(
    "E19 D11",
    "select study_id, 'study' as entity, count(*) as num from m_study group by 1 "
    "union all select study_id, 'individual', count(*) from m_individual group by 1 "
    "union all select i.study_id, 'deployment', count(*) from m_deployment d join m_individual i on d.individual_id = i.individual_id group by 1 "
    "union all select i.study_id, 'tag', count(distinct t.tag_id) from m_individual i join m_deployment d on i.individual_id = d.individual_id "
    "join m_tag t on d.tag_id = t.tag_id group by 1 "
    "union all select i.study_id, 'sensor', count(distinct s.sensor_id) from m_individual i join m_deployment d on i.individual_id = d.individual_id "
    "join m_tag t on d.tag_id = t.tag_id join m_sensor s on t.tag_id = s.tag_id group by 1 "
    "union all select i.study_id, 'event', count(*) from m_raw e join m_individual i on e.individual_id = i.individual_id group by 1",
)
def entity_counts(t: Testbed):
    return op.entity_counts(t.raw)


@query(
    "E20 H6",
    "select i.individual_id, local_identifier, cast(cast(min(timestamp) as date) as varchar) as mints, "
    "cast(cast(max(timestamp) as date) as varchar) as maxts from m_ship e join m_individual i on e.individual_id = i.individual_id "
    f"where i.study_id = {STUDY} group by all",
)
def individual_dates(t: Testbed):
    return op.individual_dates(t.ship, t.individual, STUDY)


@query(
    "E21 G2",
    "select cast(cast(timestamp as date) as varchar) as date, count(*) as num from m_ship group by 1 order by num desc",
)
def events_per_day(t: Testbed):
    return op.events_per_day(t.ship)


@query(
    "E22 H8",
    "select right(strftime(timestamp + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g'), 4) as millis, count(*) as num from m_located group by 1",
)
def millis_distribution(t: Testbed):
    return op.millis_distribution(located(t))


_NO_SPEED = "(ground_speed is null or isnan(ground_speed))"


@query("E23", f"select {_NO_SPEED} as is_missing, count(*) as num from m_raw group by 1")
def missing_speed(t: Testbed):
    return op.missing_speed(t.raw_event)


@query(
    "E23",
    f"select individual_id, {_NO_SPEED} as is_missing, count(*) as num from m_raw group by 1, 2",
)
def missing_speed_per_individual(t: Testbed):
    return op.missing_speed_per_individual(t.raw_event)


@query("E24", f"select distinct individual_id from m_raw where {_NO_SPEED}")
def individuals_with_missing_speed(t: Testbed):
    return op.individuals_with_missing(t.raw_event)


_REPORTED = (
    "select study_id, cast(number_of_individuals as varchar) as a, cast(number_of_deployments as varchar) as b, "
    "cast(number_of_deployed_locations as varchar) as c, "
    "strftime(timestamp_first_deployed_location, '%Y-%m-%d %H:%M:%S.%g') as d, "
    "strftime(timestamp_last_deployed_location, '%Y-%m-%d %H:%M:%S.%g') as e from m_study"
)
_COMPUTED = (
    "select coalesce(i.study_id, d.study_id, f.study_id) as study_id, cast(i.n as varchar) as a, cast(d.n as varchar) as b, cast(f.n as varchar) as c, "
    "strftime(lo + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g') as d, strftime(hi + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g') as e from "
    "(select study_id, count(*) as n from m_individual group by 1) i full join "
    "(select study_id, count(*) as n from m_deployment group by 1) d on i.study_id = d.study_id full join "
    "(select study_id, count(*) as n, min(timestamp) as lo, max(timestamp) as hi from m_raw where timestamp is not null group by 1) f "
    "on coalesce(i.study_id, d.study_id) = f.study_id"
)


def totals(t: Testbed):
    timed = t.raw_event.where(F.col("timestamp").isNotNull())
    return op.computed_totals(t.individual, t.deployment, timed)


@query(
    "E29",
    "select study_id, cast(a as bigint) as number_of_individuals, cast(b as bigint) as number_of_deployments, "
    f"cast(c as bigint) as number_of_deployed_locations, d as first_location, e as last_location from ({_COMPUTED})",
)
def computed_totals(t: Testbed):
    return totals(t).select(
        "study_id",
        "number_of_individuals",
        "number_of_deployments",
        "number_of_deployed_locations",
        millis_text(F.col("timestamp_first_deployed_location")).alias("first_location"),
        millis_text(F.col("timestamp_last_deployed_location")).alias("last_location"),
    )


@query(
    "G5 J18",
    f"select study_id, 'reported' as source, cast(a as bigint) as n from ({_REPORTED}) union all "
    f"select study_id, 'computed', cast(a as bigint) from ({_COMPUTED})",
)
def stacked_totals(t: Testbed):
    both = op.stacked_totals(t.study, totals(t))
    return both.select("study_id", "source", F.col("number_of_individuals").alias("n"))


_LINES = {
    "number_of_individuals": "a",
    "number_of_deployments": "b",
    "number_of_deployed_locations": "c",
    "timestamp_first_deployed_location": "d",
    "timestamp_last_deployed_location": "e",
}


@query(
    "G6 J18",
    f"with r as ({_REPORTED}), s as ({_COMPUTED}) "
    + " union all ".join(
        f"select coalesce(r.study_id, s.study_id) as study_id, '{name}' as metric, r.{c} as reported, s.{c} as computed "
        "from r full join s on r.study_id = s.study_id"
        for name, c in _LINES.items()
    ),
)
def compared_totals(t: Testbed):
    return op.compare_totals(t.study, totals(t))


@query("E31", "select count(*) as num, {{ts:max(deploy_on_timestamp)}} as max_on from m_ship_deployment where individual_id = 11")
def latest_deployment(t: Testbed):
    return op.latest_deployment(t.ship_deployment, 11)


@query("E32 G1", "select distinct manufacturer_name from m_tag")
def manufacturers(t: Testbed):
    return op.manufacturers(t.tag)


@query(
    "E33 G8",
    "select distinct deploy_on_timestamp is null as na_dep_on, deploy_off_timestamp is null as na_dep_off from m_deployment",
)
def deployment_patterns(t: Testbed):
    return op.deployment_patterns(t.deployment)


@query("E2", f"select individual_id, local_identifier from m_individual where study_id = {STUDY}")
def individuals_of_study(t: Testbed):
    return op.individuals_of_study(t.individual, t.study, STUDY).select("individual_id", "local_identifier")


@query("G3", "select event_id, {{ts:timestamp}} as timestamp from m_raw order by event_id limit 25")
def first_events(t: Testbed):
    """The first rows of the table, as a look at it; a top-k report."""
    return t.raw_event.select("event_id", "timestamp").orderBy("event_id").limit(25)


@query(
    "G4 B13",
    "select event_id, individual_id, tag_id, sensor_type_id, {{ts:timestamp}} as timestamp from m_raw where individual_id = 7 "
    "order by tag_id, sensor_type_id, timestamp nulls first, event_id limit 11 offset 2",
)
def rows_of_individual(t: Testbed):
    """Rows 3 to 13 of one individual."""
    return op.individual_events(t.raw_event, 7, 3, 13).drop("ground_speed")


@query("G4", "select event_id from events order by event_id limit 11 offset 2")
def row_positions(t: Testbed):
    return shape.rows_between(t.table("events").select("event_id"), ["event_id"], 3, 13)


@query(
    "G7",
    "select study_id, 'study_name' as metric, study_name as value from m_study union all "
    "select study_id, 'number_of_individuals', cast(number_of_individuals as varchar) from m_study",
)
def long_form(t: Testbed):
    return shape.to_long(t.study.select("study_id", "study_name", "number_of_individuals"), ["study_id"])


@query(
    "3.3 E12",
    "select i.study_id, count(*) as num from m_individual i join m_ship e on e.individual_id = i.individual_id "
    f"where i.study_id = {STUDY} group by i.study_id",
)
def sql_over_views(t: Testbed):
    """The tables under their names, asked in SQL with a parameter."""
    op.register_views({"individual": t.individual, "event": t.ship})
    return op.run_sql(
        t.spark,
        "select i.study_id, count(*) as num from individual i join event e "
        "on e.individual_id = i.individual_id where i.study_id = :study_id group by i.study_id",
        study_id=STUDY,
    )

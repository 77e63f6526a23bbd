"""Filters and the reject report."""

from pyspark.sql import functions as F

from tracklake.operators import filters as op
from tracklake.registry.base import query
from tracklake.registry.mapping import AS_OF, BAD_SQL, RULE_SQL, Testbed

RULES = op.event_rules(AS_OF)


def _passing(name: str, ids: str):
    """A query that counts the rows one rule keeps, per study."""

    def run(t: Testbed):
        kept = t.raw_event.where(RULES[name](t.raw_event))
        return kept.groupBy("study_id").agg(F.count("*").alias("num"))

    run.__name__ = f"rule_{name}"
    query(ids, f"select study_id, count(*) as num from m_raw where {RULE_SQL[name]} group by study_id")(run)


for _name, _ids in {
    "visible": "C1", "position": "C2", "zero": "C3", "lon_range": "C4", "lat_range": "C5",
    "time": "C6", "epoch": "C7", "future": "C8", "status": "C9",
}.items():
    _passing(_name, _ids)


@query("C1-C9", "select event_id, study_id, lon, lat, {{ts:timestamp}} as timestamp from m_good")
def valid_events(t: Testbed):
    kept = op.keep_valid(t.raw_event, RULES)
    return kept.select("event_id", "study_id", "lon", "lat", "timestamp")


@query(
    "C10",
    "select individual_id, study_id, taxon_canonical_name from m_kept_individual",
)
def allowed_individuals(t: Testbed):
    return op.keep_allowed_species(t.individual).select(
        "individual_id", "study_id", "taxon_canonical_name"
    )


@query(
    "C10",
    "select study_id, individual_id, local_identifier, nick_name, taxon_canonical_name from m_individual "
    "where lower(taxon_canonical_name) like '%homo sapien%'",
)
def removed_individuals(t: Testbed):
    return op.removed_species(t.individual)


@query(
    "2.13 species",
    "select individual_id, study_id, taxon_canonical_name from m_individual i where "
    "lower(taxon_canonical_name) not like '%homo sapien%' or not exists (select 1 from m_individual j "
    "where j.study_id = i.study_id and j.taxon_canonical_name is not null)",
)
def allowed_individuals_named(t: Testbed):
    kept = op.keep_allowed_species(t.individual, keep_missing=False)
    return kept.select("individual_id", "study_id", "taxon_canonical_name")


@query("2.13 range", f"select event_id from m_raw where {' and '.join(s for n, s in RULE_SQL.items() if 'range' not in n)}")
def valid_events_any_range(t: Testbed):
    return op.keep_valid(t.raw_event, op.event_rules(AS_OF, check_range=False)).select("event_id")


@query("C11", "select individual_id, local_identifier from m_individual where study_id in (3, 7)")
def individuals_of_studies(t: Testbed):
    return op.of_study(t.individual, 3, 7).select("individual_id", "local_identifier")


@query(
    "C12",
    "select individual_id, tag_id, lon, lat, {{ts:timestamp}} as timestamp from m_ship "
    "where timestamp >= timestamp '1997-03-01' and timestamp < timestamp '1997-06-01'",
)
def events_in_period(t: Testbed):
    kept = op.in_period(t.ship, "1997-03-01", "1997-06-01")
    return kept.select("individual_id", "tag_id", "lon", "lat", "timestamp")


@query(
    "C13 N3",
    "select event_id, study_id from m_raw where timestamp >= timestamp '2024-01-05' "
    "and timestamp < timestamp '2024-01-06'",
)
def events_between_dates(t: Testbed):
    return op.between_dates(t.raw_event, "2024-01-05", "2024-01-06").select("event_id", "study_id")


@query("C14", "select individual_id from m_individual where taxon_canonical_name = 'BUILDING'")
def individuals_of_species(t: Testbed):
    return op.of_species(t.individual, "BUILDING").select("individual_id")


@query(
    "C15",
    "select study_id, taxon_canonical_name, count(*) as num from m_individual "
    "where taxon_canonical_name in ('BUILDING', 'MACHINERY') group by all",
)
def individuals_in_list(t: Testbed):
    kept = t.individual.where(F.col("taxon_canonical_name").isin("BUILDING", "MACHINERY"))
    return kept.groupBy("study_id", "taxon_canonical_name").agg(F.count("*").alias("num"))


@query("C17", "select event_id from m_raw where sensor_type_id = 653")
def gps_events(t: Testbed):
    return op.of_sensor_type(t.raw_event).select("event_id")


EPOCH_TEXT_SQL = (
    "select event_id, case when event_id % 3 = 0 then cast(cast(floor(epoch(ts)) as bigint) as varchar) "
    "when event_id % 3 = 1 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') else 'NA' end as t from events"
)


def epoch_texts(t: Testbed):
    """Times of events as they were once stored: seconds, ISO text, or NA."""
    seconds = F.unix_timestamp("ts").cast("string")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, seconds).when(kind == 1, iso).otherwise("NA")
    return t.table("events").select("event_id", text.alias("t"))


@query("C18", f"select event_id, t from ({EPOCH_TEXT_SQL}) where event_id % 3 = 0")
def numeric_times(t: Testbed):
    return op.with_epoch_text(epoch_texts(t), "t")


@query(
    "C19",
    "select individual_id, tag_id, {{ts:timestamp}} as timestamp, count(*) as num from m_ship "
    "group by individual_id, tag_id, timestamp having count(*) > 1",
)
def repeated_positions(t: Testbed):
    groups = t.ship.groupBy("individual_id", "tag_id", "timestamp").agg(F.count("*").alias("num"))
    return groups.where("num > 1")


@query("C20", "select event_id from m_raw where cast(timestamp as date) = date '2024-01-12'")
def events_on_day(t: Testbed):
    return op.on_day(t.raw_event, "2024-01-12").select("event_id")


_REPORT = " union all ".join(
    f"select study_id, {i} as position, '{name}' as rule, count(*) as rows_in, "
    f"count(*) filter (where not coalesce({sql}, false)) as failing, "
    f"count(*) filter (where bad = '{name}') as dropped from (select *, {BAD_SQL} as bad from m_raw) group by study_id"
    for i, (name, sql) in enumerate(RULE_SQL.items(), 1)
)


@query("C21", _REPORT)
def reject_report(t: Testbed):
    return op.reject_report(t.raw_event, RULES)


@query(
    "C21",
    f"select study_id, count(*) as rows_in, count(*) filter (where ({BAD_SQL}) is null) as rows_out, "
    f"count({BAD_SQL}) as rows_dropped from m_raw group by study_id",
)
def reject_totals(t: Testbed):
    return op.reject_totals(t.raw_event, RULES)


@query(
    "C22",
    "select event_id, {{ts:timestamp}} as timestamp from m_ui where coalesce(visible, true) "
    "and not coalesce(manually_marked_outlier, false) and timestamp < timestamp '2024-01-21 00:00:00'",
)
def unmarked_events(t: Testbed):
    rules = {
        "visible": op.visible,
        "outlier": op.not_marked_outlier,
        "future": op.before("2024-01-20", "1 day"),
    }
    return op.keep_valid(t.ui_event, rules).select("event_id", "timestamp")

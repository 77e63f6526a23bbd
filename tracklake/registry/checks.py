"""Data quality checks (J1 to J19): violation rows."""

from pyspark.sql import functions as F

from tracklake.operators import checks as op
from tracklake.operators import dedupe, relate
from tracklake.operators.joins import join_facts
from tracklake.registry.base import query
from tracklake.registry.joins import located, reduced, resolved
from tracklake.registry.mapping import INSIDE_SQL, Testbed

ROW = "study_id, '{check}' as \"check\", {key} as key, {detail} as detail"


def row(check: str, key: str, detail: str) -> str:
    return ROW.format(check=check, key=key, detail=detail)


# Every table loses rows of some studies.
FEW = {
    "study": ("m_study", "study_id % 7 <> 6"),
    "individual": ("m_individual", "individual_id % 3 = 0"),
    "tag": ("m_tag", "study_id % 5 <> 1"),
    "sensor": ("m_sensor", "study_id % 6 <> 2"),
    "deployment": ("m_deployment", "study_id % 8 <> 3"),
    "event": ("m_raw", "study_id % 4 <> 0"),
}


@query(
    "J1",
    " union all ".join(
        f"select s.study_id, 'has_records' as \"check\", '{name}' as key, 'no records' as detail from m_study s "
        f"where s.study_id not in (select study_id from {table} where {kept} and study_id is not null)"
        for name, (table, kept) in FEW.items()
    ),
)
def entities_without_records(t: Testbed):
    """Six tables that lost rows of some studies."""
    frames = {
        "study": t.study, "individual": t.individual, "tag": t.tag, "sensor": t.sensor,
        "deployment": t.deployment, "event": t.raw_event,
    }
    return op.entities_without_records(t.study, {name: frames[name].where(kept) for name, (_, kept) in FEW.items()})


@query(
    "J2",
    f"select {row('tag_deployed', 'cast(tag_id as varchar)', "'tag without deployment'")} from m_tag t "
    "where not exists (select 1 from m_deployment d where d.tag_id = t.tag_id and d.study_id = t.study_id)",
)
def tags_without_deployment(t: Testbed):
    return op.tags_without_deployment(t.tag, t.deployment)


@query(
    "J3",
    f"select {row('deployment_unique', "concat(individual_id, '/', tag_id)", 'cast(count(*) as varchar)')} from m_deployment "
    "group by study_id, individual_id, tag_id having count(*) > 1",
)
def repeated_deployments(t: Testbed):
    return op.repeated_deployments(t.deployment)


# Every ninth deployment is repeated with a later end, every tenth with an earlier start.
_REDEPLOYED = (
    "with x as (select study_id, tag_id, deploy_on_timestamp, deploy_off_timestamp from m_deployment union all "
    "select study_id, tag_id, deploy_on_timestamp, deploy_off_timestamp + interval '1' day from m_deployment where deployment_id % 9 = 0 union all "
    "select study_id, tag_id, deploy_on_timestamp - interval '1' day, deploy_off_timestamp from m_deployment where deployment_id % 10 = 0) "
)


def _ends(column: str) -> str:
    return (
        f"select {row('deployment_ends', 'cast(tag_id as varchar)', f"'{column}'")} from "
        f"(select study_id, tag_id, {column}, count(*) as n from x group by all) where n > 1 group by study_id, tag_id"
    )


@query("J4", _REDEPLOYED + _ends("deploy_on_timestamp") + " union all " + _ends("deploy_off_timestamp"))
def shared_deployment_ends(t: Testbed):
    day = F.expr("interval 1 day")
    dep = t.deployment
    later = dep.where("deployment_id % 9 = 0").withColumn("deploy_off_timestamp", F.col("deploy_off_timestamp") + day)
    earlier = dep.where("deployment_id % 10 = 0").withColumn("deploy_on_timestamp", F.col("deploy_on_timestamp") - day)
    return op.shared_deployment_ends(dep.unionByName(later).unionByName(earlier))


KEYED = ("individual", "tag", "sensor", "deployment")


@query(
    "J5",
    " union all ".join(
        f"select {row('primary_key', f"concat('{name}/', {name}_id)", 'cast(count(*) as varchar)')} from "
        f"(select {name}_id, study_id from m_{name} union all select {name}_id, study_id from m_{name} where {name}_id % 20 = 0) "
        f"group by study_id, {name}_id having count(*) > 1"
        for name in KEYED
    ),
)
def repeated_keys(t: Testbed):
    """Every twentieth row of four tables occurs twice."""
    frames = {"individual": t.individual, "tag": t.tag, "sensor": t.sensor, "deployment": t.deployment}
    keys = {name: df.select(f"{name}_id", "study_id") for name, df in frames.items()}
    return op.all_of(
        *(op.repeated_keys(df.unionByName(df.where(f"{name}_id % 20 = 0")), name) for name, df in keys.items())
    )


@query(
    "J6",
    f"select e.study_id, 'event_sensor' as \"check\", concat(coalesce(cast(e.tag_id as varchar), 'NA'), '/', e.sensor_type_id) as key, "
    "concat(e.num, ' events, ', coalesce(s.n, 0), ' sensors') as detail from "
    "(select study_id, tag_id, sensor_type_id, count(*) as num from m_located group by all) e left join "
    "(select study_id, tag_id, sensor_type_id, count(*) as n from m_kept_sensor group by all) s "
    "on e.study_id = s.study_id and e.tag_id = s.tag_id and e.sensor_type_id = s.sensor_type_id where coalesce(s.n, 0) <> 1",
)
def events_without_single_sensor(t: Testbed):
    return op.events_without_single_sensor(op.profile(located(t)), reduced(t)["sensor"])


@query(
    "J7",
    f"select {row('event_in_deployment', 'cast(deployment_id as varchar)', 'cast(count(*) as varchar)')} from "
    "(select r.study_id, r.timestamp, d.deployment_id, d.deploy_on_timestamp, d.deploy_off_timestamp from m_raw r join m_deployment d "
    "on r.study_id = d.study_id and r.individual_id = d.individual_id and r.tag_id = d.tag_id) "
    f"where not coalesce({INSIDE_SQL}, false) group by study_id, deployment_id",
)
def events_outside_deployment(t: Testbed):
    """Raw events joined on ids alone: those the interval would have dropped show up."""
    on = ["study_id", "individual_id", "tag_id"]
    side = t.deployment.select(*on, *relate.DEPLOYMENT_COLUMNS)
    return op.events_outside_deployment(op.profile(join_facts(t.raw_event, side, on)))


@query("J7", f"select {row('event_in_deployment', 'cast(deployment_id as varchar)', 'cast(count(*) as varchar)')} from m_located where not coalesce({INSIDE_SQL}, false) group by study_id, deployment_id")
def located_events_outside_deployment(t: Testbed):
    """After the interval join there is nothing to find."""
    return op.events_outside_deployment(op.profile(located(t)))


@query(
    "J8",
    f"select {row('event_individual', "coalesce(cast(tag_id as varchar), 'NA')", 'cast(count(*) as varchar)')} from m_raw "
    "where individual_id is null group by study_id, tag_id",
)
def events_without_individual(t: Testbed):
    return op.events_without_individual(op.profile(t.raw_event))


@query(
    "J9",
    f"select {row('event_tag_deployed', 'cast(tag_id as varchar)', 'cast(count(*) as varchar)')} from m_raw r where not exists "
    "(select 1 from m_deployment d where d.tag_id = r.tag_id and d.study_id = r.study_id) group by study_id, tag_id",
)
def events_without_deployed_tag(t: Testbed):
    return op.events_without_deployed_tag(op.profile(t.raw_event), t.deployment)


@query(
    "J10",
    "select study_id, 'events_remain' as \"check\", 'event' as key, 'no event remains' as detail from m_study "
    "where study_id not in (select study_id from m_located where study_id % 2 = 0)",
)
def studies_without_events(t: Testbed):
    return op.studies_without_events(t.study, located(t).where("study_id % 2 = 0"))


@query(
    "J11",
    "select g.study_id, 'dedupe_arithmetic' as \"check\", 'event' as key, concat(g.n, ' groups, ', coalesce(k.n, 0), ' rows') as detail from "
    "(select study_id, count(*) as n from (select distinct study_id, individual_id, tag_id, sensor_type_id, date_trunc('second', timestamp) from m_located) group by 1) g "
    "left join (select study_id, count(*) as n from m_located where event_id % 4 = 0 group by 1) k on g.study_id = k.study_id where g.n <> coalesce(k.n, 0)",
)
def dedupe_arithmetic(t: Testbed):
    """Keeping only first copies loses groups whose first copy was rejected."""
    events = located(t)
    return op.dedupe_arithmetic(events, events.where("event_id % 4 = 0"))


@query(
    "J12",
    "select study_id, 'no_duplicates' as \"check\", concat(individual_id, '/', tag_id, '/', sensor_type_id, '/', strftime(s, '%Y-%m-%d %H:%M:%S')) as key, "
    "cast(n as varchar) as detail from (select study_id, individual_id, tag_id, sensor_type_id, date_trunc('second', timestamp) as s, count(*) as n from m_located group by all) where n > 1",
)
def remaining_duplicates(t: Testbed):
    return op.remaining_duplicates(located(t))


@query("J11 J12", "select study_id, cast(null as varchar) as \"check\", cast(null as varchar) as key, cast(null as varchar) as detail from m_unique where false")
def deduplicated_is_clean(t: Testbed):
    """No violation is left after de-duplication."""
    events = located(t)
    unique = dedupe.dedupe_events(events)
    return op.all_of(op.dedupe_arithmetic(events, unique), op.remaining_duplicates(unique))


_WS = r"[\t\n\f\r\p{Z}]"


def _untidy(kind: str, pattern: str) -> str:
    return (
        f"select doc_id as study_id, 'tidy_text' as \"check\", concat('documents/', doc_id, '/text') as key, '{kind}' as detail "
        f"from documents where regexp_matches(text, '{pattern}')"
    )


@query(
    "J13",
    " union all ".join(
        [_untidy("line break", r"[\r\n]"), _untidy("leading blank", f"^{_WS}"), _untidy("trailing blank", rf"{_WS}\z")]
    ),
)
def untidy_documents(t: Testbed):
    docs = t.table("documents").select(F.col("doc_id").alias("study_id"), "doc_id", "text")
    return op.untidy_text(docs, "documents", "doc_id", ["text"])


@query(
    "J14",
    "with x as (select u.study_id, t.tag_id, i.individual_id, s.sensor_id from m_ui u "
    "left join m_tag t on u.study_id = t.study_id and u.tag_local_identifier = t.local_identifier "
    "left join m_individual i on u.study_id = i.study_id and u.individual_local_identifier = i.local_identifier "
    "left join m_sensor_type y on lower(u.sensor_type) = lower(y.name) "
    "left join m_sensor s on u.study_id = s.study_id and s.sensor_type_id = y.id and s.tag_id = t.tag_id) "
    "select study_id, 'identifier_resolved' as \"check\", 'tag_id' as key, cast(count(*) as varchar) as detail from x where tag_id is null group by study_id "
    "union all select study_id, 'identifier_resolved', 'individual_id', cast(count(*) as varchar) from x where individual_id is null group by study_id "
    "union all select study_id, 'identifier_resolved', 'sensor_id', cast(count(*) as varchar) from x where sensor_id is null group by study_id "
    "union all select a.study_id, 'identifier_rows', 'event', concat(a.n, ' rows in, ', b.n, ' out') from "
    "(select study_id, count(*) as n from m_ui group by 1) a join (select study_id, count(*) as n from x group by 1) b on a.study_id = b.study_id where a.n <> b.n",
)
def unresolved_identifiers(t: Testbed):
    return op.unresolved_identifiers(t.ui_event, resolved(t))


_HALF = "individual_id % 5 <> 0"


@query(
    "J15",
    "select study_id, 'foreign_key' as \"check\", concat('deployment.individual_id/', individual_id) as key, cast(count(*) as varchar) as detail "
    f"from m_deployment where not ({_HALF}) group by study_id, individual_id union all "
    "select study_id, 'foreign_key', concat('event.individual_id/', individual_id), cast(count(*) as varchar) "
    f"from m_raw where not ({_HALF}) group by study_id, individual_id",
)
def broken_references(t: Testbed):
    """Every fifth individual is missing; half of the tags are in the tables already."""
    new = {
        "study": t.study,
        "individual": t.individual.where(_HALF),
        "tag": t.tag.where("tag_id % 2 = 0"),
        "sensor": t.sensor,
        "deployment": t.deployment,
        "event": t.raw_event,
    }
    return op.broken_references(new, {"tag": t.tag.where("tag_id % 2 = 1")})


@query(
    "J16",
    "with again as (select study_id, event_id from m_raw where event_id % 12 = 0), moved as (select study_id, tag_id from m_tag where tag_id % 6 = 0) "
    "select study_id, 'primary_key_taken' as \"check\", concat('event/', event_id) as key, '2' as detail from again union all "
    "select study_id, 'primary_key_taken', concat('tag/', tag_id), '2' from moved union all "
    "select study_id + 100, 'primary_key_taken', concat('tag/', tag_id), '2' from moved",
)
def taken_keys(t: Testbed):
    """Some events are in the tables already, and some tags come with two studies."""
    twice = t.tag.where("tag_id % 6 = 0").withColumn("study_id", F.col("study_id") + 100)
    new = {"event": t.raw_event, "tag": t.tag.unionByName(twice)}
    return op.taken_keys(new, {"event": t.raw_event.where("event_id % 12 = 0")})


@query(
    "J17",
    "with f as (select study_id, count(*) as n from m_raw group by 1), d as (select study_id, count(*) as n from m_raw where study_id % 3 <> 0 or event_id % 9 <> 0 group by 1) "
    "select f.study_id, 'event' as entity, f.n as file_rows, coalesce(d.n, 0) as table_rows, f.n = coalesce(d.n, 0) as equal from f left join d on f.study_id = d.study_id",
)
def compared_counts(t: Testbed):
    """Some rows got lost on the way to the tables."""
    events = t.raw_event

    def counts(df):
        return df.groupBy("study_id").agg(F.count("*").alias("num")).withColumn("entity", F.lit("event"))

    return op.compare_counts(counts(events), counts(events.where("study_id % 3 <> 0 or event_id % 9 <> 0")))


@query(
    "J19",
    f"select {row('event_tag', 'cast(tag_id as varchar)', 'cast(count(*) as varchar)')} from m_raw where tag_id % 3 = 0 group by study_id, tag_id",
)
def events_without_tag(t: Testbed):
    return op.events_without_tag(op.profile(t.raw_event), t.tag.where("tag_id % 3 <> 0"))

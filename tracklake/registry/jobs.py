"""Whole jobs: cleaning, loading, deleting (K1 to K5)."""

from pyspark.sql import functions as F

from tracklake.operators.filters import event_rules, keep_valid
from tracklake.operators.shape import conform
from tracklake.plans.clean import clean
from tracklake.plans.load import import_clean, run, validate_import
from tracklake.plans.remove import delete_counts, delete_study, split_for_delete
from tracklake.registry.base import query
from tracklake.registry.mapping import AS_OF, BAD_SQL, RELATIONS, Testbed
from tracklake.registry.sources import without_nan
from tracklake.session import scratch_path
from tracklake.sources import tables
from tracklake.schema import ENTITIES

# Studies the checks reject, stated once: repeated or badly ended deployments, sensors missing or
# doubled, nothing left.
RELATIONS["m_failed"] = (
    "select distinct study_id from ("
    "select study_id from m_kept_deployment group by study_id, individual_id, tag_id having count(*) > 1 "
    "union all select study_id from m_kept_deployment group by study_id, tag_id, deploy_on_timestamp having count(*) > 1 "
    "union all select study_id from m_kept_deployment group by study_id, tag_id, deploy_off_timestamp having count(*) > 1 "
    "union all select e.study_id from (select distinct study_id, tag_id, sensor_type_id from m_located) e left join "
    "(select study_id, tag_id, sensor_type_id, count(*) as n from m_kept_sensor group by all) s "
    "on e.study_id = s.study_id and e.tag_id = s.tag_id and e.sensor_type_id = s.sensor_type_id where coalesce(s.n, 0) <> 1 "
    "union all select study_id from m_study where study_id not in (select study_id from m_located) "
    "union all select study_id from m_study where study_id not in (select study_id from m_raw where study_id is not null) "
    "union all select study_id from m_study where study_id not in (select study_id from m_individual))"
)


def cleaned(t: Testbed):
    return clean(t.raw, as_of=AS_OF)


@query(
    "K1 K3",
    "select event_id, study_id, individual_id, tag_id, lon, lat, {{ts:timestamp}} as timestamp, ground_speed, "
    "horizontal_accuracy, time_to_fix, fix_type from m_final where study_id not in (select study_id from m_failed)",
)
def cleaned_events(t: Testbed):
    event = cleaned(t).tables["event"]
    return without_nan(event, ["ground_speed", "horizontal_accuracy"]).select(
        "event_id", "study_id", "individual_id", "tag_id", "lon", "lat", "timestamp",
        "ground_speed", "horizontal_accuracy", "time_to_fix", "fix_type",
    )


@query("K1 K3", "select study_id from m_failed")
def rejected_studies(t: Testbed):
    return cleaned(t).failed


@query(
    "K1 C21",
    f"select study_id, reason, count(*) as num from (select study_id, coalesce({BAD_SQL}, 'undeployed') as reason from m_raw "
    "where event_id not in (select event_id from m_located)) group by all union all "
    "select l.study_id, 'duplicate', l.n - u.n from (select study_id, count(*) as n from m_located group by 1) l join "
    "(select study_id, count(*) as n from m_unique group by 1) u on l.study_id = u.study_id where l.n > u.n",
)
def rejected_events(t: Testbed):
    return cleaned(t).rejects


@query(
    "K2 K3 A13",
    "select study_id, 'clean' as step, case when study_id in (select study_id from m_failed) then 'fail' else 'success' end as result from m_study "
    "union all select study_id, 'import', 'success' from m_study where study_id not in (select study_id from m_failed) "
    "union all select study_id, 'validate', 'success' from m_study where study_id not in (select study_id from m_failed)",
)
def load_status(t: Testbed):
    clean_root, table_root = scratch_path(t.spark, "clean"), scratch_path(t.spark, "tables")
    return run(t.spark, t.raw, clean_root, table_root, "civ", as_of=AS_OF)


_COUNTS = (
    "select study_id, 'study' as entity, count(*) as {n} from m_study {w} group by 1 "
    "union all select study_id, 'individual', count(*) from m_owner {w} group by 1 "
    "union all select study_id, 'tag', count(*) from m_kept_tag {w} group by 1 "
    "union all select study_id, 'sensor', count(*) from m_kept_sensor {w} group by 1 "
    "union all select study_id, 'deployment', count(*) from m_kept_deployment {w} group by 1 "
    "union all select study_id, 'event', count(*) from m_unique {w} group by 1"
)
_PASSED = "where study_id not in (select study_id from m_failed)"


@query("K4 A11", _COUNTS.format(n="num", w=_PASSED))
def imported_rows(t: Testbed):
    """Rows per study and table of an import, all shown by one commit."""
    root = scratch_path(t.spark, "tables")
    return import_clean(t.spark, cleaned(t).tables, root).rows


@query("K4", _COUNTS.format(n="num", w=_PASSED))
def dry_run_rows(t: Testbed):
    root = scratch_path(t.spark, "tables")
    return import_clean(t.spark, cleaned(t).tables, root, dry_run=True).rows


@query(
    "J17 K4",
    f"select study_id, entity, n as file_rows, n as table_rows, true as equal from ({_COUNTS.format(n='n', w=_PASSED)})",
)
def validated_import(t: Testbed):
    root = scratch_path(t.spark, "tables")
    ready = cleaned(t).tables
    import_clean(t.spark, ready, root)
    return validate_import(ready, tables.read_tables(t.spark, root))


@query(
    "J16 K4",
    "select study_id, count(*) as num from (select study_id, event_id from m_unique "
    f"{_PASSED}) group by study_id",
)
def second_import_refused(t: Testbed):
    """Importing the same studies again: every event id is taken."""
    root = scratch_path(t.spark, "tables")
    ready = cleaned(t).tables
    import_clean(t.spark, ready, root)
    again = import_clean(t.spark, ready, root)
    events = again.violations.where(F.col("key").startswith("event/"))
    return events.groupBy("study_id").agg(F.count("*").alias("num"))


_OWN = "(select individual_id from m_individual where study_id = 6)"


def _deleted(tags: str) -> str:
    return (
        "select 'event' as entity, count(*) as num from m_raw where study_id = 6 union all "
        f"select 'deployment', count(*) from m_deployment where individual_id in {_OWN} union all "
        "select 'individual', count(*) from m_individual where study_id = 6 union all "
        "select 'study', count(*) from m_study where study_id = 6 union all "
        f"select 'tag', count(*) from m_tag where tag_id in ({tags}) union all "
        f"select 'sensor', count(*) from m_sensor where tag_id in ({tags})"
    )


_USED = f"select tag_id from m_deployment where individual_id in {_OWN}"


@query("K5", _deleted(_USED))
def deleted_rows(t: Testbed):
    return delete_counts(split_for_delete(t.raw, 6))


_LENT = (
    "select tag_id from m_deployment where individual_id in "
    "(select individual_id from m_individual where study_id = 9) and individual_id % 2 = 0"
)


def _with_shared_tags(t: Testbed):
    """Study 6 also deploys some tags of study 9."""
    lent = t.deployment.where("study_id = 9 and individual_id % 2 = 0")
    first = t.individual.groupBy("study_id").agg(F.min("individual_id").alias("individual_id"))
    extra = (
        lent.drop("individual_id")
        .withColumn("deployment_id", F.col("deployment_id") + 1_000_000_000)
        .withColumn("study_id", F.lit(6).cast("bigint"))
        .join(first, "study_id")
    )
    return {**t.raw, "deployment": t.deployment.unionByName(extra)}


@query(
    "K5 shared",
    f"select 'tag' as entity, count(*) as num from m_tag where tag_id in ({_USED}) union all "
    f"select 'sensor', count(*) from m_sensor where tag_id in ({_USED})",
)
def deleted_rows_keep_shared(t: Testbed):
    counts = delete_counts(split_for_delete(_with_shared_tags(t), 6, "keep"))
    return counts.where("entity in ('tag', 'sensor')")


@query(
    "K5 shared",
    f"select 'tag' as entity, count(*) as num from m_tag where tag_id in ({_USED} union all {_LENT}) union all "
    f"select 'sensor', count(*) from m_sensor where tag_id in ({_USED} union all {_LENT})",
)
def deleted_rows_with_shared(t: Testbed):
    counts = delete_counts(split_for_delete(_with_shared_tags(t), 6, "delete"))
    return counts.where("entity in ('tag', 'sensor')")


def loaded(t: Testbed, db) -> str:
    """All tables as they are, in one load."""
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    load = tables.new_load_id()
    for entity in ENTITIES:
        rows = tables.append_rows(conform(db[entity], entity), root, entity, load)
        parts = rows.selectExpr(f"'{load}' as load_id", "study_id", f"'{entity}' as entity", "'live' as state")
        tables.commit(parts, root)
    return root


@query(
    "K5 A8",
    "select 'tag' as entity, study_id, count(*) as num from m_tag where study_id <> 6 group by 2 union all "
    "select 'sensor', study_id, count(*) from m_sensor where study_id <> 6 group by 2 union all "
    "select 'individual', study_id, count(*) from m_individual where study_id <> 6 group by 2 union all "
    "select 'deployment', study_id, count(*) from m_deployment where study_id <> 6 group by 2 union all "
    "select 'study', study_id, count(*) from m_study where study_id <> 6 group by 2 union all "
    "select 'event', study_id, count(*) from m_raw where study_id <> 6 group by 2",
)
def rows_after_delete(t: Testbed):
    """What the tables hold once study 6 is deleted. Tags never deployed stay, with their study."""
    deployed = t.deployment.select("tag_id").distinct()
    db = dict(t.raw)
    gone = F.col("study_id") == 6
    for entity in ("tag", "sensor"):
        own = db[entity].where(gone).join(deployed, "tag_id", "left_semi")
        db[entity] = db[entity].where(~gone).unionByName(own)
    root = loaded(t, db)
    delete_study(t.spark, root, 6)
    out = None
    for entity, df in tables.read_tables(t.spark, root).items():
        part = df.groupBy("study_id").agg(F.count("*").alias("num"))
        part = part.select(F.lit(entity).alias("entity"), "study_id", "num")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "K2 A7",
    "select study_id, 'clean' as step, case when study_id in (select study_id from m_failed) then 'fail' else 'success' end as result from m_study where study_id % 2 = 0",
)
def clean_marked_studies(t: Testbed):
    """Only the clean step, only for studies marked to run."""
    control = t.study.where("study_id % 2 = 0").select("study_id")
    clean_root, table_root = scratch_path(t.spark, "clean"), scratch_path(t.spark, "tables")
    return run(t.spark, t.raw, clean_root, table_root, "c", control, as_of=AS_OF)


@query(
    "A14 E9 K5",
    "select individual_id, {{ts:min(timestamp)}} as ts_min, {{ts:max(timestamp)}} as ts_max, min(lon) as lon_min, max(lon) as lon_max, "
    "avg(lon) as lon_mean, min(lat) as lat_min, max(lat) as lat_max, avg(lat) as lat_mean from m_good "
    "where study_id is not null and study_id <> 6 group by individual_id",
)
def merged_stats(t: Testbed):
    """Two loads that share individuals, and a deleted study: statistics from the stored states."""
    root = scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, root)
    events = keep_valid(t.raw_event, event_rules(AS_OF)).where("study_id is not null")
    for rest in (0, 1):
        load = tables.new_load_id()
        rows = tables.append_rows(events.where(f"floor(event_id / 4) % 2 = {rest}"), root, "event", load)
        tables.append_states(t.spark, root, load)
        tables.commit(rows.selectExpr(f"'{load}' as load_id", "study_id", "'event' as entity", "'live' as state"), root)
    delete_study(t.spark, root, 6)
    return tables.merged_stats(t.spark, root)

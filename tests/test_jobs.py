"""Raw files of three studies: cleaned, imported, validated, deleted."""

import fixtures
import pytest
from pyspark.sql import functions as F

from tracklake.operators import checks, reports
from tracklake.plans.clean import clean
from tracklake.plans.load import import_clean, read_clean, run, validate_import
from tracklake.plans.remove import delete_counts, delete_study, extract_study, split_for_delete
from tracklake.schema import ENTITIES, EVENT_STATS_SCHEMA
from tracklake.session import scope, scratch_path, stage
from tracklake.sources import files, lookup, raw, tables


@pytest.fixture(scope="module")
def raw_tables(spark, tmp_path_factory):
    root = fixtures.write(tmp_path_factory.mktemp("job") / "csv", fixtures.three_studies())
    return {e: raw.read_raw(spark, root, e) for e in ENTITIES}


@pytest.fixture(scope="module")
def cleaned(raw_tables):
    return clean(raw_tables)


@pytest.fixture(scope="module")
def database(spark, cleaned):
    root = scratch_path(spark, "db")
    return root, import_clean(spark, cleaned.tables, root)


def counts(db):
    return {e: df.count() for e, df in db.items()}


def test_clean_events(cleaned):
    events = {r.event_id: r for r in cleaned.tables["event"].collect()}
    assert set(events) == {100002, 100004, 100009, 200002, 200004, 200009}
    first = events[100002]
    assert (first.horizontal_accuracy, first.time_to_fix, first.fix_type) == (36.61, 60.0, 3)
    assert events[100004].horizontal_accuracy == 5.0
    assert first.study_id == 1000


def test_what_does_not_belong_is_left_out(cleaned):
    assert counts(cleaned.tables) == {
        "study": 2, "individual": 4, "tag": 4, "sensor": 4, "deployment": 4, "event": 6,
    }


def test_rejects_are_counted(cleaned):
    rejects = {(r.study_id, r.reason): r.num for r in cleaned.rejects.collect()}
    one = {k[1]: v for k, v in rejects.items() if k[0] == 1000}
    # the human's event, the one without an individual, and the one at the deployment's end
    assert one == {"visible": 1, "zero": 1, "undeployed": 3, "duplicate": 1}


def test_bad_study_is_named(cleaned):
    assert {(r.study_id, r.check) for r in cleaned.violations.collect()} == {(3000, "event_sensor")}
    assert [r.study_id for r in cleaned.failed.collect()] == [3000]


def test_import_and_validation(spark, cleaned, database):
    root, imported = database
    assert imported.committed and imported.violations.count() == 0
    db = tables.read_tables(spark, root)
    assert counts(db) == counts(cleaned.tables)
    compared = validate_import(cleaned.tables, db).collect()
    assert len(compared) == 12 and all(r.equal for r in compared)


def test_dry_run_shows_nothing(spark, cleaned):
    root = scratch_path(spark, "db")
    done = import_clean(spark, cleaned.tables, root, dry_run=True)
    assert not done.committed
    assert {(r.entity, r.study_id): r.num for r in done.rows.collect()}[("event", 1000)] == 3
    assert not tables.exists(spark, root)


def test_study_that_borrows_from_a_refused_one_is_refused(spark, cleaned):
    """Study 1000 repeats an individual; study 2000 uses one of its tags."""
    new = dict(cleaned.tables)
    new["individual"] = new["individual"].unionByName(new["individual"].where("study_id = 1000").limit(1))
    lent = new["deployment"].where("study_id = 1000").first()["tag_id"]
    tag = F.when(F.col("study_id") == 2000, F.lit(lent)).otherwise(F.col("tag_id"))
    new["deployment"] = new["deployment"].withColumn("tag_id", tag)
    root = scratch_path(spark, "db")
    done = import_clean(spark, new, root)
    assert {r.study_id for r in done.violations.select("study_id").distinct().collect()} == {1000, 2000}
    assert done.passed.isEmpty() and sum(counts(tables.read_tables(spark, root)).values()) == 0


def test_statistics_are_written_once(spark):
    root = scratch_path(spark, "db")
    stats = spark.createDataFrame([(1,)], "individual_id bigint")
    for field in EVENT_STATS_SCHEMA.split(", ")[1:]:
        name, kind = field.split()
        stats = stats.withColumn(name, F.lit(None).cast(kind))
    tables.create_tables(spark, root)
    tables.write_event_stats(stats, root)
    with pytest.raises(ValueError):
        tables.write_event_stats(stats, root)
    assert tables.read_event_stats(spark, root).count() == 1


def test_reports_of_a_study_read_its_folders(spark, cleaned, database):
    db = tables.read_tables(spark, database[0])
    plan = reports.events_per_individual(db["event"], db["individual"], 1000)._jdf.queryExecution().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line or "FileScan" in line]
    assert any("study_id" in line and "1000" in line.split("PartitionFilters")[-1] for line in filters)
    assert reports.events_per_individual(db["event"], db["individual"], 1000).agg(F.sum("num")).first()[0] == 3


def test_rows_without_commit_are_not_seen(spark, cleaned):
    root = scratch_path(spark, "db")
    tables.create_tables(spark, root)
    tables.append_rows(cleaned.tables["tag"], root, "tag", tables.new_load_id())
    assert tables.read_table(spark, root, "tag").count() == 0


def test_second_import_changes_nothing(spark, cleaned, database):
    root, _ = database
    before = counts(tables.read_tables(spark, root))
    again = import_clean(spark, cleaned.tables, root)
    assert {r.study_id for r in again.violations.select("study_id").distinct().collect()} == {1000, 2000}
    assert counts(tables.read_tables(spark, root)) == before


def test_delete(spark, cleaned):
    root = scratch_path(spark, "db")
    import_clean(spark, cleaned.tables, root)
    deleted = {r.entity: r.num for r in delete_study(spark, root, 1000).collect()}
    assert deleted == {"study": 1, "individual": 2, "tag": 2, "sensor": 2, "deployment": 2, "event": 3}
    db = tables.read_tables(spark, root)
    assert counts(db) == deleted
    assert all({r.study_id for r in df.select("study_id").collect()} == {2000} for df in db.values())
    back = import_clean(spark, {e: df.where("study_id = 1000") for e, df in cleaned.tables.items()}, root)
    assert back.violations.count() == 0
    assert counts(tables.read_tables(spark, root)) == counts(cleaned.tables)


@pytest.mark.parametrize("choice", ["keep", "delete"])
def test_tag_shared_by_two_studies(spark, cleaned, choice):
    """Study 2000 also uses a tag of study 1000."""
    lent = cleaned.tables["deployment"].where("deployment_id = 1031").selectExpr(
        "cast(9999 as bigint) as deployment_id", "local_identifier", "cast(2001 as bigint) as individual_id",
        "tag_id", "deploy_off_timestamp as deploy_on_timestamp", "cast(null as timestamp) as deploy_off_timestamp",
        "cast(2000 as bigint) as study_id",
    )
    given = {**cleaned.tables, "deployment": cleaned.tables["deployment"].unionByName(lent)}
    root = scratch_path(spark, "db")
    assert import_clean(spark, given, root).violations.count() == 0
    deleted = {r.entity: r.num for r in delete_study(spark, root, 1000, shared_tags=choice).collect()}
    left = {r.tag_id: r.study_id for r in tables.read_table(spark, root, "tag").collect()}
    if choice == "keep":
        assert deleted["tag"] == deleted["sensor"] == 1
        assert left == {1011: 2000, 2011: 2000, 2012: 2000}
    else:
        assert deleted["tag"] == deleted["sensor"] == 2
        assert left == {2011: 2000, 2012: 2000}
    assert tables.read_table(spark, root, "event").count() == 3


def test_extract(cleaned):
    assert counts(extract_study(cleaned.tables, 2000)) == {
        "study": 1, "individual": 2, "deployment": 2, "tag": 2, "sensor": 2, "event": 3,
    }


WANT = {
    (1000, "clean", "success"), (3000, "clean", "fail"),
    (1000, "import", "success"), (1000, "validate", "success"),
}


def check_loaded(spark, clean_root, db, file_format):
    event = read_clean(spark, clean_root, file_format)["event"]
    assert {r.event_id for r in event.collect()} == {100002, 100004, 100009}
    stored = {r.event_id: r for r in tables.read_table(spark, db, "event").collect()}
    assert set(stored) == {100002, 100004, 100009}
    assert stored[100002].timestamp.microsecond == 1000


def test_all_steps(spark, tmp_path):
    root = fixtures.write(tmp_path / "csv", fixtures.three_studies())
    control = lookup.studies_to_run(
        spark.createDataFrame([(1000, 1), (2000, 0), (3000, 1)], "study_id bigint, run int")
    )
    clean_root, db, log = (str(tmp_path / n) for n in ("clean", "db", "status"))
    status = run(spark, root, clean_root, db, "civ", control, log)
    assert {tuple(r) for r in status.collect()} == WANT
    assert {tuple(r) for r in lookup.read_status(spark, log).collect()} == WANT
    check_loaded(spark, clean_root, db, "parquet")


def test_steps_one_by_one_through_csv(spark, tmp_path):
    studies = fixtures.three_studies()
    root = fixtures.write(tmp_path / "csv", {i: studies[i] for i in (1000, 3000)})
    clean_root, db = str(tmp_path / "clean"), str(tmp_path / "db")
    lines = []
    for raw_root, step in ((root, "c"), (None, "i"), (None, "v")):
        lines += run(spark, raw_root, clean_root, db, step, file_format="csv").collect()
    assert {tuple(r) for r in lines} == WANT
    check_loaded(spark, clean_root, db, "csv")
    with pytest.raises(ValueError):
        run(spark, root, clean_root, db, "dciv")


def test_totals_reported_and_computed(raw_tables, cleaned):
    done = reports.computed_totals(
        cleaned.tables["individual"], cleaned.tables["deployment"], cleaned.tables["event"]
    )
    lines = {
        (r.study_id, r.metric): (r.reported, r.computed)
        for r in reports.compare_totals(raw_tables["study"], done).collect()
    }
    assert lines[(1000, "number_of_individuals")] == ("2", "2")
    assert lines[(1000, "number_of_deployed_locations")] == ("9", "3")
    assert lines[(1000, "timestamp_first_deployed_location")] == (
        "2020-01-01 00:00:00.000", "2020-01-05 10:00:00.001",
    )
    assert lines[(3000, "number_of_individuals")] == ("2", None)


def test_a_bad_file_fails_its_study_alone(spark, tmp_path):
    """Study 2000 has a header without a key, study 1000 one in another order."""
    root = fixtures.write(tmp_path / "csv", fixtures.three_studies())
    tag = tmp_path / "csv" / "2000" / "raw" / "tag.csv"
    tag.write_text(tag.read_text().replace("id,local_identifier", "key,local_identifier", 1))
    sensor = tmp_path / "csv" / "1000" / "raw" / "sensor.csv"
    lines = [",".join(reversed(line.split(","))) for line in sensor.read_text().split("\n")]
    sensor.write_text("\n".join(lines))
    clean_root, db = str(tmp_path / "clean"), str(tmp_path / "db")
    status = {tuple(r) for r in run(spark, root, clean_root, db, "civ").collect()}
    assert status == {
        (1000, "clean", "success"), (2000, "clean", "fail"), (3000, "clean", "fail"),
        (1000, "import", "success"), (1000, "validate", "success"),
    }
    assert tables.read_table(spark, db, "sensor").count() == 2


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_no_study_passes(spark, tmp_path, file_format):
    root = fixtures.write(tmp_path / "csv", {3000: fixtures.three_studies()[3000]})
    clean_root, db = str(tmp_path / "clean"), str(tmp_path / "db")
    status = run(spark, root, clean_root, db, "civ", file_format=file_format)
    assert {tuple(r) for r in status.collect()} == {(3000, "clean", "fail")}
    assert all(df.isEmpty() for df in tables.read_tables(spark, db).values())


def test_cleaning_tells_problems_and_totals(spark, tmp_path):
    studies = fixtures.three_studies()
    studies[1000]["event"] = [*studies[1000]["event"], fixtures.event(1, 1001, 1011, "noon"), "1,2,3"]
    root = fixtures.write(tmp_path / "csv", studies)
    found = files.read_files(spark, files.list_raw(spark, root))
    done = clean(found.tables, problems=found.problems)
    lost = {(r.study_id, r.entity, r.kind, r.column, r.num) for r in done.problems.collect()}
    assert lost == {(1000, "event", "value", "timestamp", 1), (1000, "event", "line", None, 1)}
    assert (1000, "malformed", 1) in {tuple(r) for r in done.rejects.collect()}
    totals = {(r.study_id, r.metric): (r.reported, r.computed) for r in done.totals.collect()}
    assert totals[(1000, "number_of_deployed_locations")] == ("9", "3")
    assert done.tables["event"].where("study_id = 1000").count() == 3


def test_extract_takes_what_delete_takes(spark, cleaned):
    """An event of the study without an individual goes with it."""
    lone = cleaned.tables["event"].limit(1).withColumn("individual_id", F.lit(None).cast("bigint")).withColumn("study_id", F.lit(2000).cast("bigint"))
    db = {**cleaned.tables, "event": cleaned.tables["event"].unionByName(lone)}
    taken = counts(extract_study(db, 2000))
    deleted = {r.entity: r.num for r in delete_counts(split_for_delete(db, 2000)).collect()}
    assert taken == deleted and taken["event"] == 4


def test_staged_folders_go_with_their_scope(spark):
    outer = []
    with scope(spark) as keep:
        first = stage(spark.range(3), "first")
        with scope(spark) as keep_inside:
            second = keep_inside(stage(first.where("id > 0"), "second"))
            gone = stage(spark.range(1), "gone")
            outer += [f.inputFiles()[0] for f in (first, second, gone)]
        assert [tables.exists(spark, f) for f in outer] == [True, True, False]
        keep(second)
    assert [tables.exists(spark, f) for f in outer] == [False, True, False]
    assert second.count() == 2


def test_a_chain_of_borrowing_studies_is_refused(spark, cleaned):
    """Five studies, each with a tag of the one before; the first repeats an individual."""
    def shifted(df, by):
        ids = [c for c in df.columns if c.endswith("_id") and c != "sensor_type_id"]
        return df.withColumns({c: F.col(c) + by * 100_000 for c in ids})

    one = {e: df.where("study_id = 1000") for e, df in cleaned.tables.items()}
    new = {e: df for e, df in one.items()}
    for by in range(1, 6):
        for e, df in one.items():
            new[e] = new[e].unionByName(shifted(df, by))
    new["individual"] = new["individual"].unionByName(one["individual"].limit(1))
    before = F.when(F.col("study_id") > 1000, F.col("tag_id") - 100_000).otherwise(F.col("tag_id"))
    new["deployment"] = new["deployment"].withColumn("tag_id", F.when(F.col("study_id") < 500_000, before).otherwise(F.col("tag_id")))
    done = import_clean(spark, new, scratch_path(spark, "db"))
    assert {r.study_id for r in done.passed.collect()} == {501_000}
    assert {r.study_id for r in done.violations.collect()} == {1000 + 100_000 * i for i in range(5)}


def test_stored_ids_are_not_moved(spark, cleaned, database):
    root, _ = database
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = tables.id_index(spark, root)
        stored, buckets = index["event"]
        assert buckets == 64 and stored.count() == 6
        rows = checks.taken_keys({"event": cleaned.tables["event"]}, {}, {"event": index["event"]})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bucketed = [line for line in plan.split("\n") if "Bucketed: true" in line]
    assert bucketed, plan
    # Above the scan of stored ids, up to the join, there is no exchange.
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    up, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            up.append(line)
            level = depth(line)
            if "LeftSemi" in line and "_key" in line:
                break
    assert up and not any("Exchange" in line and "Broadcast" not in line for line in up), "\n".join(up)

"""Every check with a passing and a failing case."""

from tracklake.operators import checks

DEP = "study_id bigint, deployment_id bigint, individual_id bigint, tag_id bigint, deploy_on_timestamp timestamp, deploy_off_timestamp timestamp"
ON, OFF, LATER = "2020-01-01 00:00:00", "2020-02-01 00:00:00", "2020-03-01 00:00:00"
EVENT = "study_id bigint, event_id bigint, individual_id bigint, tag_id bigint, sensor_type_id bigint, timestamp timestamp"


def found(df):
    return sorted((r.study_id, r.check, r.key) for r in df.collect())


def test_entities_have_records(frame):
    studies = frame([(1,), (2,)], "study_id bigint")
    tags = frame([(1, 5)], "study_id bigint, tag_id bigint")
    assert found(checks.entities_without_records(studies, {"tag": tags})) == [(2, "has_records", "tag")]


def test_tags_have_deployments(frame):
    tags = frame([(1, 5), (1, 6)], "study_id bigint, tag_id bigint")
    dep = frame([(1, 1, 1, 5, ON, OFF)], DEP)
    assert found(checks.tags_without_deployment(tags, dep)) == [(1, "tag_deployed", "6")]


def test_individual_and_tag_meet_once(frame):
    dep = frame([(1, 1, 1, 5, ON, OFF), (1, 2, 1, 5, LATER, None), (1, 3, 2, 5, LATER, None)], DEP)
    assert found(checks.repeated_deployments(dep)) == [(1, "deployment_unique", "1/5")]


def test_ends_of_deployments_of_one_tag_differ(frame):
    fine = frame([(1, 1, 1, 5, ON, OFF), (1, 2, 2, 5, OFF, None), (1, 3, 3, 6, ON, OFF)], DEP)
    assert found(checks.shared_deployment_ends(fine)) == []
    open_twice = frame([(1, 1, 1, 5, None, OFF), (1, 2, 2, 5, None, LATER)], DEP)
    assert checks.shared_deployment_ends(open_twice).first().detail == "deploy_on_timestamp"
    assert checks.shared_deployment_ends(open_twice).count() == 1


def test_primary_keys(frame):
    tags = frame([(1, 5), (1, 5), (2, 5)], "study_id bigint, tag_id bigint")
    assert found(checks.repeated_keys(tags, "tag")) == [(1, "primary_key", "tag/5")]
    studies = frame([(1,), (1,)], "study_id bigint")
    assert found(checks.repeated_keys(studies, "study")) == [(1, "primary_key", "study/1")]


def test_one_missing_and_one_doubled_sensor_do_not_cancel_out(frame):
    events = frame([(1, 1, 1, 5, 653, ON), (1, 2, 1, 6, 653, ON), (1, 3, 1, 7, 653, ON)], EVENT)
    sensors = frame([(1, 1, 5, 653), (1, 2, 5, 653), (1, 3, 7, 653)], "study_id bigint, sensor_id bigint, tag_id bigint, sensor_type_id bigint")
    got = found(checks.events_without_single_sensor(checks.profile(events), sensors))
    assert got == [(1, "event_sensor", "5/653"), (1, "event_sensor", "6/653")]


def test_events_inside_deployments(frame):
    schema = EVENT + ", deployment_id bigint, deploy_on_timestamp timestamp, deploy_off_timestamp timestamp"
    events = frame(
        [(1, 1, 1, 5, 653, ON, 9, ON, OFF), (1, 2, 1, 5, 653, OFF, 9, ON, OFF), (1, 3, 1, 5, 653, LATER, 8, None, None)],
        schema,
    )
    assert found(checks.events_outside_deployment(checks.profile(events))) == [(1, "event_in_deployment", "9")]


def test_events_with_individual_and_tag(frame):
    events = frame([(1, 1, None, 5, 653, ON), (1, 2, 1, 6, 653, ON), (1, 3, 1, None, 653, ON)], EVENT)
    profile = checks.profile(events)
    assert found(checks.events_without_individual(profile)) == [(1, "event_individual", "5")]
    tags = frame([(1, 5)], "study_id bigint, tag_id bigint")
    assert found(checks.events_without_tag(profile, tags)) == [(1, "event_tag", "6"), (1, "event_tag", "NA")]
    dep = frame([(1, 1, 1, 6, ON, OFF)], DEP)
    assert (1, "event_tag_deployed", "5") in found(checks.events_without_deployed_tag(profile, dep))


def test_events_remain(frame):
    studies = frame([(1,), (2,)], "study_id bigint")
    events = frame([(1, 1, 1, 5, 653, ON)], EVENT)
    assert found(checks.studies_without_events(studies, events)) == [(2, "events_remain", "event")]


def test_dedupe_checks(frame):
    before = frame([(1, 1, 1, 5, 653, ON), (1, 2, 1, 5, 653, ON), (1, 3, 1, 5, 653, OFF)], EVENT)
    good = frame([(1, 1, 1, 5, 653, ON), (1, 3, 1, 5, 653, OFF)], EVENT)
    lost = frame([(1, 1, 1, 5, 653, ON)], EVENT)
    assert found(checks.dedupe_arithmetic(before, good)) == []
    assert found(checks.dedupe_arithmetic(before, before)) == [(1, "dedupe_arithmetic", "event")]
    assert checks.dedupe_arithmetic(before, lost).first().detail == "2 groups, 1 rows"
    assert found(checks.remaining_duplicates(good)) == []
    assert checks.remaining_duplicates(before).count() == 1


def test_text(frame):
    rows = [(1, 1, "fine"), (1, 2, " lead"), (1, 3, "trail "), (1, 4, "a\nb"), (1, 5, " x"), (1, 6, None)]
    df = frame(rows, "study_id bigint, tag_id bigint, comments string")
    got = {(r.key, r.detail) for r in checks.untidy_text(df, "tag", "tag_id").collect()}
    assert got == {
        ("tag/2/comments", "leading blank"),
        ("tag/3/comments", "trailing blank"),
        ("tag/4/comments", "line break"),
        ("tag/5/comments", "leading blank"),
    }


def test_references_and_taken_keys(frame):
    study = frame([(1,)], "study_id bigint")
    people = frame([(1, 7)], "study_id bigint, individual_id bigint")
    tags = frame([(1, 5)], "study_id bigint, tag_id bigint")
    sensors = frame([(1, 1, 5), (1, 2, 6)], "study_id bigint, sensor_id bigint, tag_id bigint")
    new = {"study": study, "individual": people, "tag": tags, "sensor": sensors}
    assert found(checks.broken_references(new, {})) == [(1, "foreign_key", "sensor.tag_id/6")]
    stored = {"tag": frame([(9, 6)], "study_id bigint, tag_id bigint")}
    assert found(checks.broken_references(new, stored)) == []
    assert found(checks.taken_keys({"tag": tags}, stored)) == []
    again = {"tag": frame([(9, 5)], "study_id bigint, tag_id bigint")}
    assert found(checks.taken_keys({"tag": tags}, again)) == [(1, "primary_key_taken", "tag/5")]
    both = frame([(1, 5), (2, 5)], "study_id bigint, tag_id bigint")
    assert len(found(checks.taken_keys({"tag": both}, {}))) == 2


def test_counts_compare(frame):
    schema = "study_id bigint, entity string, num bigint"
    files = frame([(1, "tag", 3), (1, "event", 4)], schema)
    rows = frame([(1, "tag", 3), (2, "tag", 1)], schema)
    got = {(r.study_id, r.entity): (r.file_rows, r.table_rows, r.equal) for r in checks.compare_counts(files, rows).collect()}
    assert got == {(1, "tag"): (3, 3, True), (1, "event"): (4, 0, False), (2, "tag"): (0, 1, False)}

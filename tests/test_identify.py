"""Names resolved by time, and the way from an export to clean tables."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake.operators import identify
from tracklake.operators.shape import conform
from tracklake.plans.export import as_raw_events, clean_export

TAG = "study_id bigint, tag_id bigint, local_identifier string"
PEOPLE = "study_id bigint, individual_id bigint, local_identifier string"
USE = "study_id bigint, deployment_id bigint, tag_id bigint, individual_id bigint, deploy_on_timestamp timestamp, deploy_off_timestamp timestamp"
SENSOR = "study_id bigint, sensor_id bigint, sensor_type_id bigint, tag_id bigint"
EXPORT = (
    "event_id bigint, study_id bigint, timestamp timestamp, tag_local_identifier string, "
    "individual_local_identifier string, sensor_type string"
)


@pytest.fixture
def entities(frame):
    """Tags 10 and 11 of study 1 share the name T: 10 in January and February, 11 in February and March."""
    return {
        "tag": frame([(1, 10, "T"), (1, 11, "T"), (1, 12, "U"), (1, 13, None), (2, 20, "T")], TAG),
        "individual": frame([(1, 5, "bird"), (1, 6, "crow"), (2, 7, "bird")], PEOPLE),
        "deployment": frame(
            [
                (1, 1, 10, 5, None, "2020-02-10 00:00:00"),
                (1, 2, 10, 5, "2020-02-01 00:00:00", "2020-03-01 00:00:00"),
                (1, 3, 11, 5, "2020-02-15 00:00:00", None),
                (1, 4, 12, 6, "2020-05-01 00:00:00", "2020-04-01 00:00:00"),
                (1, 5, 13, 6, None, None),
                (2, 6, 20, 7, None, None),
            ],
            USE,
        ),
        "sensor": frame([(1, 100, 653, 10), (1, 101, 653, 11), (1, 102, 653, 11), (2, 200, 653, 20)], SENSOR),
        "types": frame([(653, "GPS")], "id bigint, name string"),
    }


def resolved(export, e, **limits):
    out = identify.resolve_by_time(export, e["deployment"], e["tag"], e["individual"], e["sensor"], e["types"], **limits)
    return {r.event_id: (r.tag_id, r.individual_id, r.sensor_id, r.candidates, r.sensors) for r in out.collect()}


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "hot_rows": 2}])
def test_the_tag_deployed_at_the_time(frame, entities, limits):
    export = frame(
        [
            (1, 1, "2019-01-01 00:00:00", "T", "bird", "gps"),
            (2, 1, "2020-02-05 00:00:00", "T", "bird", "GPS"),  # two deployments of one tag
            (3, 1, "2020-02-15 00:00:00", "T", "bird", "GPS"),  # two tags
            (4, 1, "2020-03-01 00:00:00", "T", "bird", "GPS"),  # the first has ended; two sensors
            (5, 1, "2020-03-01 00:00:00", "T", "crow", "GPS"),
            (6, 1, "2020-04-15 00:00:00", "U", "crow", "GPS"),  # a deployment that ends before it begins
            (7, 1, "2020-02-05 00:00:00", None, "crow", "GPS"),  # no name meets no name
            (8, 2, "2020-02-15 00:00:00", "T", "bird", "odd"),
            (9, None, "2020-02-15 00:00:00", "T", "bird", "GPS"),
        ],
        EXPORT,
    )
    assert resolved(export, entities, **limits) == {
        1: (10, 5, 100, 1, 1), 2: (10, 5, 100, 1, 1), 3: (None, None, None, 2, 0), 4: (11, 5, None, 1, 2),
        5: (None, None, None, 0, 0), 6: (None, None, None, 0, 0), 7: (None, None, None, 0, 0),
        8: (20, 7, None, 1, 0), 9: (None, None, None, 0, 0),
    }


def test_violations_by_study(frame, entities):
    export = frame(
        [(1, 1, "2020-02-20 00:00:00", "T", "bird", "GPS"), (2, 1, "2020-02-21 00:00:00", "T", "bird", "GPS"),
         (3, 1, "2020-02-20 00:00:00", "T", "nobody", "GPS"), (4, 1, "2021-01-01 00:00:00", "T", "bird", "GPS")],
        EXPORT,
    )
    e = entities
    out = identify.resolve_by_time(export, e["deployment"], e["tag"], e["individual"], e["sensor"], e["types"])
    found = {(r.study_id, r.check, r.detail) for r in identify.identifier_violations(out).collect()}
    assert found == {(1, "identifier_ambiguous", "2"), (1, "identifier_unknown", "1"), (1, "identifier_sensor", "1")}


def test_empty_tables_and_columns_of_the_same_names(frame, entities):
    e = entities
    export = frame([(1, 1, "2020-01-01 00:00:00", "T", "bird", "GPS")], EXPORT).withColumn("tag_id", F.lit("old"))
    none = {k: df.limit(0) for k, df in e.items()}
    assert resolved(export, none) == {1: (None, None, None, 0, 0)}
    assert resolved(export, e) == {1: (10, 5, 100, 1, 1)}
    assert resolved(export.limit(0), e) == {}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(1, 3), st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.integers(0, 9))), max_size=25))
def test_intervals_tell_who_is_deployed_when(spark, uses):
    """Against counting the deployments of each moment. A tag has one name: its number and the name."""
    rows = [(1, n, (ord(n) - 64) * 10 + t, 5, a, b) for n, t, a, b in uses]
    kinds = "study_id long, name string, tag_id long, individual_id long, a int, b int"
    df = spark.createDataFrame(rows, kinds)
    at = lambda c: F.timestamp_seconds(F.col(c))
    use = df.select("study_id", "tag_id", "individual_id", at("a").alias("deploy_on_timestamp"), at("b").alias("deploy_off_timestamp"))
    tag = df.select("study_id", "tag_id", F.col("name").alias("local_identifier")).distinct()
    people = spark.createDataFrame([(1, 5, "bird")], "study_id long, individual_id long, local_identifier string")
    spans = identify.name_intervals(identify.named_deployments(use, tag, people, ["study_id"]), ["study_id"]).selectExpr(
        "tag_local_identifier as name", "tag_id", "candidates", "unix_seconds(deploy_on_timestamp) as a", "unix_seconds(deploy_off_timestamp) as b"
    ).collect()
    inside = lambda t, a, b: (a is None or t >= a) and (b is None or t < b)
    for t in range(-1, 11):
        want, got = defaultdict(set), defaultdict(list)
        for _, n, tag_id, _, a, b in rows:
            if inside(t, a, b):
                want[n].add(tag_id)
        for s in spans:
            if inside(t, s.a, s.b):
                got[s.name].append((s.candidates, s.tag_id))
        assert dict(got) == {n: [(len(ids), min(ids) if len(ids) == 1 else None)] for n, ids in want.items()}


def test_an_export_becomes_clean_tables(frame, entities, spark):
    e = entities
    study = conform(spark.createDataFrame([(1,), (2,)], "study_id long"), "study")
    people = conform(e["individual"], "individual")
    good = [
        (1, 2, "2020-02-05 00:00:00", "T", "bird", "GPS"), (2, 2, "2020-02-05 00:00:00", "T", "bird", "GPS"),
        (3, 2, "2020-02-06 00:00:00", "T", "nobody", "GPS"), (4, 1, "2020-02-20 00:00:00", "T", "bird", "GPS"),
    ]
    export = frame(good, EXPORT).withColumns({"lon": F.lit(1.5), "lat": F.lit(2.5), "visible": F.lit(True)})
    done = clean_export(export, {"study": study, "individual": people, **{k: e[k] for k in ("tag", "sensor", "deployment")}}, e["types"])
    assert {(r.study_id, r.event_id, r.tag_id, r.individual_id) for r in done.tables["event"].collect()} == {(2, 1, 20, 7)}
    assert {(r.study_id, r.reason, r.num) for r in done.rejects.collect()} >= {(2, "undeployed", 1), (2, "duplicate", 1)}
    assert (1, "identifier_ambiguous") in {(r.study_id, r.check) for r in done.violations.collect()}
    assert {r.study_id for r in done.passed.collect()} == {2}


def test_columns_of_raw_events(frame):
    out = as_raw_events(frame([(1, 1, "2020-01-01 00:00:00", "T", "bird", "GPS")], EXPORT))
    assert {"lon", "gps_dop", "eobs_status", "tag_id", "study_id"} <= set(out.columns)
    assert "tag_local_identifier" not in out.columns

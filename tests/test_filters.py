import math

import pytest

from tracklake.operators import filters

SCHEMA = "study_id bigint, visible boolean, lon double, lat double, timestamp timestamp, eobs_status string"
GOOD = (1, True, 10.0, 20.0, "2020-01-01 00:00:00", None)
AS_OF = "2021-01-01 00:00:00"


def changed(**values):
    names = ["study_id", "visible", "lon", "lat", "timestamp", "eobs_status"]
    return tuple(values.get(n, g) for n, g in zip(names, GOOD))


BROKEN = {
    "visible": changed(visible=False),
    "position": changed(lat=math.nan),
    "zero": changed(lon=0.0),
    "lon_range": changed(lon=180.5),
    "lat_range": changed(lat=-90.5),
    "time": changed(timestamp=None),
    "epoch": changed(timestamp="1970-01-01 00:00:00"),
    "future": changed(timestamp=AS_OF),
    "status": changed(eobs_status="B"),
}


@pytest.mark.parametrize("rule", BROKEN)
def test_each_rule_drops_its_event(frame, rule):
    df = frame([GOOD, BROKEN[rule]], SCHEMA)
    rules = filters.event_rules(AS_OF)
    assert filters.keep_valid(df, rules).count() == 1
    first = df.select(filters.first_failing_rule(df, rules)).collect()
    assert [r[0] for r in first] == [None, rule]


def test_edges_are_kept(frame):
    edges = [
        changed(lon=-180.0, lat=90.0),
        changed(visible=None),
        changed(eobs_status="A"),
        changed(timestamp="2020-12-31 23:59:59.999"),
    ]
    assert filters.keep_valid(frame(edges, SCHEMA), filters.event_rules(AS_OF)).count() == 4


def test_a_null_position_breaks_only_its_own_rule_first(frame):
    df = frame([changed(lon=None)], SCHEMA)
    rules = filters.event_rules(AS_OF)
    assert df.select(filters.first_failing_rule(df, rules)).first()[0] == "position"


def test_reject_report_adds_up(frame):
    df = frame([GOOD, *BROKEN.values()], SCHEMA)
    rules = filters.event_rules(AS_OF)
    report = filters.reject_report(df, rules).collect()
    assert {r.rule: r.dropped for r in report} == dict.fromkeys(BROKEN, 1)
    totals = filters.reject_totals(df, rules).first()
    assert (totals.rows_in, totals.rows_out, totals.rows_dropped) == (10, 1, 9)


def test_options_change_the_rules(frame):
    df = frame([BROKEN["lon_range"], BROKEN["future"]], SCHEMA)
    assert filters.keep_valid(df, filters.event_rules(AS_OF, check_range=False)).count() == 1
    assert filters.keep_valid(df, filters.event_rules(AS_OF, tolerance="1 day")).count() == 1


def test_species(frame):
    schema = "study_id bigint, individual_id bigint, local_identifier string, nick_name string, taxon_canonical_name string"
    df = frame(
        [
            (1, 1, "a", None, "HOMO Sapiens"),
            (1, 2, "b", None, None),
            (1, 3, "c", None, "Ciconia ciconia"),
            (2, 4, "d", None, None),
        ],
        schema,
    )
    assert {r.individual_id for r in filters.keep_allowed_species(df).collect()} == {2, 3, 4}
    assert {r.individual_id for r in filters.removed_species(df).collect()} == {1}
    old = filters.keep_allowed_species(df, keep_missing=False)
    assert {r.individual_id for r in old.collect()} == {3, 4}


def test_between_dates_leaves_out_the_last_day(frame):
    df = frame([("2019-09-30 23:59:59.999",), ("2019-10-01 00:00:00",)], "timestamp timestamp")
    assert filters.between_dates(df, "2019-09-01", "2019-10-01").count() == 1

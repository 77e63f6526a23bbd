import math
import random

from tracklake.operators import dedupe
from tracklake.operators.shape import merge_vendor_columns
from tracklake.session import stage

RAW = (
    "event_id bigint, study_id bigint, individual_id bigint, lon double, lat double, timestamp timestamp, "
    "tag_id bigint, sensor_type_id bigint, ground_speed double, eobs_horizontal_accuracy_estimate double, "
    "gps_horizontal_accuracy_estimate double, eobs_used_time_to_get_fix double, gps_time_to_fix double, "
    "eobs_type_of_fix double, gps_fix_type double"
)
# Pairs whose raw times differ by a millisecond; the fuller row stays.
PAIRS = [
    (194510657, 1, 10197543, -6.1711953, 37.2057857, "2013-06-11 10:01:01.000", 10197474, 653) + (None,) * 7,
    (194500753, 1, 10197543, -6.1711953, 37.2057857, "2013-06-11 10:01:01.001", 10197474, 653)
    + (1.07, 36.61, None, 60.0, None, 3.0, None),
    (171030229, 2, 8538159, 90.2069799, 27.4193768, "2013-02-09 09:00:52.000", 8499102, 653) + (None,) * 7,
    (177704316, 2, 8538159, 90.2069799, 27.4193768, "2013-02-09 09:00:52.001", 8499102, 653)
    + (0.59, 7.42, None, 5.0, None, 3.0, None),
]
SMALL = (
    "event_id bigint, study_id bigint, individual_id bigint, tag_id bigint, sensor_type_id bigint, "
    "timestamp timestamp, ground_speed double"
)


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_pairs_a_millisecond_apart(frame):
    kept = merge_vendor_columns(dedupe.dedupe_events(frame(PAIRS, RAW)))
    rows = {r.event_id: r for r in kept.collect()}
    assert set(rows) == {194500753, 177704316}
    row = rows[194500753]
    assert row.timestamp.microsecond == 1000
    assert (row.horizontal_accuracy, row.time_to_fix, row.fix_type) == (36.61, 60.0, 3)


def cases(frame):
    return frame(
        [
            # a pair, the second fuller
            (1, 1, 1, 1, 653, "2020-01-01 00:00:00.100", None),
            (2, 1, 1, 1, 653, "2020-01-01 00:00:00.900", 1.0),
            # a triple tied on values: the earliest time, not the lowest id
            (5, 1, 1, 1, 653, "2020-01-01 00:00:01.100", 1.0),
            (4, 1, 1, 1, 653, "2020-01-01 00:00:01.200", 1.0),
            (3, 1, 1, 1, 653, "2020-01-01 00:00:01.300", 1.0),
            # equal times: the lowest id
            (7, 1, 1, 1, 653, "2020-01-01 00:00:02", 1.0),
            (6, 1, 1, 1, 653, "2020-01-01 00:00:02", 2.0),
            # two sides of a second: both stay
            (8, 1, 1, 1, 653, "2020-01-01 00:00:03.999", 1.0),
            (9, 1, 1, 1, 653, "2020-01-01 00:00:04.000", 1.0),
            # NaN is no value
            (10, 1, 1, 1, 653, "2020-01-01 00:00:05.1", math.nan),
            (11, 1, 1, 1, 653, "2020-01-01 00:00:05.2", 3.0),
            # another study or sensor is another group
            (12, 2, 1, 1, 653, "2020-01-01 00:00:00.100", None),
            (13, 1, 1, 1, 7, "2020-01-01 00:00:00.100", None),
            # a missing sensor type is a group as well
            (14, 1, 1, 1, None, "2020-01-01 00:00:06", None),
            (15, 1, 1, 1, None, "2020-01-01 00:00:06", 1.0),
        ],
        SMALL,
    )


KEPT = [2, 5, 6, 8, 9, 11, 12, 13, 15]


def test_which_row_stays(frame):
    assert ids(dedupe.dedupe_events(cases(frame))) == KEPT


def test_stored_events_give_the_same(frame):
    events = stage(cases(frame), "events")
    groups = stage(dedupe.duplicate_groups(events), "groups")
    assert ids(dedupe.dedupe_stored(events, groups)) == KEPT
    many = dedupe.dedupe_stored(events, groups, broadcast_bytes=0)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert ids(many) == KEPT


def test_exact_times_only(frame):
    assert len(ids(dedupe.dedupe_events(cases(frame), unit=None))) == 13


def test_older_rule_for_ties(frame):
    rows = [
        (1, 1, 1, 1, 653, "2020-01-01 00:00:00", 1.0),
        (2, 1, 1, 1, 653, "2020-01-01 00:00:00", 1.0 + 1e-12),
        (3, 1, 1, 1, 653, "2020-01-01 00:00:00", 2.0),
        (4, 1, 1, 1, 653, "2020-01-01 00:00:00", None),
    ]
    assert ids(dedupe.dedupe_events(frame(rows, SMALL), ties="distinct")) == [1, 3]


def test_groups_and_their_events(frame):
    events = cases(frame)
    groups = {r.num for r in dedupe.duplicate_groups(events).collect()}
    assert groups == {2, 3}
    assert ids(dedupe.duplicate_events(events)) == [1, 2, 3, 4, 5, 6, 7, 10, 11, 14, 15]
    assert dedupe.groups_larger_than(events, 2).first().num == 1
    sizes = {r.event_id: r.num for r in dedupe.with_group_size(events).collect()}
    assert len(sizes) == 15 and sizes[3] == 3 and sizes[14] == 2 and sizes[13] == 1


def test_rows_removed_are_group_sizes_less_one(frame):
    events = cases(frame)
    removed = events.count() - dedupe.dedupe_events(events).count()
    assert removed == sum(r.num - 1 for r in dedupe.duplicate_groups(events).collect())


def test_one_group_holding_most_rows(frame):
    rng = random.Random(1)
    rows = [(i, 1, 1, 1, 653, "2020-01-01 00:00:00", rng.choice([None, 1.0])) for i in range(3000)]
    rows += [(i, 1, 1, 1, 653, f"2020-01-02 00:{i % 60:02d}:00", 1.0) for i in range(3000, 3060)]
    want = min(r[0] for r in rows[:3000] if r[6])
    events = stage(frame(rows, SMALL), "hot")
    groups = stage(dedupe.duplicate_groups(events), "groups")
    for kept in (dedupe.dedupe_events(events), dedupe.dedupe_stored(events, groups)):
        assert ids(kept) == [want, *range(3000, 3060)]


def test_groups_are_numbered_in_order(frame):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.randrange(40)) for _ in range(900)]
    df = frame(rows, "a bigint, b bigint").distinct()
    numbered = dedupe.number_groups(df, ["a", "b"]).collect()
    want = {pair: i for i, pair in enumerate(sorted(set(rows)), 1)}
    assert {(r.a, r.b): r.dup_id for r in numbered} == want


def test_near_duplicates_leave_out_exact_copies(frame):
    rows = [
        (1, 1, 1, 1, 653, "2020-01-01 00:00:00.000100", None),
        (2, 1, 1, 1, 653, "2020-01-01 00:00:00.000200", None),
        (3, 1, 1, 1, 653, "2020-01-01 00:00:01.000100", None),
        (4, 1, 1, 1, 653, "2020-01-01 00:00:01.000100", None),
        (5, 1, 1, 1, 653, "2020-01-01 00:00:02.000", None),
        (6, 1, 1, 1, 653, "2020-01-01 00:00:02.001", None),
    ]
    assert ids(dedupe.near_duplicate_events(frame(rows, SMALL))) == [1, 2]
    assert ids(dedupe.without_exact_duplicates(frame(rows, SMALL))) == [1, 2, 5, 6]


def test_speeds_of_exact_groups(frame):
    rows = [
        (1, 1, 1, 1, 653, "2020-01-01 00:00:00", None),
        (2, 1, 1, 1, 653, "2020-01-01 00:00:00", 1.000001),
        (3, 1, 1, 1, 653, "2020-01-01 00:00:00", 1.000002),
        (4, 1, 1, 1, 653, "2020-01-01 00:00:01", None),
        (5, 1, 1, 1, 653, "2020-01-01 00:00:01", math.nan),
    ]
    got = dedupe.speed_by_group(frame(rows, SMALL)).orderBy("ts_unit").collect()
    assert [(r.num, r.allna, r.numnotna, r.uniq) for r in got] == [(3, False, 2, 2), (2, True, 0, 1)]

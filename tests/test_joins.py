"""Joins against brute force, on both ways: side broadcast, and hot keys spread."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracklake.operators import relate
from tracklake.operators import joins, relate

EVENT = "event_id bigint, study_id bigint, individual_id bigint, tag_id bigint, timestamp timestamp"
DEPLOYMENT = (
    "deployment_id bigint, study_id bigint, individual_id bigint, tag_id bigint, "
    "deploy_on_timestamp timestamp, deploy_off_timestamp timestamp"
)
ON, OFF = "2020-01-10 00:00:00", "2020-01-20 00:00:00"
TIMES = {
    "before": "2020-01-09 23:59:59.999",
    "at on": ON,
    "inside": "2020-01-15 12:00:00",
    "at off": OFF,
    "after": "2020-01-20 00:00:00.001",
}
KEPT = {
    (True, True): {"at on", "inside"},
    (False, True): {"before", "at on", "inside"},
    (True, False): {"at on", "inside", "at off", "after"},
    (False, False): set(TIMES),
}
WAYS = {"broadcast": {}, "spread": {"broadcast_bytes": 0, "hot_rows": 3}}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("ends", KEPT)
def test_four_cases_of_missing_ends(frame, ends, way):
    has_on, has_off = ends
    deployment = frame([(1, 1, 1, 1, ON if has_on else None, OFF if has_off else None)], DEPLOYMENT)
    events = frame([(i, 1, 1, 1, t) for i, t in enumerate(TIMES.values())], EVENT)
    got = relate.interval_join(events, deployment, **WAYS[way]).collect()
    names = list(TIMES)
    assert {names[r.event_id] for r in got} == KEPT[ends]


def test_one_tag_on_two_animals_one_after_the_other(frame):
    deployment = frame(
        [(1, 1, 1, 7, ON, OFF), (2, 1, 2, 7, OFF, None)], DEPLOYMENT
    )
    events = frame(
        [(1, 1, 1, 7, "2020-01-15 00:00:00"), (2, 1, 1, 7, OFF), (3, 1, 2, 7, OFF), (4, 1, 2, 7, ON)], EVENT
    )
    got = relate.interval_join(events, deployment).select("event_id", "deployment_id").collect()
    assert {tuple(r) for r in got} == {(1, 1), (3, 2)}


def random_case(seed):
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)

    def when():
        return str(start + timedelta(hours=rng.randrange(240)))

    def key():
        return rng.choice([1, 1, 1, 1, 2, 3, None])

    events = [(i, 1, key(), rng.choice([1, 1, 1, 2]), when()) for i in range(200)]
    deployments = [
        (i, 1, a, b, rng.choice([None, when()]), rng.choice([None, when()]))
        for i, (a, b) in enumerate(itertools.product([1, 2, None], [1, 2]))
    ]
    return events, deployments


def brute(events, deployments):
    out = []
    for e in events:
        for d in deployments:
            same = e[1:4] == d[1:4] and None not in e[1:4]
            if same and (d[4] is None or e[4] >= d[4]) and (d[5] is None or e[4] < d[5]):
                out.append((e[0], d[0]))
    return sorted(out)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", range(3))
def test_interval_join_equals_brute_force(frame, way, seed):
    events, deployments = random_case(seed)
    ev, dep = frame(events, EVENT), frame(deployments, DEPLOYMENT)
    want = brute(events, deployments)
    got = relate.interval_join(ev, dep, **WAYS[way]).select("event_id", "deployment_id").collect()
    assert sorted(map(tuple, got)) == want
    left = relate.interval_join(ev, dep, how="left", **WAYS[way]).select("event_id", "deployment_id").collect()
    matched = {e for e, _ in want}
    missing = [(e[0], None) for e in events if e[0] not in matched]
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, want + missing))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_means_the_same(spark, how):
    facts = spark.range(500).select(
        "id", F.when(F.col("id") % 10 == 9, None).otherwise(F.col("id") % 10 % 4).alias("k")
    )
    side = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c"), (8, "d")], "k bigint, v string")
    want = sorted(map(str, facts.join(side, "k", how).select("id", "k").collect()))
    got = joins.join_facts(facts, side, ["k"], how, broadcast_bytes=0, hot_rows=20)
    assert sorted(map(str, got.select("id", "k").collect())) == want
    plain = joins.join_facts(facts, side, ["k"], how, broadcast_bytes=0, hot_rows=10_000)
    assert sorted(map(str, plain.select("id", "k").collect())) == want


def test_hot_keys_are_split_over_parts(spark):
    facts = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("bigint").alias("k"))
    hot = joins.hot_keys(facts, ["k"], 300)
    assert {(r.k, r._spread) for r in hot.collect()} == {(0, 3), (1, 2)}
    spread = joins._spread_facts(facts, hot, ["k"])
    parts = spread.groupBy("k", "_part").count().collect()
    assert len(parts) == 5
    assert max(r["count"] for r in parts) < 320


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equal_rows_of_a_hot_key_are_split(spark, how):
    facts = spark.range(1000, numPartitions=8).select(F.lit(1).cast("bigint").alias("k"))
    hot = joins.hot_keys(facts, ["k"], 100)
    assert joins._spread_facts(facts, hot, ["k"]).select("_part").distinct().count() > 3
    side = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    got = joins.join_facts(facts, side, ["k"], how, broadcast_bytes=0, hot_rows=100)
    assert got.count() == (0 if how == "left_anti" else 1000)


def test_full_and_right_joins_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        joins.join_facts(df, df, ["id"], "full")


def test_size_counts_text_and_refuses_arrays(spark):
    df = spark.createDataFrame([("x" * 1000,)], "s string")
    assert joins.measured_bytes(df) >= 1000
    assert joins.measured_bytes(spark.sql("select array(1) as a")) is None
    assert joins.measured_bytes(spark.sql("select struct(1 as x, 'abc' as y) as a")) == 16 * 3 + 3


def test_identifiers(frame):
    tag = frame([(1, 10, "T1"), (1, 11, "T2")], "study_id bigint, tag_id bigint, local_identifier string")
    people = frame([(1, 5, "bird")], "study_id bigint, individual_id bigint, local_identifier string")
    sensor = frame([(1, 100, 653, 10)], "study_id bigint, sensor_id bigint, sensor_type_id bigint, tag_id bigint")
    types = frame([(653, "GPS")], "id bigint, name string")
    export = frame(
        [(1, 1, "T1", "bird", "gps"), (2, 1, "T2", "nobody", "GPS"), (3, 1, None, "bird", "odd")],
        "event_id bigint, study_id bigint, tag_local_identifier string, individual_local_identifier string, sensor_type string",
    )
    out = relate.resolve_identifiers(export, tag, people, sensor, types, by=("study_id",))
    got = out.orderBy("event_id").select("tag_id", "individual_id", "sensor_type_id", "sensor_id").collect()
    assert [tuple(r) for r in got] == [(10, 5, 653, 100), (11, None, 653, None), (None, 5, None, None)]


def test_binned_join_meets_few_deployments(spark):
    """10,000 deployments of an hour on one pair, and 20,000 events: an event meets those of its bin alone."""
    use = spark.range(10_000).selectExpr(
        "1L as study_id", "2L as individual_id", "3L as tag_id", "id as deployment_id",
        "timestamp_seconds(id * 3600) as deploy_on_timestamp", "timestamp_seconds(id * 3600 + 3600) as deploy_off_timestamp",
    )
    event = spark.range(20_000).selectExpr("1L as study_id", "2L as individual_id", "3L as tag_id", "id as event_id", "timestamp_seconds(id * 1800) as timestamp")
    bins = relate.bins_of_keys(use, relate.DEPLOYMENT_KEYS)
    side = relate.binned_deployments(use, bins, relate.DEPLOYMENT_KEYS)
    assert side.count() <= 2 * 10_000 + 2
    assert side.groupBy("_bin").count().agg({"count": "max"}).first()[0] <= 3
    found = relate.binned_interval_join(event, use)
    assert found.count() == 20_000
    assert found.where("deployment_id <> floor(event_id / 2)").isEmpty()


def test_bins_grow_with_the_deployments_however_much_they_overlap(frame):
    """Each deployment lasts half of the time that all take, some are open: a row per bin must not be a row per pair."""
    start, many = datetime(2020, 1, 1), 200
    ends = [(start + timedelta(hours=i), start + timedelta(hours=i + many)) for i in range(many)]
    use = [
        (i, 1, 1, 1, None if i % 20 == 3 else str(on), None if i % 20 == 7 else str(off))
        for i, (on, off) in enumerate(ends)
    ]
    deployment = frame(use, DEPLOYMENT)
    bins = relate.bins_of_keys(deployment, relate.DEPLOYMENT_KEYS)
    assert bins.count() == 1
    rows = relate.binned_deployments(deployment, bins, relate.DEPLOYMENT_KEYS)
    assert rows.count() <= 4 * many
    events = [(i, 1, 1, 1, str(start + timedelta(minutes=37 * i))) for i in range(-20, 700, 9)]
    times = [(e[0], e[4]) for e in events]
    expected = sorted(
        (e, d[0]) for e, at in times for d in use if (d[4] is None or at >= d[4]) and (d[5] is None or at < d[5])
    )
    got = relate.binned_interval_join(frame(events, EVENT), deployment).select("event_id", "deployment_id").collect()
    assert sorted(map(tuple, got)) == expected


def test_binned_join_counts_cold_keys_once(frame, monkeypatch):
    """Where bins are not broadcast, keys without hot rows are not counted again by bin; hot ones are."""
    counted = []
    count = joins.hot_keys

    def spy(facts, on, hot_rows):
        counted.append(tuple(on))
        return count(facts, on, hot_rows)

    monkeypatch.setattr(joins, "hot_keys", spy)
    events, deployments = random_case(1)
    e, d = frame(events, EVENT), frame(deployments, DEPLOYMENT)
    for hot_rows, times in ((10**6, 1), (3, 2)):
        counted.clear()
        got = relate.binned_interval_join(e, d, few=0, broadcast_bytes=0, hot_rows=hot_rows)
        assert sorted((r.event_id, r.deployment_id) for r in got.collect()) == brute(events, deployments)
        assert len(counted) == times


def test_sides_of_ten_megabytes_are_not_broadcast(spark):
    assert joins.is_small(spark.range(100_000))
    assert not joins.is_small(spark.range(400_000))


def test_binned_query_joins_times_and_not_each_ship(spark, tmp_path, monkeypatch):
    """1,200 ships and 30 orders of one day: a row for each order leaves the join, and not one for each pair."""
    import __spark_entry__ as entry

    orders = spark.range(30).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "timestamp'1995-03-01' as o_orderdate")
    lines = spark.range(1201).selectExpr(
        "id % 30 as l_orderkey", "id as l_partkey", "id % 3 as l_suppkey", "cast(id as int) as l_linenumber",
        "cast(1 as decimal(15,2)) as l_quantity", "timestamp'1995-03-01' + make_dt_interval(if(id = 1200, 1, 0)) as l_shipdate",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    join, joined = relate.binned_interval_join, []
    monkeypatch.setattr(relate, "binned_interval_join", lambda *a, **b: joined.append(join(*a, **b)) or joined[-1])
    got = entry.queries()["interval_join_binned"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(k, 1200) for k in range(30)]
    assert [j.count() for j in joined] == [30]

"""Tables are read once, whatever is reported of them, and in tasks of bounded size."""

from collections import Counter

import fixtures
from pyspark.sql import functions as F

from tracklake.operators import checks, identify
from tracklake.plans.clean import clean
from tracklake.registry import mapping
from tracklake.schema import ENTITIES
from tracklake.sources import raw


def _stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_unresolved_identifiers_read_the_events_once(frame, tmp_path):
    """The result reads counts only; studies without a number and events repeated by ambiguous names count as before."""
    export = frame([(1, 1), (2, 1), (3, 2), (4, None)], "event_id bigint, study_id bigint")
    rows = [(1, 1, 7, None, None), (1, 1, 8, None, 5), (2, 1, 7, 3, 5), (3, 2, 9, 4, 6), (4, None, None, 4, 6)]
    schema = "event_id bigint, study_id bigint, tag_id bigint, individual_id bigint, sensor_id bigint"
    out = checks.unresolved_identifiers(export, _stored(frame(rows, schema), tmp_path / "resolved"))
    assert {tuple(r) for r in out.collect()} == {
        (None, "identifier_resolved", "tag_id", "1"),
        (1, "identifier_resolved", "individual_id", "2"),
        (1, "identifier_resolved", "sensor_id", "1"),
        (1, "identifier_rows", "event", "2 rows in, 3 out"),
        (0, "identifier_rows", "event", "1 rows in, 0 out"),
        (0, "identifier_rows", "event", "0 rows in, 1 out"),
    }
    assert not any(f"{tmp_path}/resolved" in name for name in out.inputFiles())


def test_identifier_violations_read_the_events_once(frame, tmp_path):
    rows = [(1, 2, 0), (1, 0, 0), (1, 1, 1), (2, 1, 2), (2, 1, 0), (3, 1, 1), (None, 3, 0)]
    resolved = _stored(frame(rows, "study_id bigint, candidates bigint, sensors bigint"), tmp_path / "resolved")
    out = identify.identifier_violations(resolved)
    assert {(r.study_id, r.check, r.detail) for r in out.collect()} == {
        (1, "identifier_ambiguous", "1"),
        (None, "identifier_ambiguous", "1"),
        (1, "identifier_unknown", "1"),
        (2, "identifier_sensor", "2"),
    }
    assert not any(f"{tmp_path}/resolved" in name for name in out.inputFiles())


def test_checks_of_cleaning_read_each_raw_table_once(spark, tmp_path, monkeypatch):
    """Reduced tables are written before the checks, and studies with events are told from the annotated ones."""
    root, seen = fixtures.write(tmp_path / "csv", fixtures.three_studies()), {}
    checked = checks.entities_without_records
    monkeypatch.setattr(checks, "entities_without_records", lambda studies, of: seen.update(of) or checked(studies, of))
    cleaned = clean({e: raw.read_raw(spark, root, e) for e in ENTITIES})
    assert {e: df.count() for e, df in cleaned.tables.items()} == {
        "study": 2, "individual": 4, "tag": 4, "sensor": 4, "deployment": 4, "event": 6,
    }
    for df in [*[cleaned.tables[e] for e in ("individual", "tag", "sensor", "deployment")], seen["event"]]:
        assert not any(f"{tmp_path}/csv" in name for name in df.inputFiles())


def test_a_study_without_raw_events_is_named(spark, tmp_path):
    """Rejected events are records; only a study that never had one is named."""
    root = fixtures.write(tmp_path / "csv", fixtures.three_studies())
    tables = {e: raw.read_raw(spark, root, e) for e in ENTITIES}
    tables["event"] = tables["event"].where("study_id <> 2000").withColumn("visible", F.expr("visible and study_id <> 1000"))
    found = {(r.study_id, r.key) for r in clean(tables).violations.where("check = 'has_records'").collect()}
    assert found == {(2000, "event")}


def test_customers_are_spread_before_they_become_several_rows(spark, tmp_path, monkeypatch):
    """One file of one piece is one task no more; null and repeated keys keep their rows."""
    keys = [None, 5, 5, *range(40)]
    rows = [(k, f"C{k}", (k or 0) % 3, 1.0, "x") for k in keys]
    customers = spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    expected = Counter(map(tuple, mapping.Testbed(spark, str(tmp_path)).deployment.collect()))
    monkeypatch.setattr(mapping, "PEOPLE_OF_TASK", 10)
    t = mapping.Testbed(spark, str(tmp_path))
    assert Counter(map(tuple, t.deployment.collect())) == expected
    for df in (t.tag, t.sensor, t.deployment):
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 2

import fixtures
import pytest

from tracklake import schema
from tracklake.sources import files, lookup, raw


@pytest.fixture
def root(tmp_path):
    return fixtures.write(tmp_path / "csv", fixtures.three_studies())


def test_entities_of_all_studies(spark, root):
    people = raw.read_raw(spark, root, "individual")
    assert people.count() == 12
    rows = {r.individual_id: r for r in people.collect()}
    assert rows[1001].comments == " blank at the start"
    assert rows[1001].nick_name is None and rows[1002].taxon_canonical_name is None
    assert {r.study_id for r in rows.values()} == {1000, 2000, 3000}
    assert people.schema["individual_id"].dataType.simpleString() == "bigint"


def test_study_comes_from_the_path(spark, root):
    tags = raw.read_raw(spark, root, "tag").where("study_id = 2000")
    assert {r.tag_id for r in tags.collect()} == {2011, 2012, 2013, 2014}
    first = tags.where("tag_id = 2011").first()
    assert (first.local_identifier, first.serial_no, first.weight) == ("007", "0012", 1.5)


def test_only_some_studies(spark, root):
    assert raw.read_raw(spark, root, "sensor", studies=[3000]).count() == 5


def test_study_file(spark, root):
    row = raw.read_raw(spark, root, "study").where("study_id = 1000").first()
    assert row.study_name == 'Storks, "white" ones'
    assert row.citation == "two\nlines"
    assert (row.has_quota, row.i_am_owner, row.number_of_individuals) == (True, False, 2)


def test_times_in_both_forms(spark, root):
    row = raw.read_raw(spark, root, "deployment").where("deployment_id = 1031").first()
    assert str(row.deploy_on_timestamp) == "2020-01-01 00:00:00"
    assert str(row.deploy_off_timestamp) == "2020-02-01 00:00:00"


def test_events_and_their_time_text(spark, root):
    events = raw.read_raw(spark, root, "event", time_as_text=True)
    assert events.count() == 27
    row = events.where("event_id = 100009").first()
    assert row.ts_str == "2020-03-01T14:00:00.500Z" and row.timestamp.microsecond == 500000
    assert events.where("event_id = 100008").first().individual_id is None
    assert len(schema.raw_schema("event")) == 24


def test_crlf_files(spark, tmp_path):
    root = fixtures.write(tmp_path / "crlf", {1000: fixtures.three_studies()[1000]}, newline="\r\n")
    events = raw.read_raw(spark, root, "event")
    assert events.where("eobs_status = 'A'").count() == 1
    assert raw.read_raw(spark, root, "tag").where("comments is not null").count() == 0


def test_reordered_columns_are_an_error_unless_read_by_header(spark, tmp_path):
    folder = tmp_path / "odd" / "5" / "raw"
    folder.mkdir(parents=True)
    (folder / "sensor.csv").write_text("tag_id,id,sensor_type_id\n7,1,653\n")
    root = str(tmp_path / "odd")
    with pytest.raises(Exception, match="header"):
        raw.read_raw(spark, root, "sensor").collect()
    row = raw.read_raw_by_header(spark, root, "sensor", [5]).first()
    assert (row.sensor_id, row.sensor_type_id, row.tag_id, row.study_id) == (1, 653, 7, 5)


def test_bad_cells_are_missing(spark, tmp_path):
    folder = tmp_path / "bad" / "5" / "raw"
    folder.mkdir(parents=True)
    (folder / "sensor.csv").write_text("id,sensor_type_id,tag_id\n1,gps,1e+05\n12.0,653,NA\n")
    rows = raw.read_raw(spark, str(tmp_path / "bad"), "sensor").orderBy("sensor_id").collect()
    assert [tuple(r)[:3] for r in rows] == [(1, None, 100000), (12, 653, None)]


def test_dictionary_with_byte_order_mark_and_crlf(tmp_path):
    path = tmp_path / "fields.csv"
    path.write_bytes("﻿".encode() + schema.FIELD_DICTIONARY.replace("\n", "\r\n").encode())
    assert schema.read_dictionary(str(path)) == schema.FIELDS


def test_table_schemas(spark):
    assert schema.table_schema("event").names[:5] == ["event_id", "individual_id", "lon", "lat", "timestamp"]
    assert len(schema.table_schema("event")) == 17
    assert [len(schema.table_schema(e)) for e in ("study", "individual")] == [26, 18]
    for entity in schema.ENTITIES:
        empty = schema.empty_table(spark, entity)
        assert empty.schema == schema.table_schema(entity) and empty.count() == 0
    assert len(schema.empty_event_stats(spark).columns) == 9
    assert schema.sensor_types(spark).where("name = 'GPS'").first().id == 653


def test_inferred_table(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,NA,3\n")
    table = raw.infer_table(spark, str(path))
    assert table.count() == 0
    assert [f.dataType.simpleString() for f in table.schema] == ["int", "string", "double"]


def test_control_file(spark, tmp_path):
    path = tmp_path / "study.csv"
    path.write_text('study_id,study_name,run\r\n1000,"Storks, white",1\r\n2000,Cranes,0\r\n3000,Owls,1\r\n', newline="")
    assert {r.study_id for r in lookup.read_control(spark, str(path)).collect()} == {1000, 3000}


def test_sensor_type_file(spark, tmp_path):
    path = tmp_path / "types.csv"
    path.write_text("external_id,id,is_location_sensor,name\r\ngps,653,TRUE,GPS\r\nacceleration,2365683,FALSE,Acceleration\r\n", newline="")
    rows = {r.id: r.is_location_sensor for r in lookup.read_sensor_types(spark, str(path)).collect()}
    assert rows == {653: True, 2365683: False}


def test_old_headers_of_the_web_export(spark, tmp_path):
    path = tmp_path / "ui.csv"
    path.write_text(
        "event-id,visible,timestamp,location-long,location-lat,ground-speed,manually-marked-outlier,"
        "sensor-type,individual-local-identifier,tag-local-identifier\n"
        "1,true,2020-01-01 00:00:00.500,1.5,2.5,0.1,,gps,bird,T1\n"
    )
    row = raw.read_ui_events(spark, str(path)).first()
    assert (row.event_id, row.lon, row.lat, row.visible) == (1, 1.5, 2.5, True)
    assert row.manually_marked_outlier is None and row.tag_local_identifier == "T1"


def test_first_lines_and_places(spark, root, tmp_path):
    listed = files.list_raw(spark, root)
    assert listed.count() == 18
    paths = [r.path for r in listed.collect()]
    lines = files.first_lines(spark, paths)
    assert files.first_lines(spark, paths[:1], paths[1:3]) == {p: lines[p] for p in paths[:3]}
    assert len(lines) == 18 and all(fixtures.HEADERS[p.split("/")[-1][:-4]] == line for p, line in lines.items())
    assert files.places("﻿tag_id, id,colour,sensor_type_id", "sensor") == (("tag_id", "id", "", "sensor_type_id"), [], None)
    assert files.places("tag_id,sensor_type_id", "sensor")[1:] == (["id"], "header")
    assert files.places("id,id,tag_id,sensor_type_id", "sensor")[2] == "header"
    assert files.places("", "sensor")[2] == files.places(None, "sensor")[2] == "empty"
    assert files.list_raw(spark, str(tmp_path / "nothing")).isEmpty()


def test_files_with_other_headers_are_read_by_few_scans(spark, tmp_path):
    """Sixty studies, three orders of columns, one of them with a column that is not known."""
    heads = ("id,sensor_type_id,tag_id", "tag_id,id,sensor_type_id", "sensor_type_id,note,tag_id,id")
    lines = ("1,653,7", "7,1,653", "653,x,7,1")
    for study in range(1, 61):
        folder = tmp_path / "many" / str(study) / "raw"
        folder.mkdir(parents=True)
        (folder / "sensor.csv").write_text(f"{heads[study % 3]}\n{lines[study % 3]}\n")
    found = files.read_files(spark, files.list_raw(spark, str(tmp_path / "many")))
    sensor = found.tables["sensor"]
    assert sensor._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    rows = files.without_marks(sensor).collect()
    assert {r.study_id for r in rows} == set(range(1, 61)) and found.problems.where("entity = 'sensor'").isEmpty()
    assert {(r.sensor_id, r.sensor_type_id, r.tag_id) for r in rows} == {(1, 653, 7)}


def test_lost_values_and_broken_lines(spark, tmp_path):
    for study, text in ((5, "id,sensor_type_id,tag_id\n1,gps,NA\n2,653,x\n3,653\n4,653,9,9\n5,653,8\n"), (6, "\n"), (7, "id,tag_id\n1,2\n")):
        folder = tmp_path / "bad" / str(study) / "raw"
        folder.mkdir(parents=True)
        (folder / "sensor.csv").write_text(text)
    found = files.read_files(spark, files.list_raw(spark, str(tmp_path / "bad")))
    sensor = found.tables["sensor"]
    lost = {(r.study_id, r.kind, r.column, r.num) for r in files.lost_in(sensor, "sensor").collect()}
    assert lost == {(5, "line", None, 2), (5, "value", "sensor_type_id", 1), (5, "value", "tag_id", 1)}
    assert sorted(r.line for r in files.lines_in(sensor, "sensor").collect()) == ["3,653", "4,653,9,9"]
    assert sorted(r.sensor_id for r in files.without_marks(sensor).collect()) == [1, 1, 2, 5]
    assert {(r.study_id, r.kind, r.column) for r in found.problems.where("entity = 'sensor'").collect()} == {
        (6, "empty", "id,sensor_type_id,tag_id"), (7, "column", "sensor_type_id"),
    }
    assert found.problems.where("kind = 'missing' and study_id = 7").count() == 5

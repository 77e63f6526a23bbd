"""Loads that go on from the status log, and runs that clean changed studies alone."""

import os

import fixtures
import pytest

from tracklake.plans import load
from tracklake.plans.load import next_steps, resume, run
from tracklake.sources import files, lookup, tables


@pytest.fixture
def places(tmp_path):
    root = fixtures.write(tmp_path / "csv", fixtures.three_studies())
    return root, *(str(tmp_path / n) for n in ("clean", "db", "status"))


def lines(df):
    return {tuple(r) for r in df.collect()}


def test_first_step_that_is_open(spark):
    studies = spark.createDataFrame([(i,) for i in range(1, 8)], "study_id long")
    rows = [
        (2, "clean", "success", 1), (3, "clean", "fail", 1), (4, "clean", "success", 1), (4, "import", "success", 2),
        (5, "clean", "success", 1), (5, "import", "success", 2), (5, "validate", "success", 3),
        (6, "clean", "success", 9), (6, "import", "success", 2), (6, "validate", "success", 3),
        (7, "clean", "success", 1), (7, "import", "fail", 2),
    ]
    state = spark.createDataFrame(rows, "study_id long, step string, result string, at int")
    assert dict(lines(next_steps(studies, state))) == {1: "c", 2: "i", 3: "c", 4: "v", 5: None, 6: "i", 7: "i"}
    assert dict(lines(next_steps(studies, state.limit(0), "iv"))) == dict.fromkeys(range(1, 8), "i")


def test_latest_line_counts(spark, tmp_path):
    path = str(tmp_path / "status")
    for at, result in ((1_000, "success"), (2_000, "fail")):
        before = set(os.listdir(path)) if os.path.isdir(path) else set()
        lookup.append_status(spark.createDataFrame([(1, "clean", result)], "study_id long, step string, result string"), path)
        for name in set(os.listdir(path)) - before:
            os.utime(os.path.join(path, name), (at, at))
    assert [(r.study_id, r.step, r.result) for r in lookup.job_state(spark, path).collect()] == [(1, "clean", "fail")]


def test_a_stopped_run_goes_on(spark, places, monkeypatch):
    """The run breaks in the import; its clean lines are in the log, and no study that passed is cleaned again."""
    root, clean_root, db, log = places

    def broken(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(load, "import_clean", broken)
        with pytest.raises(RuntimeError):
            run(spark, root, clean_root, db, "civ", status_path=log)
    assert lines(lookup.read_status(spark, log)) == {(1000, "clean", "success"), (2000, "clean", "success"), (3000, "clean", "fail")}
    done = lines(resume(spark, root, clean_root, db, log))
    assert done == {(3000, "clean", "fail"), *((s, step, "success") for s in (1000, 2000) for step in ("import", "validate"))}
    # Only the failed study is left to do.
    assert lines(resume(spark, root, clean_root, db, log)) == {(3000, "clean", "fail")}


def test_rows_that_show_are_not_imported_again(spark, places):
    """The import was stopped between its commit and its line in the log."""
    root, clean_root, db, log = places
    control = spark.createDataFrame([(1000,), (2000,)], "study_id long")
    run(spark, root, clean_root, db, "c", control, log)
    run(spark, root, clean_root, db, "i", control.where("study_id = 1000"))
    done = lines(resume(spark, root, clean_root, db, log, control=control))
    assert done == {(s, step, "success") for s in (1000, 2000) for step in ("import", "validate")}
    assert tables.read_table(spark, db, "event").count() == 6


def test_changed_files_alone_are_read(spark, places, tmp_path, monkeypatch):
    root, clean_root, db, _ = places
    kept = str(tmp_path / "manifest")
    first = lines(run(spark, root, clean_root, db, "c", manifest_path=kept))
    assert first == {(1000, "clean", "success"), (2000, "clean", "success"), (3000, "clean", "fail")}
    opened = []
    real = files.first_lines
    monkeypatch.setattr(files, "first_lines", lambda spark, small, large=(): opened.extend([*small, *large]) or real(spark, small, large))
    assert lines(run(spark, root, clean_root, db, "c", manifest_path=kept)) == set() and not opened
    sensor = tmp_path / "csv" / "3000" / "raw" / "sensor.csv"
    sensor.write_text("\n".join(x for x in sensor.read_text().split("\n") if not x.startswith("3029")))
    assert lines(run(spark, root, clean_root, db, "c", manifest_path=kept)) == {(3000, "clean", "success")}
    assert len(opened) == 6 and all("/3000/" in path for path in opened)
    # A file that is gone is a change too; a study that is gone altogether is not one to clean.
    (tmp_path / "csv" / "1000" / "raw" / "tag.csv").rename(tmp_path / "tag.csv")
    (tmp_path / "csv" / "2000").rename(tmp_path / "2000")
    assert lines(run(spark, root, clean_root, db, "c", manifest_path=kept)) == {(1000, "clean", "fail")}
    assert {r.study_id for r in files.read_manifest(spark, kept).collect()} == {1000, 2000, 3000}

"""Loading: clean, import and validate all marked studies; one that fails stops no other."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.operators import checks
from tracklake.operators.reports import entity_counts
from tracklake.operators.shape import conform
from tracklake.plans.clean import clean, of_studies
from tracklake.schema import ENTITIES, STATUS_SCHEMA, empty_table, table_schema
from tracklake.session import stage
from tracklake.sources import files, lookup, tables
from tracklake.sources.raw import balanced_by_study, read_clean_csv, write_csv

STEPS = {"c": "clean", "i": "import", "v": "validate"}


@dataclass
class Imported:
    load_id: str
    rows: DataFrame
    violations: DataFrame
    passed: DataFrame
    committed: bool


def write_clean(cleaned: dict[str, DataFrame], root: str, file_format: str = "parquet") -> None:
    """Clean tables, one folder per study; studies in the frames are replaced."""
    for entity in ENTITIES:
        df = conform(cleaned[entity], entity)
        order = tables.SORT_WITHIN.get(entity, ())
        if file_format == "csv":
            write_csv(df, root, entity, order)
            continue
        (
            balanced_by_study(df, order)
            .write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy("study_id")
            .parquet(f"{root}/{entity}")
        )


def read_clean(spark: SparkSession, root: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    if file_format == "csv":
        # Where no study has passed there is no file to read.
        there = {e: files.any_file(spark, f"{root}/{e}/study_id=*") for e in ENTITIES}
        return {e: read_clean_csv(spark, root, e) if there[e] else empty_table(spark, e) for e in ENTITIES}
    return {e: spark.read.schema(table_schema(e)).parquet(f"{root}/{e}") for e in ENTITIES}


def import_clean(
    spark: SparkSession, clean_tables: dict[str, DataFrame], root: str, dry_run: bool = False
) -> Imported:
    """Append clean tables, parents first. Each study comes in whole or not at all.

    References and keys are checked against the new rows and the tables before anything shows. Where
    studies are refused, the references that they alone could serve break too, until nothing more does.
    A dry run writes nothing to the tables and returns the counts.
    """
    if not dry_run:
        tables.create_tables(spark, root)
    new = {e: conform(clean_tables[e], e) for e in ENTITIES}
    there = tables.exists(spark, f"{root}/commits")
    existing = tables.read_tables(spark, root) if there else {e: empty_table(spark, e) for e in ENTITIES}
    index = tables.id_index(spark, root) if there else None
    used = stage(checks.used_references(new), "references")
    found = checks.broken_references(new, existing, used).unionByName(checks.taken_keys(new, existing, index))
    violations = stage(found, "import-violations")
    newly = refused = stage(checks.failed_studies(violations), "refused")
    if not refused.isEmpty():
        borrowed = stage(checks.borrowed_references(new, existing, used), "borrowed")
    while not newly.isEmpty():
        # Who borrows from a study that has just been refused goes too; no table is read again for it.
        found = stage(checks.broken_by_refusal(borrowed, refused, newly), "more-violations")
        violations = violations.unionByName(found)
        newly = stage(checks.failed_studies(found).join(refused, "study_id", "left_anti"), "refused")
        refused = refused.unionByName(newly)
    studies = new["study"].select("study_id").distinct()
    passed = stage(studies.join(refused, "study_id", "left_anti"), "passed")
    good = of_studies(new, passed)
    load_id = tables.new_load_id()
    counts = []
    for entity in ENTITIES:
        if dry_run:
            counted = good[entity].groupBy("study_id").agg(F.count("*").alias("num"))
        else:
            counted = tables.append_rows(good[entity], root, entity, load_id)
        counts.append(counted.select("study_id", F.lit(entity).alias("entity"), "num"))
    rows = stage(checks.all_of(*counts), "import-rows")
    if not dry_run:
        tables.append_states(spark, root, load_id)
        parts = rows.select(F.lit(load_id).alias("load_id"), "study_id", "entity", F.lit("live").alias("state"))
        tables.commit(parts, root)
    return Imported(load_id, rows, violations, passed, not dry_run)


def clean_counts(clean_tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.groupBy("study_id").agg(F.count("*").alias("num")).select(
            "study_id", F.lit(entity).alias("entity"), "num"
        )
        for entity, df in clean_tables.items()
    ]
    return checks.all_of(*counts)


def validate_import(clean_tables: dict[str, DataFrame], db: dict[str, DataFrame]) -> DataFrame:
    """Rows in the clean files and in the tables, per study and table."""
    studies = clean_tables["study"].select("study_id").distinct()
    return checks.compare_counts(clean_counts(clean_tables), entity_counts(of_studies(db, studies)))


def status_of(studies: DataFrame, passed: DataFrame, step: str) -> DataFrame:
    good = passed.select("study_id", F.lit(True).alias("_good"))
    return studies.join(good, "study_id", "left").select(
        "study_id",
        F.lit(step).alias("step"),
        F.when(F.col("_good"), "success").otherwise("fail").alias("result"),
    )


def run(
    spark: SparkSession,
    raw: dict[str, DataFrame] | str | None,
    clean_root: str,
    table_root: str,
    steps: str = "civ",
    control: DataFrame | None = None,
    status_path: str | None = None,
    file_format: str = "parquet",
    dry_run: bool = False,
    layout: str = "folders",
    manifest_path: str | None = None,
    **options,
) -> DataFrame:
    """The chosen steps for the marked studies. Returns (study_id, step, result).

    `raw` is the folder of the raw files, or the raw tables. Steps are letters: c clean,
    i import, v validate. A study that fails a step takes no part in the next ones. Files are
    found by a listing and read by their headers; an unreadable one fails its study alone.
    The status log gets the lines of a step when the step ends. With a manifest, a listing of the files that were cleaned
    last, only studies with other files than then take part; keep one manifest per choice of options.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    log, seen = [], None

    def note(studies: DataFrame, passed: DataFrame, step: str) -> None:
        lines = stage(status_of(studies, passed, STEPS[step]), "status")
        if status_path:
            lookup.append_status(lines, status_path)
        log.append(lines)

    if isinstance(raw, str) and "c" in steps:
        listed = files.list_raw(spark, raw, layout)
        if control is not None:
            # Only the marked studies' files are opened.
            marked = listed.join(control.select("study_id"), "study_id", "left_semi")
            listed = marked.unionByName(listed.where("study_id is null"))
        if manifest_path:
            listed = stage(listed, "listed")
            changed = stage(files.changed_studies(listed, files.read_manifest(spark, manifest_path)), "changed")
            if changed.isEmpty():
                return spark.createDataFrame([], STATUS_SCHEMA)
            seen = listed.join(changed, "study_id", "left_semi")
            listed, control = seen.unionByName(listed.where("study_id is null")), changed
        read = files.read_files(spark, listed, layout)
        raw, options["problems"] = read.tables, read.problems
        control = read.studies if control is None else control
    known = isinstance(raw, dict)
    going = control if control is not None else (raw["study"] if known else None)
    going = going.select("study_id").distinct() if going is not None else None
    if "c" in steps:
        cleaned = clean(of_studies(raw, going), **options)
        write_clean(cleaned.tables, clean_root, file_format)
        note(going, cleaned.passed, "c")
        if seen is not None:
            files.append_manifest(seen, manifest_path)
        going = cleaned.passed
    if "i" in steps or "v" in steps:
        clean_tables = read_clean(spark, clean_root, file_format)
        if going is None:
            going = clean_tables["study"].select("study_id").distinct()
        clean_tables = of_studies(clean_tables, going)
    if "i" in steps:
        imported = import_clean(spark, clean_tables, table_root, dry_run)
        note(going, imported.passed, "i")
        going = imported.passed
        clean_tables = of_studies(clean_tables, going)
    if "v" in steps and not dry_run:
        note(going, agreeing(clean_tables, tables.read_tables(spark, table_root)), "v")
    return checks.all_of(*log) if log else spark.createDataFrame([], STATUS_SCHEMA)


def agreeing(clean_tables: dict[str, DataFrame], db: dict[str, DataFrame]) -> DataFrame:
    """Studies with as many rows in every table as in their clean files."""
    compared = validate_import(clean_tables, db)
    return compared.groupBy("study_id").agg(F.every("equal").alias("all_equal")).where("all_equal").select("study_id")


def next_steps(studies: DataFrame, state: DataFrame, steps: str = "civ") -> DataFrame:
    """(study_id, next): the first step that a study has not passed since it passed the step before; none if it is through."""
    passed = [
        F.max(F.when((F.col("step") == STEPS[s]) & (F.col("result") == "success"), F.col("at"))).alias(s) for s in steps
    ]
    wide = studies.select("study_id").distinct().join(state.groupBy("study_id").agg(*passed), "study_id", "left")
    done = [F.coalesce(F.col(s) >= F.col(before), F.lit(False)) for before, s in zip(steps[:1] + steps, steps)]
    open_steps = [F.when(~passed_it, F.lit(s)) for passed_it, s in zip(done, steps)]
    return wide.select("study_id", F.coalesce(*open_steps).alias("next"))


def resume(
    spark: SparkSession,
    raw: dict[str, DataFrame] | str,
    clean_root: str,
    table_root: str,
    status_path: str,
    steps: str = "civ",
    control: DataFrame | None = None,
    layout: str = "folders",
    file_format: str = "parquet",
    **options,
) -> DataFrame:
    """Go on where the status log ends: each study takes up the first step that it has not passed.

    A study that failed a step tries it again. A step passed before the one in front of it was passed anew is due
    again. Returns the new lines (study_id, step, result). Rows that a stopped import has shown are not imported
    again: such a study passes the import if its tables hold as many rows as its clean files, and fails it otherwise.
    """
    if control is None:
        control = files.list_raw(spark, raw, layout).where("study_id is not null") if isinstance(raw, str) else raw["study"]
    there = files.any_file(spark, f"{status_path}/*.csv")
    state = lookup.job_state(spark, status_path) if there else spark.createDataFrame([], f"{STATUS_SCHEMA}, at timestamp")
    todo = stage(next_steps(control, state, steps), "todo")
    more = {"status_path": status_path, "file_format": file_format, "layout": layout}
    log, going = [], None
    for s in steps:
        due = todo.where(F.col("next") == s).select("study_id")
        due = due if going is None else due.unionByName(going)
        shown = None
        if s == "i" and tables.exists(spark, f"{table_root}/commits"):
            live = tables.live_parts(spark, table_root).select("study_id")
            shown = stage(due.join(live, "study_id", "left_semi"), "shown")
            due = due.join(live, "study_id", "left_anti")
        due, lines = stage(due, "due"), []
        if not due.isEmpty():
            lines.append(run(spark, raw, clean_root, table_root, s, due, **more, **(options if s == "c" else {})))
        if shown is not None and not shown.isEmpty():
            ready = of_studies(read_clean(spark, clean_root, file_format), shown)
            kept = status_of(shown, agreeing(ready, tables.read_tables(spark, table_root)), STEPS[s])
            lines.append(stage(kept, "status"))
            lookup.append_status(lines[-1], status_path)
        log += lines
        passed = [x.where("result = 'success'").select("study_id") for x in lines]
        going = checks.all_of(*passed) if passed else None
    return checks.all_of(*log) if log else spark.createDataFrame([], STATUS_SCHEMA)

"""Cleaning of all studies together."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators import checks
from tracklake.operators.dedupe import KEYS, dedupe_stored, duplicate_groups
from tracklake.operators.filters import (
    EXCLUDED_SPECIES,
    event_rules,
    first_failing_rule,
    keep_allowed_species,
)
from tracklake.operators.joins import is_small, join_facts
from tracklake.operators.relate import (
    DEPLOYMENT_COLUMNS,
    DEPLOYMENT_KEYS,
    in_deployment,
    reduce_entities,
)
from tracklake.operators.reports import compare_totals, computed_totals
from tracklake.operators.shape import final_event_columns, merge_vendor_columns
from tracklake.session import stage
from tracklake.sources import files

UNDEPLOYED = "undeployed"
DUPLICATE = "duplicate"
MALFORMED = "malformed"


@dataclass
class Cleaned:
    """Clean tables of the studies that pass, and what became of the rest."""

    tables: dict[str, DataFrame]
    rejects: DataFrame
    violations: DataFrame
    failed: DataFrame
    passed: DataFrame
    # What was lost in reading (see sources.files), and reported against computed totals.
    problems: DataFrame | None = None
    totals: DataFrame | None = None


def annotate_events(events: DataFrame, deployment: DataFrame, rules: dict, **limits) -> DataFrame:
    """Every raw event with its deployment and the reason it is rejected, if it is."""
    reject = first_failing_rule(events, rules)
    if "_line" in events.columns:
        # An event in two deployments is two rows later, but what was lost in it counts once.
        events = events.withColumn("_row", F.monotonically_increasing_id())
        reject = F.coalesce(F.when(F.col("_line").isNotNull(), F.lit(MALFORMED)), reject)
    marked = events.withColumn("reject", reject)
    side = deployment.select(*DEPLOYMENT_KEYS, *DEPLOYMENT_COLUMNS)
    match = in_deployment() & F.col("reject").isNull()
    located = join_facts(marked, side, list(DEPLOYMENT_KEYS), "left", match, **limits)
    undeployed = F.when(F.col("deployment_id").isNull(), F.lit(UNDEPLOYED))
    return located.withColumn("reject", F.coalesce("reject", undeployed))


def clean(
    raw: dict[str, DataFrame],
    as_of=None,
    species_pattern: str = EXCLUDED_SPECIES,
    keep_missing_species: bool = True,
    check_range: bool = True,
    unit: str | None = "second",
    ties: str = "first",
    verify: bool = False,
    tolerance: str | None = None,
    outliers: bool = False,
    problems: DataFrame | None = None,
    found: list[DataFrame] | tuple = (),
) -> Cleaned:
    """Filter, reduce, locate in deployments, de-duplicate, check, and leave out bad studies.

    `raw` holds the six tables under clean names with a study_id in each. The annotated events
    and the clean events are written to the shared folder once; all checks and counts read the
    columns they need from there. `verify` counts the groups of the clean events once more, which the
    totals of de-duplication have told already. `tolerance` and `outliers` are those of the event rules.

    Rows may carry the marks of sources.files; `problems` are those of the files. A study with an unreadable
    file fails, lost values are counted, and lines with another number of cells are rejected. Violations `found` before
    count with the others.
    """
    counted = [c for c in raw["event"].columns if c not in ("study_id", *files.MARKS)]
    marked = [e for e, df in raw.items() if set(files.MARKS) <= set(df.columns)]
    lost = [files.lost_in(raw[e], e) for e in marked if e != "event"]
    raw = {e: files.without_marks(df) if e in marked and e != "event" else df for e, df in raw.items()}
    individual = keep_allowed_species(raw["individual"], species_pattern, keep_missing_species)
    # The reduced tables are read by several checks each, so their joins and the parsing before them run once.
    kept = reduce_entities(individual, raw["tag"], raw["sensor"], raw["deployment"], keep=stage)
    deployment = kept["deployment"]

    rules = event_rules(as_of, check_range, tolerance, outliers)
    annotated = stage(annotate_events(raw["event"], deployment, rules), "annotated")
    deployed = annotated.where(F.col("reject").isNull()).drop("reject", "_row", *files.MARKS)
    if "event" in marked:
        few = annotated.where("_line is not null or _lost <> 0").dropDuplicates(["_row"])
        lost.append(files.lost_in(few, "event"))
    if problems is not None or lost:
        problems = stage(checks.all_of(*([problems] if problems is not None else []), *lost), "problems")
    profile = stage(checks.profile(deployed), "profile")
    groups = stage(duplicate_groups(deployed, KEYS, unit), "groups")
    unique = dedupe_stored(deployed, groups, KEYS, unit, counted=counted, ties=ties)
    event = stage(final_event_columns(merge_vendor_columns(unique)), "event")

    studies = raw["study"].select("study_id").distinct()
    rows_in = profile.groupBy("study_id").agg(F.sum("num").alias("num"))
    rows_out = event.groupBy("study_id").agg(F.count("*").alias("num"))
    found = [
        *found,
        # All raw events stand among the annotated ones.
        checks.entities_without_records(studies, {**raw, "event": annotated}),
        checks.tags_without_deployment(kept["tag"], deployment),
        checks.repeated_deployments(deployment),
        checks.shared_deployment_ends(deployment),
        *[checks.repeated_keys(kept[e], e) for e in ("individual", "deployment", "tag", "sensor")],
        checks.events_outside_deployment(profile),
        checks.events_without_individual(profile),
        checks.events_without_tag(profile, kept["tag"]),
        checks.events_without_single_sensor(profile, kept["sensor"]),
        checks.events_without_deployed_tag(profile, deployment),
        checks.studies_without_events(studies, profile),
        checks.dedupe_totals(rows_in, groups, rows_out),
    ]
    if problems is not None:
        found.append(checks.unreadable_files(problems, files.FATAL))
    if verify:
        found.append(checks.remaining_duplicates(event, KEYS, unit))
    violations = stage(checks.all_of(*found), "violations")
    failed = checks.failed_studies(violations)
    passed = stage(studies.join(failed, "study_id", "left_anti"), "passed")

    tables = {"study": raw["study"], **kept, "event": event}
    rejects = reject_counts(annotated, event)
    totals = compare_totals(raw["study"], computed_totals(kept["individual"], deployment, event))
    return Cleaned(of_studies(tables, passed), rejects, violations, failed, passed, problems, totals)


def reject_counts(annotated: DataFrame, event: DataFrame) -> DataFrame:
    """Rejected events per study and reason, duplicates included."""
    reasons = annotated.groupBy("study_id", "reject").agg(F.count("*").alias("num"))
    rejected = reasons.where(F.col("reject").isNotNull()).select(
        "study_id", F.col("reject").alias("reason"), "num"
    )
    deployed = reasons.where(F.col("reject").isNull()).select("study_id", "num")
    kept = event.groupBy("study_id").agg(F.count("*").alias("_kept"))
    duplicates = deployed.join(kept, "study_id", "left").select(
        "study_id",
        F.lit(DUPLICATE).alias("reason"),
        (F.col("num") - F.coalesce("_kept", F.lit(0))).alias("num"),
    )
    return rejected.unionByName(duplicates.where("num > 0"))


def of_studies(frames: dict[str, DataFrame], studies: DataFrame) -> dict[str, DataFrame]:
    """The tables of some studies."""
    small = is_small(studies)
    return {
        name: join_facts(df, studies, ["study_id"], "left_semi", small=small)
        for name, df in frames.items()
    }

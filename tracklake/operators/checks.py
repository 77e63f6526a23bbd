"""Data quality checks.

Each check returns violation rows (study_id, check, key, detail); an empty frame means that the
check passes. A study with a violation is left out of the load, the others go on.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.values import ENDS_BLANK, HAS_LINE_BREAK, STARTS_BLANK
from tracklake.operators.dedupe import KEYS, TIME_UNIT, duplicate_groups
from tracklake.operators.relate import in_deployment
from tracklake.operators.repair import text_columns
from tracklake.schema import FOREIGN_KEYS, PRIMARY_KEY
from tracklake.session import stage

VIOLATION_SCHEMA = "study_id bigint, check string, key string, detail string"


def violation(df: DataFrame, check: str | Column, key: Column, detail: str | Column) -> DataFrame:
    check = F.lit(check) if isinstance(check, str) else check
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(
        F.col("study_id").cast("bigint").alias("study_id"),
        check.alias("check"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


def key_of(*names: str) -> Column:
    """Key columns as text, missing ones shown as NA."""
    return F.concat_ws("/", *[F.coalesce(F.col(n).cast("string"), F.lit("NA")) for n in names])


def all_of(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def failed_studies(violations: DataFrame) -> DataFrame:
    return violations.select("study_id").distinct()


def entities_without_records(studies: DataFrame, entities: dict[str, DataFrame]) -> DataFrame:
    """Studies for which a table has no row."""
    found = []
    for name, df in entities.items():
        seen = df.select("study_id").distinct()
        empty = studies.select("study_id").join(seen, "study_id", "left_anti")
        found.append(violation(empty, "has_records", F.lit(name), "no records"))
    return all_of(*found)


def tags_without_deployment(tag: DataFrame, deployment: DataFrame) -> DataFrame:
    on = ["study_id", "tag_id"]
    alone = tag.join(deployment.select(*on), on, "left_anti")
    return violation(alone, "tag_deployed", key_of("tag_id"), "tag without deployment")


def repeated_deployments(deployment: DataFrame) -> DataFrame:
    """The same individual with the same tag more than once."""
    on = ["study_id", "individual_id", "tag_id"]
    groups = deployment.groupBy(*on).agg(F.count("*").alias("num")).where("num > 1")
    return violation(groups, "deployment_unique", key_of("individual_id", "tag_id"), F.col("num"))


def shared_deployment_ends(deployment: DataFrame) -> DataFrame:
    """Tags deployed several times with the same start or the same end.

    A missing end is a value here: two open ends on one tag are the same end. Counting per end
    first keeps both counts small before they meet per tag.
    """
    found = []
    for column in ("deploy_on_timestamp", "deploy_off_timestamp"):
        shared = (
            deployment.groupBy("study_id", "tag_id", column)
            .agg(F.count("*").alias("num"))
            .where("num > 1")
            .groupBy("study_id", "tag_id")
            .agg(F.sum("num").alias("num"))
        )
        found.append(violation(shared, "deployment_ends", key_of("tag_id"), F.lit(column)))
    return all_of(*found)


def repeated_keys(df: DataFrame, entity: str) -> DataFrame:
    """Primary key values that occur more than once in a study."""
    key = PRIMARY_KEY[entity]
    columns = ["study_id"] if key == "study_id" else ["study_id", key]
    groups = df.groupBy(*columns).agg(F.count("*").alias("num")).where("num > 1")
    return violation(groups, "primary_key", F.concat(F.lit(f"{entity}/"), key_of(key)), F.col("num"))


PROFILE_KEYS = ("study_id", "deployment_id", "tag_id", "sensor_type_id")


def profile(events: DataFrame) -> DataFrame:
    """Event counts per study, deployment, tag and sensor type, from one pass.

    All event checks below read this small frame instead of the events. `outside` counts events
    outside their deployment, `ownerless` those without an individual.
    """
    located = {"deploy_on_timestamp", "deploy_off_timestamp", "deployment_id"} <= set(events.columns)
    inside = F.coalesce(in_deployment(), F.lit(False)) if located else F.lit(True)
    if not located:
        events = events.withColumn("deployment_id", F.lit(None).cast("bigint"))
    return events.groupBy(*PROFILE_KEYS).agg(
        F.count("*").alias("num"),
        F.count(F.when(~inside, 1)).alias("outside"),
        F.count(F.when(F.col("individual_id").isNull(), 1)).alias("ownerless"),
    )


def _sum_of(profiled: DataFrame, value: str, *by: str) -> DataFrame:
    sums = profiled.groupBy(*by).agg(F.sum(value).alias("num"))
    return sums.where("num > 0")


def events_without_single_sensor(profiled: DataFrame, sensor: DataFrame) -> DataFrame:
    """Events whose tag has no sensor of their type, or several."""
    on = ["study_id", "tag_id", "sensor_type_id"]
    sensors = sensor.groupBy(*on).agg(F.count("*").alias("sensors"))
    matched = _sum_of(profiled, "num", *on).join(sensors, on, "left")
    matched = matched.withColumn("sensors", F.coalesce("sensors", F.lit(0))).where("sensors <> 1")
    detail = F.format_string("%d events, %d sensors", "num", "sensors")
    return violation(matched, "event_sensor", key_of("tag_id", "sensor_type_id"), detail)


def events_outside_deployment(profiled: DataFrame) -> DataFrame:
    """Counts per deployment of events outside its interval, in joined events."""
    groups = _sum_of(profiled, "outside", "study_id", "deployment_id")
    return violation(groups, "event_in_deployment", key_of("deployment_id"), F.col("num"))


def events_without_individual(profiled: DataFrame) -> DataFrame:
    groups = _sum_of(profiled, "ownerless", "study_id", "tag_id")
    return violation(groups, "event_individual", key_of("tag_id"), F.col("num"))


def events_without(profiled: DataFrame, parent: DataFrame, check: str) -> DataFrame:
    """Events whose tag is not in the parent (deployments, or tags), counted per tag."""
    counts = _sum_of(profiled, "num", "study_id", "tag_id")
    on = ["study_id", "tag_id"]
    lost = counts.join(parent.select(*on), on, "left_anti")
    return violation(lost, check, key_of("tag_id"), F.col("num"))


def events_without_deployed_tag(profiled: DataFrame, deployment: DataFrame) -> DataFrame:
    return events_without(profiled, deployment, "event_tag_deployed")


def events_without_tag(profiled: DataFrame, tag: DataFrame) -> DataFrame:
    return events_without(profiled, tag, "event_tag")


def studies_without_events(studies: DataFrame, events: DataFrame) -> DataFrame:
    """Studies with nothing left; `events` may be the events or their profile."""
    seen = events.select("study_id").distinct()
    empty = studies.select("study_id").join(seen, "study_id", "left_anti")
    return violation(empty, "events_remain", F.lit("event"), "no event remains")


def dedupe_arithmetic(before: DataFrame, after: DataFrame, keys=KEYS, unit="second") -> DataFrame:
    """Rows after de-duplication must be as many as there were groups before."""
    rows_in = before.groupBy("study_id").agg(F.count("*").alias("num"))
    rows_out = after.groupBy("study_id").agg(F.count("*").alias("num"))
    return dedupe_totals(rows_in, duplicate_groups(before, keys, unit), rows_out)


def dedupe_totals(rows_in: DataFrame, groups: DataFrame, rows_out: DataFrame) -> DataFrame:
    """The same from row counts per study and the duplicate groups: each group keeps one row."""
    extra = groups.groupBy("study_id").agg(F.sum(F.col("num") - 1).alias("extra"))
    off = (
        rows_in.withColumnRenamed("num", "rows_in")
        .join(extra, "study_id", "left")
        .join(rows_out.withColumnRenamed("num", "kept"), "study_id", "full")
        .na.fill(0, ["rows_in", "extra", "kept"])
        .withColumn("groups", F.col("rows_in") - F.col("extra"))
        .where("groups <> kept")
    )
    detail = F.format_string("%d groups, %d rows", "groups", "kept")
    return violation(off, "dedupe_arithmetic", F.lit("event"), detail)


def remaining_duplicates(after: DataFrame, keys=KEYS, unit="second") -> DataFrame:
    groups = duplicate_groups(after, keys, unit)
    return violation(groups, "no_duplicates", key_of(*keys[1:], TIME_UNIT), F.col("num"))


def untidy_text(df: DataFrame, entity: str, key: str, columns=None) -> DataFrame:
    """Text with line breaks or blanks at the ends: one row per cell and kind, in one pass."""
    columns = columns or text_columns(df)
    kinds = {"line break": HAS_LINE_BREAK, "leading blank": STARTS_BLANK, "trailing blank": ENDS_BLANK}
    marks = [
        F.when(F.col(c).rlike(pattern), F.struct(F.lit(c).alias("c"), F.lit(kind).alias("kind")))
        for c in columns
        for kind, pattern in kinds.items()
    ]
    cells = df.select(
        "study_id", key, F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("m")
    )
    where = F.concat_ws("/", F.lit(entity), F.col(key).cast("string"), F.col("m.c"))
    return violation(cells, "tidy_text", where, F.col("m.kind"))


def unresolved_identifiers(export: DataFrame, resolved: DataFrame) -> DataFrame:
    """Ids that stayed empty, and a row count changed by ambiguous identifiers. The resolved events are read once."""
    ids = ("tag_id", "individual_id", "sensor_id")
    empty = [F.count(F.when(F.col(name).isNull(), 1)).alias(f"_{name}") for name in ids]
    counts = stage(resolved.groupBy("study_id").agg(F.count("*").alias("rows_out"), *empty), "unresolved")
    lost = [
        violation(counts.where(F.col(f"_{name}") > 0), "identifier_resolved", F.lit(name), F.col(f"_{name}"))
        for name in ids
    ]
    rows_in = export.groupBy("study_id").agg(F.count("*").alias("rows_in"))
    rows_out = counts.select("study_id", "rows_out")
    off = rows_in.join(rows_out, "study_id", "full").na.fill(0).where("rows_in <> rows_out")
    detail = F.format_string("%d rows in, %d out", "rows_in", "rows_out")
    return all_of(*lost, violation(off, "identifier_rows", F.lit("event"), detail))


def used_references(new: dict[str, DataFrame]) -> DataFrame:
    """(study_id, child, column, parent, ref, num): foreign keys of the new rows, counted per key value.

    So a hot key is one row later, and the rows themselves are read once.
    """
    found = []
    for child, column, parent in FOREIGN_KEYS:
        if child not in new:
            continue
        used = new[child].where(F.col(column).isNotNull()).groupBy("study_id", F.col(column).alias("ref"))
        names = [F.lit(x).alias(n) for x, n in ((child, "child"), (column, "column"), (parent, "parent"))]
        found.append(used.agg(F.count("*").alias("num")).select("study_id", *names, "ref", "num"))
    return all_of(*found)


def _keys(entities: dict[str, DataFrame], parents: set[str], *more: str) -> DataFrame:
    keys = [df.select(F.lit(e).alias("parent"), F.col(PRIMARY_KEY[e]).alias("ref"), *more) for e, df in entities.items() if e in parents]
    return all_of(*keys)


def _broken(lost: DataFrame) -> DataFrame:
    where = F.concat("child", F.lit("."), "column", F.lit("/"), F.col("ref").cast("string"))
    return violation(lost, "foreign_key", where, F.col("num"))


def broken_references(
    new: dict[str, DataFrame], existing: dict[str, DataFrame], used: DataFrame | None = None
) -> DataFrame:
    """Foreign keys of the new rows that neither the new nor the existing tables have.

    `used` is the result of used_references where it is at hand.
    """
    used = used_references(new) if used is None else used
    parents = {parent for _, _, parent in FOREIGN_KEYS}
    known = _keys(new, parents)
    if existing:
        known = known.unionByName(_keys(existing, parents))
    return _broken(used.join(known, ["parent", "ref"], "left_anti"))


def borrowed_references(new: dict[str, DataFrame], existing: dict[str, DataFrame], used: DataFrame) -> DataFrame:
    """References that only other studies of the new rows can serve, each with these studies as `lender`."""
    parents = {parent for _, _, parent in FOREIGN_KEYS}
    offers = _keys(new, parents, F.col("study_id").alias("lender")).distinct()
    open_ones = used.join(_keys(existing, parents), ["parent", "ref"], "left_anti") if existing else used
    own = offers.withColumnRenamed("lender", "study_id")
    return open_ones.join(own, ["parent", "ref", "study_id"], "left_anti").join(offers, ["parent", "ref"])


def broken_by_refusal(borrowed: DataFrame, refused: DataFrame, newly: DataFrame) -> DataFrame:
    """References that break as the last lender is refused: only those of newly refused lenders are looked at."""
    key = ["study_id", "child", "column", "parent", "ref"]
    touched = borrowed.join(newly.select(F.col("study_id").alias("lender")), "lender", "left_semi").select(*key).distinct()
    left = borrowed.join(refused.select(F.col("study_id").alias("lender")), "lender", "left_anti").select(*key).distinct()
    lost = touched.join(left, key, "left_anti").join(borrowed.select(*key, "num").distinct(), key)
    return _broken(lost)


def taken_keys(
    new: dict[str, DataFrame], existing: dict[str, DataFrame], index: dict[str, tuple[DataFrame, int]] | None = None
) -> DataFrame:
    """Primary keys of the new rows that are used twice, among them or in the tables.

    Keys are counted across studies: an id in two studies is a violation of both. With an index of the stored ids
    (tables.id_index) only the new ids are moved, to the buckets in which the stored ones lie.
    """
    found = []
    for entity, df in new.items():
        key = PRIMARY_KEY[entity]
        rows = df.select("study_id", F.col(key).alias("_key"), F.lit(1).alias("_new"))
        if index and entity in index:
            stored, buckets = index[entity]
            wanted = df.select(F.col(key).alias("_key")).distinct().repartition(buckets, "_key")
            again = stored.select("study_id", F.col("id").alias("_key"), F.lit(0).alias("_new"))
            rows = rows.unionByName(again.join(wanted, "_key", "left_semi").select("study_id", "_key", "_new"))
        elif entity in existing:
            # New ids are mostly later ones: only row groups that reach into their range are read.
            least, most = df.agg(F.min(key), F.max(key)).first()
            again = (
                existing[entity].where(F.col(key).between(least, most))
                .select("study_id", F.col(key).alias("_key"), F.lit(0).alias("_new"))
                .join(df.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")
            )
            rows = rows.unionByName(again)
        per_study = rows.groupBy("_key", "study_id").agg(
            F.count("*").alias("_rows"), F.max("_new").alias("_new")
        )
        # Per key: how often it is used, and the studies of the new rows that use it.
        total = per_study.groupBy("_key").agg(F.sum("_rows").alias("num")).where("num > 1")
        clash = per_study.where("_new = 1").join(total, "_key")
        where = F.concat(F.lit(f"{entity}/"), F.col("_key").cast("string"))
        found.append(violation(clash, "primary_key_taken", where, F.col("num")))
    return all_of(*found)


def unreadable_files(problems: DataFrame, fatal: tuple[str, ...]) -> DataFrame:
    """Files that could not be read at all; problems are those of sources.files."""
    bad = problems.where(F.col("kind").isin(*fatal) & F.col("study_id").isNotNull())
    return violation(bad, "raw_file", F.concat_ws("/", "entity", "kind"), F.coalesce("file", F.lit("")))


def compare_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows per study and table in the files and in the tables, and whether they agree."""
    left = expected.select("study_id", "entity", F.col("num").alias("file_rows"))
    right = actual.select("study_id", "entity", F.col("num").alias("table_rows"))
    return (
        left.join(right, ["study_id", "entity"], "full")
        .na.fill(0, ["file_rows", "table_rows"])
        .withColumn("equal", F.col("file_rows") == F.col("table_rows"))
    )

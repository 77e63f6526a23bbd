"""Record rules of the cleaning step, query predicates, and the reject report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.times import is_epoch_text
from tracklake.functions.values import contains_ignoring_case, present
from tracklake.schema import GPS_SENSOR_TYPE

# The species never tracked, the status of a good fix, the first instant.
EXCLUDED_SPECIES = "homo sapien"
GOOD_STATUS = "A"
EPOCH = "1970-01-01 00:00:00"


# --- rules on raw events, each true for a row to keep ---


def visible(df: DataFrame) -> Column:
    return F.coalesce(F.col("visible"), F.lit(True))


def has_position(df: DataFrame) -> Column:
    return present(df, "lon") & present(df, "lat")


def not_on_zero(df: DataFrame) -> Column:
    """Neither coordinate is zero. True points on the equator are dropped as well."""
    return (F.col("lon") != 0) & (F.col("lat") != 0)


def lon_in_range(df: DataFrame) -> Column:
    return F.col("lon").between(-180, 180)


def lat_in_range(df: DataFrame) -> Column:
    return F.col("lat").between(-90, 90)


def has_time(df: DataFrame) -> Column:
    return F.col("timestamp").isNotNull()


def not_epoch(df: DataFrame) -> Column:
    return F.col("timestamp") != F.lit(EPOCH).cast("timestamp")


def before(as_of=None, tolerance: str | None = None):
    """Times before `as_of` (now when not given), plus a tolerance such as '1 day'."""

    def rule(df: DataFrame) -> Column:
        limit = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        if tolerance:
            limit = limit + F.expr(f"interval {tolerance}")
        return F.col("timestamp") < limit

    return rule


def good_status(df: DataFrame) -> Column:
    return F.col("eobs_status").isNull() | (F.col("eobs_status") == GOOD_STATUS)


def not_marked_outlier(df: DataFrame) -> Column:
    return ~F.coalesce(F.col("manually_marked_outlier"), F.lit(False))


def event_rules(
    as_of=None, check_range: bool = True, tolerance: str | None = None, outliers: bool = False
) -> dict:
    """The rules in the order they are applied, by name."""
    rules = {
        "visible": visible,
        "position": has_position,
        "zero": not_on_zero,
        "lon_range": lon_in_range,
        "lat_range": lat_in_range,
        "time": has_time,
        "epoch": not_epoch,
        "future": before(as_of, tolerance),
        "status": good_status,
    }
    if not check_range:
        del rules["lon_range"], rules["lat_range"]
    if outliers:
        rules["outlier"] = not_marked_outlier
    return rules


def holds(rule, df: DataFrame) -> Column:
    """A rule that cannot be decided because a value is missing does not hold."""
    return F.coalesce(rule(df), F.lit(False))


def keep_valid(df: DataFrame, rules: dict) -> DataFrame:
    for rule in rules.values():
        df = df.where(rule(df))
    return df


def first_failing_rule(df: DataFrame, rules: dict) -> Column:
    """Name of the first rule the row breaks, or null for a good row."""
    broken = [F.when(~holds(rule, df), F.lit(name)) for name, rule in rules.items()]
    return F.coalesce(*broken)


def reject_report(df: DataFrame, rules: dict, by: str = "study_id") -> DataFrame:
    """Rows in, failing and dropped per study and rule, from one pass.

    `failing` counts rows that break the rule, `dropped` those that got as far as this rule.
    """
    first = first_failing_rule(df, rules)
    counts = [F.count("*").alias("_in")]
    for name, rule in rules.items():
        counts.append(F.count(F.when(~holds(rule, df), 1)).alias(f"_f_{name}"))
        counts.append(F.count(F.when(first == name, 1)).alias(f"_d_{name}"))
    wide = df.groupBy(by).agg(*counts)
    lines = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("rule"),
            F.col("_in").alias("rows_in"),
            F.col(f"_f_{name}").alias("failing"),
            F.col(f"_d_{name}").alias("dropped"),
        )
        for position, name in enumerate(rules, 1)
    ]
    return wide.select(by, F.inline(F.array(*lines)))


def reject_totals(df: DataFrame, rules: dict, by: str = "study_id") -> DataFrame:
    """Rows in, out and dropped per study."""
    bad = first_failing_rule(df, rules)
    return df.groupBy(by).agg(
        F.count("*").alias("rows_in"),
        F.count(F.when(bad.isNull(), 1)).alias("rows_out"),
        F.count(bad).alias("rows_dropped"),
    )


# --- individuals ---


def allowed_species(pattern: str = EXCLUDED_SPECIES) -> Column:
    name = F.col("taxon_canonical_name")
    return name.isNull() | ~contains_ignoring_case(name, pattern)


def keep_allowed_species(
    individual: DataFrame, pattern: str = EXCLUDED_SPECIES, keep_missing: bool = True
) -> DataFrame:
    """Individuals of an allowed species.

    With keep_missing off, those without a species go too, unless their whole study has none.
    """
    if keep_missing:
        return individual.where(allowed_species(pattern))
    named = individual.where(F.col("taxon_canonical_name").isNotNull())
    without_names = individual.join(named.select("study_id").distinct(), "study_id", "left_anti")
    return named.where(allowed_species(pattern)).unionByName(without_names)


def removed_species(individual: DataFrame, pattern: str = EXCLUDED_SPECIES) -> DataFrame:
    """The individuals the species rule removes."""
    return individual.where(~allowed_species(pattern)).select(
        "study_id", "individual_id", "local_identifier", "nick_name", "taxon_canonical_name"
    )


# --- query predicates ---


def of_study(df: DataFrame, *study_ids: int) -> DataFrame:
    """One study or several; prunes partitions of the tables."""
    return df.where(F.col("study_id").isin(*study_ids))


def in_period(df: DataFrame, start, end, ts: str = "timestamp") -> DataFrame:
    """start <= time < end."""
    c = F.col(ts)
    return df.where((c >= F.lit(start).cast("timestamp")) & (c < F.lit(end).cast("timestamp")))


def between_dates(df: DataFrame, first, last, ts: str = "timestamp") -> DataFrame:
    """From the first date up to, without, the last one.

    Times used to be compared as text, where a time on the last date sorts after that date.
    """
    return in_period(df, first, last, ts)


def of_species(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("taxon_canonical_name") == name)


def of_sensor_type(df: DataFrame, sensor_type_id: int = GPS_SENSOR_TYPE) -> DataFrame:
    return df.where(F.col("sensor_type_id") == sensor_type_id)


def on_day(df: DataFrame, date: str, ts: str = "timestamp") -> DataFrame:
    """Times on one day, written as a range so that files can be skipped."""
    start = F.lit(date).cast("timestamp")
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day")))


def with_epoch_text(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_epoch_text(F.col(column)))

"""Joins between the entities: reductions, the deployment interval join, identifiers."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.operators.joins import BROADCAST_BYTES, HOT_ROWS, is_small, join_facts, staged_hot_keys

DEPLOYMENT_KEYS = ("study_id", "individual_id", "tag_id")
# Keys with more deployments have time bins in a binned join.
FEW_DEPLOYMENTS = 16
DEPLOYMENT_COLUMNS = ("deployment_id", "deploy_on_timestamp", "deploy_off_timestamp")


def reduce_entities(
    individual: DataFrame,
    tag: DataFrame,
    sensor: DataFrame,
    deployment: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, DataFrame]:
    """Keep what belongs together.

    Deployments of known individuals; individuals and tags that were deployed; sensors on those
    tags. Semi joins, so repeated keys on the other side multiply nothing. `keep` may write each table
    (see session.stage) before others are reduced by it.
    """
    deployment = keep(keep_matching(deployment, individual, ["study_id", "individual_id"]), "deployment")
    tag = keep(keep_matching(tag, deployment, ["study_id", "tag_id"]), "tag")
    return {
        "individual": keep(keep_matching(individual, deployment, ["study_id", "individual_id"]), "individual"),
        "tag": tag,
        "sensor": keep(keep_matching(sensor, tag, ["study_id", "tag_id"]), "sensor"),
        "deployment": deployment,
    }


def keep_matching(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_anti")


def in_deployment(
    ts: str = "timestamp", on: str = "deploy_on_timestamp", off: str = "deploy_off_timestamp"
) -> Column:
    """on <= time < off, where a missing end is open."""
    time = F.col(ts)
    after_on = F.col(on).isNull() | (time >= F.col(on))
    before_off = F.col(off).isNull() | (time < F.col(off))
    return after_on & before_off


def interval_join(
    events: DataFrame,
    deployments: DataFrame,
    keys: tuple[str, ...] = DEPLOYMENT_KEYS,
    how: str = "inner",
    **limits,
) -> DataFrame:
    """Events with the deployment they fall into.

    `how="left"` keeps the others too, with an empty deployment.
    """
    side = deployments.select(*keys, *DEPLOYMENT_COLUMNS)
    return join_facts(events, side, list(keys), how, in_deployment(), **limits)


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def bins_of_keys(deployments: DataFrame, keys: tuple[str, ...], few: int = FEW_DEPLOYMENTS) -> DataFrame:
    """(keys, _low, _width, _bins) of the keys with many deployments: at most as many time bins as deployments.

    A bin is no shorter than the mean deployment, so that they reach into three bins each on average, however much
    they overlap. An open end counts as the first or last end of its key. Sums are exact: all readings have equal bins.
    """
    on, off = _micros(F.col("deploy_on_timestamp")), _micros(F.col("deploy_off_timestamp"))
    # An end before the start has no length.
    end = F.when(off.isNotNull(), F.greatest(on, off))
    spans = deployments.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.min(F.least(on, off)).alias("_low"),
        F.max(F.greatest(on, off)).alias("_high"),
        *[F.coalesce(F.sum(c.cast("decimal(20,0)")), F.lit(0)).alias(n) for c, n in ((on, "_starts"), (end, "_ends"))],
        *[F.count(F.when(c.isNull(), 1)).alias(n) for c, n in ((on, "_no_start"), (off, "_no_end"))],
    )
    spans = spans.where((F.col("_n") > few) & F.col("_low").isNotNull())
    low, high = (F.col(c).cast("decimal(20,0)") for c in ("_low", "_high"))
    length = F.col("_ends") + high * F.col("_no_end") - F.col("_starts") - low * F.col("_no_start")
    mean = F.ceil(length / F.col("_n")).cast("bigint")
    width = F.greatest(F.floor((F.col("_high") - F.col("_low")) / F.col("_n")) + 1, mean)
    return spans.select(*keys, "_low", width.alias("_width"), F.floor((F.col("_high") - F.col("_low")) / width).alias("_bins"))


def _bin(micros: Column) -> Column:
    """The bin of a time; one before and one after all bins take what lies outside, and keys without bins have one."""
    place = F.floor((micros - F.col("_low")) / F.col("_width"))
    inside = F.least(F.greatest(place, F.lit(-1)), F.col("_bins") + 1)
    # Least and greatest pass over missing values.
    return F.when(F.col("_low").isNull(), F.lit(0)).when(micros.isNotNull(), inside).cast("long")


def binned_deployments(
    deployments: DataFrame, bins: DataFrame, keys: tuple[str, ...], columns: tuple[str, ...] = DEPLOYMENT_COLUMNS
) -> DataFrame:
    """A row per bin that a deployment reaches into; an open end reaches into the outermost bin."""
    side = deployments.select(*keys, *columns).join(bins, list(keys), "left")
    first = F.when(F.col("_low").isNull(), F.lit(0)).otherwise(
        F.coalesce(_bin(_micros(F.col("deploy_on_timestamp"))), F.lit(-1))
    )
    # The end is not part of the interval.
    last = F.when(F.col("_low").isNull(), F.lit(0)).otherwise(
        F.coalesce(_bin(_micros(F.col("deploy_off_timestamp")) - 1), F.col("_bins") + 1)
    )
    side = side.withColumn("_first", first.cast("long")).withColumn("_last", last.cast("long")).where("_first <= _last")
    return side.withColumn("_bin", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last", "_low", "_width", "_bins")


def binned_interval_join(
    events: DataFrame,
    deployments: DataFrame,
    keys: tuple[str, ...] = DEPLOYMENT_KEYS,
    how: str = "inner",
    few: int = FEW_DEPLOYMENTS,
    columns: tuple[str, ...] = DEPLOYMENT_COLUMNS,
    **limits,
) -> DataFrame:
    """As interval_join, for keys that may have thousands of deployments.

    Deployments of such keys are cut into time bins, and an event meets only those of its bin. Other keys have one bin.
    `columns` of the deployments are added to the events, the ends of the interval among them.
    """
    bins = bins_of_keys(deployments, keys, few)
    small, hot, again = is_small(bins, limits.get("broadcast_bytes", BROADCAST_BYTES)), None, None
    if not small:
        hot = staged_hot_keys(events, list(keys), limits.get("hot_rows", HOT_ROWS))
        # Without hot keys there are no hot bins either, and events need not be counted again.
        again = hot.withColumn("_bin", F.lit(0).cast("bigint")) if hot.isEmpty() else None
    marked = join_facts(events, bins, list(keys), "left", small=small, hot=hot, **limits)
    marked = marked.withColumn("_bin", _bin(_micros(F.col("timestamp")))).drop("_low", "_width", "_bins")
    side = binned_deployments(deployments, bins, keys, columns)
    return join_facts(marked, side, [*keys, "_bin"], how, in_deployment(), hot=again, **limits).drop("_bin")


def null_keyed_deployments(deployments: DataFrame) -> DataFrame:
    """Deployments no event can match, because an id is missing."""
    return deployments.where(F.col("individual_id").isNull() | F.col("tag_id").isNull())


def fill_study(events: DataFrame, individual: DataFrame) -> DataFrame:
    """Set the study of each event from its individual.

    An individual that stands in several studies tells none: its events get a missing study, and none
    of them is repeated.
    """
    studies = individual.groupBy("individual_id").agg(
        F.min("study_id").alias("study_id"), F.count_distinct("study_id").alias("_n")
    )
    side = studies.where("_n = 1").drop("_n")
    return join_facts(events.drop("study_id"), side, ["individual_id"], "left")


def events_of_individuals(events: DataFrame, individual: DataFrame) -> DataFrame:
    """Events whose individual is in the given set."""
    return join_facts(events, individual.select("individual_id"), ["individual_id"], "left_semi")


def without_rows(events: DataFrame, rejects: DataFrame, on: list[str]) -> DataFrame:
    """Events that are not in an arbitrary set of rejects."""
    return join_facts(events, rejects.select(*on).distinct(), on, "left_anti")


def name_sensor_types(sensor: DataFrame, types: DataFrame) -> DataFrame:
    """The sensor types in use, with their names, in order of id."""
    names = types.select(F.col("id").alias("sensor_type_id"), "name")
    used = sensor.select("sensor_type_id").distinct()
    return used.join(names, "sensor_type_id", "left").orderBy("sensor_type_id")


def resolve_identifiers(
    export: DataFrame,
    tag: DataFrame,
    individual: DataFrame,
    sensor: DataFrame,
    types: DataFrame,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Give exported events the ids their files name only by local identifier.

    `by` holds further columns that must agree, such as the study.
    """
    by = list(by)
    tags = tag.select(*by, "tag_id", F.col("local_identifier").alias("tag_local_identifier"))
    individuals = individual.select(
        *by, "individual_id", F.col("local_identifier").alias("individual_local_identifier")
    )
    names = types.select(
        F.lower("name").alias("_sensor_name"), F.col("id").alias("sensor_type_id")
    )
    out = join_facts(export, tags, [*by, "tag_local_identifier"], "left")
    out = join_facts(out, individuals, [*by, "individual_local_identifier"], "left")
    out = out.withColumn("_sensor_name", F.lower("sensor_type"))
    out = join_facts(out, names, ["_sensor_name"], "left").drop("_sensor_name")
    sensors = sensor.select(*by, "sensor_id", "sensor_type_id", "tag_id")
    return join_facts(out, sensors, [*by, "sensor_type_id", "tag_id"], "left")

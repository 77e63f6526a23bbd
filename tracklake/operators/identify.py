"""Identifiers of an export resolved by time: a name stands for what was deployed under it when the event happened.

Several tags of a study may share a local identifier, and so may individuals. The deployments under a pair of names
are cut into disjoint intervals before events are looked at, so an event meets one interval at most and no event is
ever repeated: what stays ambiguous is told by a count.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.operators.checks import all_of, violation
from tracklake.operators.joins import join_facts
from tracklake.operators.relate import binned_interval_join
from tracklake.session import stage

NAMES = ("tag_local_identifier", "individual_local_identifier")
RESOLVED = ("tag_id", "individual_id", "sensor_type_id", "sensor_id", "candidates", "sensors")
# Beyond any time: ends of deployments that are open.
OPEN = 1 << 62
ID = "decimal(20,0)"


def named_deployments(deployment: DataFrame, tag: DataFrame, individual: DataFrame, by: list[str]) -> DataFrame:
    """Deployments under the names of their tag and individual, as microseconds; without names or length they go."""
    tags = tag.select(*by, "tag_id", F.col("local_identifier").alias(NAMES[0])).distinct()
    people = individual.select(*by, "individual_id", F.col("local_identifier").alias(NAMES[1])).distinct()
    use = deployment.join(tags, [*by, "tag_id"]).join(people, [*by, "individual_id"])
    on = F.coalesce(F.unix_micros("deploy_on_timestamp"), F.lit(-OPEN))
    off = F.coalesce(F.unix_micros("deploy_off_timestamp"), F.lit(OPEN))
    use = use.select(*by, *NAMES, "tag_id", "individual_id", on.alias("_on"), off.alias("_off"))
    return use.na.drop(subset=[*by, *NAMES]).where("_on < _off")


def name_intervals(named: DataFrame, by: list[str]) -> DataFrame:
    """Disjoint intervals per pair of names: how many tags and individuals hold it, and which if it is one.

    Deployments of the same tag on the same individual that overlap or touch are one. Numbers and ids are summed
    along the ends of the stretches; where a single one is open, the sum of ids is its id.
    """
    keys = [*by, *NAMES]
    own = Window.partitionBy(*keys, "tag_id", "individual_id").orderBy("_on", "_off")
    reached = F.max("_off").over(own.rowsBetween(Window.unboundedPreceding, -1))
    named = named.withColumn("_new", F.when(reached >= F.col("_on"), 0).otherwise(1))
    named = named.withColumn("_stretch", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = named.groupBy(*keys, "tag_id", "individual_id", "_stretch").agg(
        F.min("_on").alias("_on"), F.max("_off").alias("_off")
    )

    def end(at: str, sign: int):
        ids = [(F.col(c).cast(ID) * F.lit(sign)).alias(f"_{c}") for c in ("tag_id", "individual_id")]
        return F.struct(F.col(at).alias("_at"), F.lit(sign).alias("_step"), *ids)

    ends = stretches.select(*keys, F.inline(F.array(end("_on", 1), end("_off", -1))))
    sums = ("_step", "_tag_id", "_individual_id")
    ends = ends.groupBy(*keys, "_at").agg(*[F.sum(c).alias(c) for c in sums])
    order = Window.partitionBy(*keys).orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    spans = ends.select(*keys, "_at", F.lead("_at").over(order).alias("_next"), *[F.sum(c).over(so_far).alias(c) for c in sums])
    single = F.col("_step") == 1
    return spans.where("_step > 0").select(
        *keys,
        F.when(single, F.col("_tag_id").cast("bigint")).alias("tag_id"),
        F.when(single, F.col("_individual_id").cast("bigint")).alias("individual_id"),
        F.col("_step").cast("bigint").alias("candidates"),
        F.when(F.col("_at") > -OPEN, F.timestamp_micros("_at")).alias("deploy_on_timestamp"),
        F.when(F.col("_next") < OPEN, F.timestamp_micros("_next")).alias("deploy_off_timestamp"),
    )


def resolve_by_time(
    export: DataFrame,
    deployment: DataFrame,
    tag: DataFrame,
    individual: DataFrame,
    sensor: DataFrame,
    types: DataFrame,
    by: tuple[str, ...] = ("study_id",),
    **limits,
) -> DataFrame:
    """Each exported event once, with the ids that its names stand for at its time.

    `candidates` counts the pairs of tag and individual deployed under its names then, `sensors` the sensors of its
    type on that tag. Ids are missing where the count is not one; so they are for events without a name. Columns of the
    export with the names of the ids are replaced. `by` holds further columns that must agree.
    """
    by = list(by)
    export = export.drop(*RESOLVED)
    spans = stage(name_intervals(named_deployments(deployment, tag, individual, by), by), "names")
    ends = ("deploy_on_timestamp", "deploy_off_timestamp")
    held = ("tag_id", "individual_id", "candidates", *ends)
    out = binned_interval_join(export, spans, (*by, *NAMES), "left", columns=held, **limits).drop(*ends)
    kinds = types.groupBy(F.lower("name").alias("_kind")).agg(F.min("id").cast("bigint").alias("sensor_type_id"))
    out = join_facts(out.withColumn("_kind", F.lower("sensor_type")), kinds, ["_kind"], "left").drop("_kind")
    on = [*by, "tag_id", "sensor_type_id"]
    sensors = sensor.groupBy(*on).agg(F.min("sensor_id").alias("sensor_id"), F.count_distinct("sensor_id").alias("sensors"))
    sensors = sensors.withColumn("sensor_id", F.when(F.col("sensors") == 1, F.col("sensor_id")))
    out = join_facts(out, sensors, on, "left", **limits)
    return out.na.fill(0, ["candidates", "sensors"])


def ambiguous_names(resolved: DataFrame) -> DataFrame:
    """Studies with events whose names stand for several at their time."""
    groups = resolved.where("candidates > 1").groupBy("study_id").agg(F.count("*").alias("num"))
    return violation(groups, "identifier_ambiguous", F.lit("event"), F.col("num"))


def identifier_violations(resolved: DataFrame) -> DataFrame:
    """Ambiguous names, names that stand for nothing then, and events whose tag has several such sensors or none.

    The resolved events are read once.
    """
    kinds = {
        "identifier_ambiguous": F.col("candidates") > 1,
        "identifier_unknown": F.col("candidates") == 0,
        "identifier_sensor": (F.col("candidates") == 1) & (F.col("sensors") != 1),
    }
    sums = [F.count(F.when(wrong, 1)).alias(check) for check, wrong in kinds.items()]
    counts = stage(resolved.groupBy("study_id").agg(*sums), "identifiers")
    return all_of(*[violation(counts.where(F.col(check) > 0), check, F.lit("event"), F.col(check)) for check in kinds])

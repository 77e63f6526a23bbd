"""The query library: counts, extents and summaries over the tables.

Events are counted per individual before they meet another table. A task then sends at most
one row per individual to the shuffle, however the events are spread, and the joins that
follow are between small tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions.times import day, millis_of, millis_suffix, millis_text, year_text
from tracklake.functions.values import missing
from tracklake.operators.filters import in_period
from tracklake.operators.joins import join_facts
from tracklake.operators.relate import keep_matching


def num(name: str = "num"):
    return F.count("*").alias(name)


def events_by_individual(event: DataFrame) -> DataFrame:
    """Count and time extent per individual: the base of the larger reports."""
    return event.groupBy("individual_id").agg(
        num(), F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts")
    )


# --- studies and individuals ---


def study_list(study: DataFrame) -> DataFrame:
    return study.select("study_id", "study_name")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(num())


def individuals_per_study(individual: DataFrame) -> DataFrame:
    return individual.groupBy("study_id").agg(num())


def individuals_per_study_name(individual: DataFrame, study: DataFrame) -> DataFrame:
    """Two studies may have the same name, so the id stays in the result."""
    return individuals_per_study(individual).join(study_list(study), "study_id")


def individuals_per_study_and_species(individual: DataFrame, study: DataFrame) -> DataFrame:
    counts = individual.groupBy("study_id", "taxon_canonical_name").agg(num())
    return counts.join(study_list(study), "study_id").orderBy("taxon_canonical_name", "study_id")


def individuals_per_species(individual: DataFrame, study: DataFrame) -> DataFrame:
    """Individuals of known studies per species."""
    counts = individual.groupBy("study_id", "taxon_canonical_name").agg(num())
    known = keep_matching(counts, study, ["study_id"])
    return (
        known.groupBy("taxon_canonical_name")
        .agg(F.sum("num").alias("num"))
        .orderBy("taxon_canonical_name")
    )


def species(individual: DataFrame) -> DataFrame:
    return individual.select("taxon_canonical_name").distinct()


def individuals_of_study(individual: DataFrame, study: DataFrame, study_id: int) -> DataFrame:
    return keep_matching(individual.where(F.col("study_id") == study_id), study, ["study_id"])


def manufacturers(tag: DataFrame) -> DataFrame:
    return tag.select("manufacturer_name").distinct().orderBy("manufacturer_name")


# --- events ---


def of_study(event: DataFrame, study_id: int) -> DataFrame:
    """Events of one study, where they carry it: stored tables then read only its folders."""
    return event.where(F.col("study_id") == study_id) if "study_id" in event.columns else event


def events_per_individual(event: DataFrame, individual: DataFrame, study_id: int) -> DataFrame:
    """Locations per individual of one study."""
    members = individual.where(F.col("study_id") == study_id)
    counts = of_study(event, study_id).groupBy("individual_id").agg(num())
    return counts.join(members.select("individual_id"), "individual_id")


def events_per_individual_semi(event: DataFrame, individual: DataFrame, study_id: int) -> DataFrame:
    """The same by set membership: repeated individuals would not multiply the counts."""
    members = individual.where(F.col("study_id") == study_id)
    counts = of_study(event, study_id).groupBy("individual_id").agg(num())
    return keep_matching(counts, members, ["individual_id"])


def individual_extents(event: DataFrame, individual: DataFrame, study_id: int) -> DataFrame:
    """Count, first and last time per individual of one study."""
    members = individual.where(F.col("study_id") == study_id).select("individual_id")
    return events_by_individual(of_study(event, study_id)).join(members, "individual_id")


def study_extents(event: DataFrame, individual: DataFrame) -> DataFrame:
    """First and last time per study."""
    owners = individual.select("individual_id", "study_id")
    return (
        events_by_individual(event)
        .join(owners, "individual_id")
        .groupBy("study_id")
        .agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
    )


def individual_stats(event: DataFrame) -> DataFrame:
    """Time and coordinate extents and coordinate means per individual."""
    return event.groupBy("individual_id").agg(
        F.min("timestamp").alias("ts_min"),
        F.max("timestamp").alias("ts_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.avg("lon").alias("lon_mean"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.avg("lat").alias("lat_mean"),
    )


def years_of_study(
    event: DataFrame, individual: DataFrame, study_id: int, species_name: str
) -> DataFrame:
    """Individuals and observations per year, for one species of one study."""
    members = individual.where(
        (F.col("study_id") == study_id) & (F.col("taxon_canonical_name") == species_name)
    ).select("individual_id")
    per_year = (
        of_study(event, study_id)
        .groupBy("individual_id", year_text(F.col("timestamp")).alias("year"))
        .agg(
            num("obs"), F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts")
        )
        .join(members, "individual_id")
    )
    return per_year.groupBy("year").agg(
        num("individuals"),
        F.sum("obs").alias("obs"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
    )


def events_per_study(event: DataFrame, individual: DataFrame) -> DataFrame:
    """Points per study: counted per individual, then summed."""
    owners = individual.select("individual_id", "study_id")
    counts = event.groupBy("individual_id").agg(num())
    return counts.join(owners, "individual_id").groupBy("study_id").agg(F.sum("num").alias("num"))


def events_per_study_join_first(
    event: DataFrame, individual: DataFrame, study: DataFrame
) -> DataFrame:
    """The same, every event joined first. Kept to compare; events_per_study is the faster."""
    owners = individual.select("individual_id", "study_id")
    joined = join_facts(event.select("individual_id"), owners, ["individual_id"])
    return join_facts(joined, study_list(study), ["study_id"]).groupBy("study_id", "study_name").agg(num())


def events_per_study_name(counts: DataFrame, individual: DataFrame, study: DataFrame) -> DataFrame:
    """From stored counts per individual: points per study, with the name."""
    owners = individual.select("individual_id", "study_id")
    return (
        counts.join(owners, "individual_id")
        .groupBy("study_id")
        .agg(F.sum("num").alias("num"))
        .join(study_list(study), "study_id")
    )


def study_summary(event: DataFrame, individual: DataFrame, study: DataFrame) -> DataFrame:
    """Individuals with points, points, first and last year per study."""
    owners = individual.select("individual_id", "study_id")
    return (
        events_by_individual(event)
        .join(owners, "individual_id")
        .groupBy("study_id")
        .agg(
            num("num_individuals"),
            F.sum("num").alias("num_points"),
            year_text(F.min("min_ts")).alias("min_year"),
            year_text(F.max("max_ts")).alias("max_year"),
        )
        .join(study_list(study), "study_id")
    )


def individual_summary(event: DataFrame, individual: DataFrame, study: DataFrame) -> DataFrame:
    """Points and extent of every individual, in order of study."""
    people = individual.select("individual_id", "study_id", "local_identifier", "nick_name")
    return (
        events_by_individual(event)
        .join(people, "individual_id")
        .join(study_list(study), "study_id")
        .orderBy("study_id", "individual_id")
    )


def points_in_period(
    event: DataFrame, individual: DataFrame, study_id: int, start, end
) -> DataFrame:
    """Points of one study in a period; the period is pushed to the scan."""
    return events_per_individual(in_period(event, start, end), individual, study_id).agg(
        F.coalesce(F.sum("num"), F.lit(0)).alias("num")
    )


def individual_dates(event: DataFrame, individual: DataFrame, study_id: int) -> DataFrame:
    """First and last date per individual of one study."""
    people = individual.where(F.col("study_id") == study_id)
    return (
        events_by_individual(of_study(event, study_id))
        .join(people.select("individual_id", "local_identifier"), "individual_id")
        .select(
            "individual_id",
            "local_identifier",
            day(F.col("min_ts")).alias("mints"),
            day(F.col("max_ts")).alias("maxts"),
        )
    )


def events_per_day(event: DataFrame, individual_id: int | None = None) -> DataFrame:
    """Events per day, most first."""
    if individual_id is not None:
        event = event.where(F.col("individual_id") == individual_id)
    days = event.groupBy(day(F.col("timestamp")).alias("date")).agg(num())
    return days.orderBy(F.desc("num"), "date")


def millis_distribution(event: DataFrame) -> DataFrame:
    millis = millis_suffix(millis_text(F.col("timestamp")))
    return event.groupBy(millis.alias("millis")).agg(num()).orderBy("millis")


def unusual_millis(event: DataFrame, usual=(0, 1, 999)) -> DataFrame:
    """Events whose milliseconds are not among the usual ones."""
    marked = event.select("individual_id", "timestamp", millis_of(F.col("timestamp")).alias("millis"))
    return marked.where(~F.col("millis").isin(*usual))


def missing_speed(event: DataFrame) -> DataFrame:
    """Events with and without ground speed."""
    return event.groupBy(missing(event, "ground_speed").alias("is_missing")).agg(num())


def missing_speed_per_individual(event: DataFrame) -> DataFrame:
    lost = missing(event, "ground_speed").alias("is_missing")
    return event.groupBy("individual_id", lost).agg(num()).orderBy("individual_id", "is_missing")


def individuals_with_missing(event: DataFrame, column: str = "ground_speed") -> DataFrame:
    return event.where(missing(event, column)).select("individual_id").distinct()


def individual_events(event: DataFrame, individual_id: int, first: int, last: int) -> DataFrame:
    """Rows first to last of one individual's events, in order of tag, sensor and time."""
    own = event.where(F.col("individual_id") == individual_id)
    ordered = own.orderBy("tag_id", "sensor_type_id", "timestamp", "event_id")
    columns = ["event_id", "individual_id", "tag_id", "sensor_type_id", "timestamp", "ground_speed"]
    return ordered.select(*columns).offset(first - 1).limit(last - first + 1)


# --- deployments, and all tables ---


def deployment_patterns(deployment: DataFrame) -> DataFrame:
    """Which combinations of missing and present deployment ends occur."""
    return (
        deployment.select(
            F.col("deploy_on_timestamp").isNull().alias("na_dep_on"),
            F.col("deploy_off_timestamp").isNull().alias("na_dep_off"),
        )
        .distinct()
        .orderBy("na_dep_on", "na_dep_off")
    )


def latest_deployment(deployment: DataFrame, individual_id: int) -> DataFrame:
    own = deployment.where(F.col("individual_id") == individual_id)
    return own.agg(num(), F.max("deploy_on_timestamp").alias("max_on"))


def deployed_tags(individual: DataFrame, deployment: DataFrame) -> DataFrame:
    """Study and tag of every deployment, each pair once."""
    owners = individual.select("individual_id", "study_id")
    used = deployment.select("individual_id", "tag_id").join(owners, "individual_id")
    return used.select("study_id", "tag_id").distinct()


def tags_per_study(individual: DataFrame, deployment: DataFrame, tag: DataFrame) -> DataFrame:
    used = keep_matching(deployed_tags(individual, deployment), tag, ["tag_id"])
    return used.groupBy("study_id").agg(num())


def sensors_per_study(
    individual: DataFrame, deployment: DataFrame, tag: DataFrame, sensor: DataFrame
) -> DataFrame:
    used = keep_matching(deployed_tags(individual, deployment), tag, ["tag_id"])
    joined = used.join(sensor.select("sensor_id", "tag_id"), "tag_id")
    return joined.groupBy("study_id").agg(F.count_distinct("sensor_id").alias("num"))


def deployments_per_study(individual: DataFrame, deployment: DataFrame) -> DataFrame:
    per_individual = deployment.groupBy("individual_id").agg(num())
    owners = individual.select("individual_id", "study_id")
    joined = per_individual.join(owners, "individual_id")
    return joined.groupBy("study_id").agg(F.sum("num").alias("num"))


def entity_counts(db: dict[str, DataFrame]) -> DataFrame:
    """Rows of all six tables per study, for all studies together."""
    ind, dep, tag = db["individual"], db["deployment"], db["tag"]
    counts = {
        "study": db["study"].groupBy("study_id").agg(num()),
        "individual": individuals_per_study(ind),
        "deployment": deployments_per_study(ind, dep),
        "tag": tags_per_study(ind, dep, tag),
        "sensor": sensors_per_study(ind, dep, tag, db["sensor"]),
        "event": events_per_study(db["event"], ind),
    }
    out = None
    for name, df in counts.items():
        part = df.select("study_id", F.lit(name).alias("entity"), "num")
        out = part if out is None else out.unionByName(part)
    return out


TOTALS = (
    "number_of_individuals",
    "number_of_deployments",
    "number_of_deployed_locations",
    "timestamp_first_deployed_location",
    "timestamp_last_deployed_location",
)


def computed_totals(individual: DataFrame, deployment: DataFrame, event: DataFrame) -> DataFrame:
    """The totals a study reports about itself, computed from its clean tables."""
    people = individual.groupBy("study_id").agg(num("number_of_individuals"))
    uses = deployment.groupBy("study_id").agg(num("number_of_deployments"))
    points = event.groupBy("study_id").agg(
        num("number_of_deployed_locations"),
        F.min("timestamp").alias("timestamp_first_deployed_location"),
        F.max("timestamp").alias("timestamp_last_deployed_location"),
    )
    return people.join(uses, "study_id", "full").join(points, "study_id", "full")


def stacked_totals(study: DataFrame, computed: DataFrame) -> DataFrame:
    """Reported and computed totals, one row each per study."""
    reported = study.select("study_id", *TOTALS).withColumn("source", F.lit("reported"))
    return reported.unionByName(computed.select("study_id", *TOTALS).withColumn("source", F.lit("computed")))


def compare_totals(study: DataFrame, computed: DataFrame) -> DataFrame:
    """study, metric, reported, computed. For information: the two need not agree."""
    texts = stacked_totals(study, computed).select(
        "study_id", "source", *[_as_text(study, c).alias(c) for c in TOTALS]
    )
    long = texts.unpivot(["study_id", "source"], list(TOTALS), "metric", "value")
    return long.groupBy("study_id", "metric").agg(
        F.max(F.when(F.col("source") == "reported", F.col("value"))).alias("reported"),
        F.max(F.when(F.col("source") == "computed", F.col("value"))).alias("computed"),
    )


def _as_text(df: DataFrame, name: str):
    if name.startswith("timestamp"):
        return millis_text(F.col(name))
    return F.col(name).cast("string")


def register_views(db: dict[str, DataFrame]) -> None:
    """Make the tables known to SQL under their names."""
    for name, df in db.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """SQL over the registered tables, with named parameters such as :study_id."""
    return spark.sql(text, args=parameters)

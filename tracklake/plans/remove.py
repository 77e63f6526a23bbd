"""Deleting studies from the tables, and taking them out as data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.operators.checks import all_of
from tracklake.operators.joins import join_facts
from tracklake.operators.relate import drop_matching, keep_matching
from tracklake.operators.reports import of_study
from tracklake.schema import ENTITIES
from tracklake.session import stage
from tracklake.sources import tables

BY_STUDY = ("event", "deployment", "individual", "study")


def extract_study(db: dict[str, DataFrame], study_id: int) -> dict[str, DataFrame]:
    """All rows of one study: events by the study they carry, as delete takes them, the rest through its individuals.

    Events without a study are found through the individuals.
    """
    study = db["study"].where(F.col("study_id") == study_id)
    individual = db["individual"].where(F.col("study_id") == study_id)
    deployment = keep_matching(db["deployment"], individual, ["individual_id"])
    tag = keep_matching(db["tag"], deployment, ["tag_id"])
    event = of_study(db["event"], study_id)
    if "study_id" not in event.columns:
        event = join_facts(event, individual.select("individual_id"), ["individual_id"], "left_semi")
    return {
        "study": study,
        "individual": individual,
        "deployment": deployment,
        "tag": tag,
        "sensor": keep_matching(db["sensor"], tag, ["tag_id"]),
        "event": event,
    }


def split_for_delete(
    db: dict[str, DataFrame], study_id: int, shared_tags: str = "keep"
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per table, the rows to delete and the rows that stay.

    Tags have no study of their own: they are found through deployments, which must be read
    before those go. A tag another study uses too stays, unless shared_tags is "delete".
    """
    if shared_tags not in ("keep", "delete"):
        raise ValueError(f"unknown choice for shared tags: {shared_tags}")
    own = extract_study(db, study_id)
    used = own["deployment"].select("tag_id").distinct()
    if shared_tags == "keep":
        others = drop_matching(db["deployment"], own["deployment"], ["deployment_id"])
        used = drop_matching(used, others, ["tag_id"])
    out = {}
    for entity in ENTITIES:
        df = db[entity]
        if entity in ("tag", "sensor"):
            out[entity] = (keep_matching(df, used, ["tag_id"]), drop_matching(df, used, ["tag_id"]))
        elif "study_id" in df.columns:
            # By the study of the row, which is the folder that delete_study drops.
            gone = F.col("study_id") == study_id
            out[entity] = (df.where(gone), df.where(~gone | F.col("study_id").isNull()))
        else:
            on = own["individual"].select("individual_id")
            out[entity] = (own[entity], join_facts(df, on, ["individual_id"], "left_anti"))
    return out


def delete_counts(split: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows deleted per table."""
    return all_of(
        *[
            gone.agg(F.count("*").alias("num")).select(F.lit(entity).alias("entity"), "num")
            for entity, (gone, _) in split.items()
        ]
    )


def delete_study(
    spark: SparkSession, root: str, study_id: int, shared_tags: str = "keep"
) -> DataFrame:
    """Remove a study from all six tables. Returns the rows deleted per table.

    Events, deployments, individuals and the study row are dropped by folder: nothing of them
    is rewritten. Tags and sensors are small; the folders that lose rows are written anew
    without them, and tags that stay although their own study goes move to the study that
    uses them.
    """
    db = tables.read_tables(spark, root)
    split = split_for_delete(db, study_id, shared_tags)
    counts = stage(delete_counts(split), "deleted")

    states = []
    load_id = tables.new_load_id()
    for entity in BY_STUDY:
        parts = tables.live_parts(spark, root, entity).where(F.col("study_id") == study_id)
        states.append(parts.withColumn("state", F.lit("deleted")))
    homes = stage(_homes(db, study_id), "homes")
    for entity in ("tag", "sensor"):
        gone, stay = split[entity]
        touched = stage(
            gone.select("study_id").distinct().unionByName(
                stay.where(F.col("study_id") == study_id).select("study_id").distinct()
            ).distinct(),
            "touched",
        )
        rewritten = keep_matching(stay, touched, ["study_id"]).join(homes, "tag_id", "left")
        moved = F.when(F.col("study_id") == study_id, F.coalesce("_home", "study_id"))
        rewritten = rewritten.withColumn("study_id", F.coalesce(moved, F.col("study_id"))).drop("_home")
        written = tables.append_rows(rewritten, root, entity, load_id)
        old = keep_matching(tables.live_parts(spark, root, entity), touched, ["study_id"])
        states.append(old.withColumn("state", F.lit("deleted")))
        states.append(
            written.select(
                F.lit(load_id).alias("load_id"),
                "study_id",
                F.lit(entity).alias("entity"),
                F.lit("live").alias("state"),
            )
        )
    lines = stage(all_of(*[s.select("load_id", "study_id", "entity", "state") for s in states]), "states")
    tables.commit(lines, root)
    return counts


def _homes(db: dict[str, DataFrame], study_id: int) -> DataFrame:
    """For each tag other studies use: the first of them."""
    owners = db["individual"].where(F.col("study_id") != study_id).select("individual_id", "study_id")
    used = db["deployment"].select("individual_id", "tag_id").join(owners, "individual_id")
    return used.groupBy("tag_id").agg(F.min("study_id").alias("_home"))

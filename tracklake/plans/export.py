"""From an export of the web page, which names things, to clean tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.identify import ambiguous_names, resolve_by_time
from tracklake.plans.clean import Cleaned, clean
from tracklake.schema import clean_names, raw_schema
from tracklake.session import stage

KEPT = ("study_id", "manually_marked_outlier")


def as_raw_events(events: DataFrame) -> DataFrame:
    """The columns of raw events under clean names; those an export lacks are empty."""
    names, have = clean_names("event"), set(events.columns)
    kinds = {names.get(f.name, f.name): f.dataType for f in raw_schema("event")}
    columns = [(F.col(n) if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()]
    return events.select(*columns, *[n for n in KEPT if n in have])


def clean_export(export: DataFrame, entities: dict[str, DataFrame], types: DataFrame, **options) -> Cleaned:
    """Resolve the names of an export by time and clean it with the other five tables.

    Events whose names stand for nothing at their time are rejected as undeployed; a study with ambiguous ones fails.
    Events marked as outliers are rejected where the export has the mark. `options` are those of clean.
    """
    resolved = stage(
        resolve_by_time(
            export, entities["deployment"], entities["tag"], entities["individual"], entities["sensor"], types
        ),
        "resolved",
    )
    options.setdefault("outliers", "manually_marked_outlier" in export.columns)
    return clean({**entities, "event": as_raw_events(resolved)}, found=[ambiguous_names(resolved)], **options)

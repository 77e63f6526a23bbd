"""Column rules: renames, projections, merges, missing columns, wide and long forms."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.values import first_present
from tracklake.schema import CLEAN_EVENT_COLUMNS, FIELDS, clean_names, table_schema


def rename_raw(df: DataFrame, entity: str, fields=FIELDS) -> DataFrame:
    """Raw names to clean names; columns without a clean name keep theirs."""
    return df.withColumnsRenamed(clean_names(entity, fields))


def rename_position(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"location_long": "lon", "location_lat": "lat"})


def dictionary_columns(df: DataFrame, entity: str, fields=FIELDS) -> DataFrame:
    """Only the columns the dictionary lists for this table."""
    wanted = set(table_schema(entity, fields).fieldNames())
    return df.select(*[c for c in df.columns if c in wanted])


def merge_vendor_columns(df: DataFrame) -> DataFrame:
    """One accuracy, one time to fix and one fix type, from the vendor's or the general field."""
    return df.withColumns(
        {
            "horizontal_accuracy": first_present(
                df, "eobs_horizontal_accuracy_estimate", "gps_horizontal_accuracy_estimate"
            ),
            "time_to_fix": first_present(df, "eobs_used_time_to_get_fix", "gps_time_to_fix"),
            "fix_type": first_present(df, "eobs_type_of_fix", "gps_fix_type").try_cast("int"),
        }
    )


def final_event_columns(df: DataFrame) -> DataFrame:
    """The event columns of the clean table, with the study where it is known."""
    extra = ["study_id"] if "study_id" in df.columns else []
    return df.select(*extra, *CLEAN_EVENT_COLUMNS)


def conform(df: DataFrame, entity: str, fields=FIELDS) -> DataFrame:
    """Bring a frame to the table's columns: by name, missing ones empty, others dropped."""
    schema = table_schema(entity, fields)
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("-", "_") for c in df.columns])


def column_last(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], name)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def map_columns(df: DataFrame, kind: type[T.DataType], rule) -> DataFrame:
    """Apply a column rule to every column of one type."""
    named = {f.name: rule(F.col(f.name)) for f in df.schema if isinstance(f.dataType, kind)}
    return df.withColumns(named) if named else df


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add empty columns of the given types where they are not there yet."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of frames of different ages; columns one lacks are empty there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def to_long(df: DataFrame, ids: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """One row per id and column. Values become text, as the columns may differ in type."""
    rest = [c for c in df.columns if c not in ids]
    texts = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in rest])
    return texts.unpivot(ids, rest, name, value)


def rows_between(df: DataFrame, order: list, first: int, last: int) -> DataFrame:
    """Rows number first to last, counted from 1, in the given order."""
    return df.orderBy(*order).offset(first - 1).limit(last - first + 1)

"""Raw and clean CSV files, one set per study, read for all studies at once.

Two layouts are known: `<root>/<study>/raw/<entity>.csv` as downloaded, and
`<root>/<entity>/study_id=<study>/` as Spark writes it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.times import millis_text, parse_time
from tracklake.operators.shape import map_columns, normalise_headers, rename_position, rename_raw
from tracklake.schema import FIELDS, raw_schema, table_schema

LAYOUTS = {
    "folders": "{root}/{study}/raw/{entity}.csv",
    "partitions": "{root}/{entity}/study_id={study}",
}
# Tables with free text may hold line breaks inside quotes. Event files must stay splittable.
MULTI_LINE = ("study", "individual", "tag", "deployment", "sensor")

# Columns of an event export from the web page.
UI_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("ground_speed", T.DoubleType()),
        T.StructField("manually_marked_outlier", T.BooleanType()),
        T.StructField("visible", T.BooleanType()),
        T.StructField("tag_local_identifier", T.StringType()),
        T.StructField("individual_local_identifier", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
    ]
)


def typed(c: Column, kind: T.DataType) -> Column:
    """Text to a typed value; text that does not fit is missing, and so is empty text."""
    c = F.when(c != "", c)
    if isinstance(kind, T.LongType):
        # Ids may be written with decimals or an exponent.
        return F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,4)").try_cast("bigint"))
    if isinstance(kind, T.TimestampType):
        return parse_time(c)
    if isinstance(kind, T.StringType):
        return c
    return F.trim(c).try_cast(kind)


def study_from_path() -> Column:
    """The study id in the path of the file a row comes from."""
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"/(\d+)/raw/", 1)
    partition = F.regexp_extract(path, r"/study_id=(\d+)/", 1)
    return F.when(folder != "", folder).otherwise(partition).try_cast("bigint")


def _path(root: str, entity: str, layout: str, studies) -> str:
    """A path pattern. A study without the file is simply not there."""
    wanted = "*" if studies is None else "{" + ",".join(str(s) for s in studies) + "}"
    return LAYOUTS[layout].format(root=root, study=wanted, entity=entity)


def _read_text_columns(
    spark: SparkSession, path: str, names: list[str], multi_line: bool
) -> DataFrame:
    """All columns as text. Headers are checked: a file with other columns is an error."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        enforceSchema=False,
        nullValue="NA",
        multiLine=multi_line,
        quote='"',
        escape='"',
    )


def _study_column(df: DataFrame) -> DataFrame:
    """Study from the path, where the file itself does not tell."""
    return df.withColumn("_path_study", study_from_path())


def read_raw(
    spark: SparkSession,
    root: str,
    entity: str,
    studies=None,
    layout: str = "folders",
    fields=FIELDS,
    time_as_text: bool = False,
) -> DataFrame:
    """Typed raw rows of one table for all studies, or for some, under clean names.

    time_as_text keeps the text of event times next to them, as `ts_str`.
    """
    schema = raw_schema(entity, fields)
    multi_line = entity in MULTI_LINE
    text = _read_text_columns(spark, _path(root, entity, layout, studies), schema.names, multi_line)
    text = _study_column(text)
    columns = [typed(F.col(f.name), f.dataType).alias(f.name) for f in schema]
    extra = [F.col("_path_study")]
    if time_as_text:
        extra.append(F.col("timestamp").alias("ts_str"))
    df = rename_raw(text.select(*columns, *extra), entity, fields)
    own = F.col("study_id") if "study_id" in df.columns else F.lit(None).cast("bigint")
    return df.withColumn("study_id", F.coalesce(own, F.col("_path_study"))).drop("_path_study")


def read_raw_by_header(
    spark: SparkSession, root: str, entity: str, studies, layout: str = "folders", fields=FIELDS
) -> DataFrame:
    """As read_raw, for files whose columns come in different orders or are missing.

    Reads the header of each study, so it is meant for the few studies that need it.
    """
    schema = raw_schema(entity, fields)
    out = None
    for study in studies:
        path = _path(root, entity, layout, [study])
        text = spark.read.csv(
            path, header=True, nullValue="NA", multiLine=entity in MULTI_LINE, quote='"', escape='"'
        )
        have = set(text.columns)
        columns = [
            typed(F.col(f.name) if f.name in have else F.lit(None).cast("string"), f.dataType).alias(f.name)
            for f in schema
        ]
        df = rename_raw(text.select(*columns), entity, fields)
        own = F.col("study_id") if "study_id" in df.columns else F.lit(None).cast("bigint")
        df = df.withColumn("study_id", F.coalesce(own, F.lit(study).cast("bigint")))
        out = df if out is None else out.unionByName(df)
    return out


def read_ui_events(spark: SparkSession, path: str) -> DataFrame:
    """An event export from the web page: other headers, names instead of ids."""
    text = normalise_headers(spark.read.csv(path, header=True, nullValue="NA", quote='"', escape='"'))
    text = rename_position(text)
    have = set(text.columns)
    return text.select(
        *[
            typed(F.col(f.name) if f.name in have else F.lit(None).cast("string"), f.dataType).alias(f.name)
            for f in UI_EVENT_SCHEMA
        ]
    )


def time_columns_as_text(df: DataFrame) -> DataFrame:
    return map_columns(df, T.TimestampType, millis_text)


def balanced_by_study(df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows gathered by study for writing: a large study is split, small ones share a task."""
    return df.hint("rebalance", "study_id").sortWithinPartitions("study_id", *order)


def write_csv(df: DataFrame, root: str, entity: str, order: tuple[str, ...] = ()) -> None:
    """One folder per study; missing values are empty, times have milliseconds.

    Studies in the frame are replaced, other studies stay.
    """
    (
        time_columns_as_text(balanced_by_study(df, order))
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("study_id")
        .csv(f"{root}/{entity}", header=True, nullValue="", emptyValue='""', quote='"', escape='"')
    )


def write_raw(df: DataFrame, root: str, entity: str, fields=FIELDS) -> None:
    """Raw rows under raw names, for data that comes from another source."""
    back = {f.clean: f.raw for f in fields if f.entity == entity and f.raw and f.clean}
    names = raw_schema(entity, fields).names
    have = df.withColumnsRenamed(back) if entity not in ("study", "individual") else df
    if entity == "study":
        have = df.withColumn("id", F.col("study_id")).withColumnsRenamed({"study_name": "name"})
    if entity == "individual":
        have = df.withColumnsRenamed({"individual_id": "id"})
    # The folder takes the study_id column, so a table that has one of its own keeps a copy.
    columns = [
        (F.col(n) if n in have.columns else F.lit(None).cast("string")).alias(n)
        for n in names
        if n != "study_id"
    ]
    write_csv(have.select(*columns, "study_id"), root, entity)


def read_raw_snapshot(spark: SparkSession, root: str, entity: str, studies=None) -> DataFrame:
    """Raw rows written by write_raw."""
    fields = [f for f in FIELDS if not (f.entity == entity and f.raw == "study_id")]
    return read_raw(spark, root, entity, studies, layout="partitions", fields=fields)


def read_clean_csv(spark: SparkSession, root: str, entity: str, studies=None) -> DataFrame:
    """Clean rows written by write_csv."""
    schema = table_schema(entity)
    inside = [f for f in schema if f.name != "study_id"]
    path = _path(root, entity, "partitions", studies)
    text = _study_column(
        _read_text_columns(spark, path, [f.name for f in inside], entity in MULTI_LINE)
    )
    by_name = {f.name: typed(F.col(f.name), f.dataType).alias(f.name) for f in inside}
    by_name["study_id"] = F.col("_path_study").alias("study_id")
    return text.select(*[by_name[f.name] for f in schema])


def read_csv_with_header(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A clean CSV file of one table, columns found by their header."""
    text = spark.read.csv(path, header=True, nullValue="NA", multiLine=True, quote='"', escape='"')
    text = text.replace("NULL", None)
    have = set(text.columns)
    return text.select(
        *[
            typed(F.col(f.name) if f.name in have else F.lit(None).cast("string"), f.dataType).alias(f.name)
            for f in table_schema(entity)
        ]
    )


def infer_table(spark: SparkSession, path: str) -> DataFrame:
    """An empty frame with the columns and types found in a CSV file."""
    return spark.read.csv(path, header=True, inferSchema=True, nullValue="NA").limit(0)

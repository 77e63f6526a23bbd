"""Raw files of all studies: found by one listing, scanned by their headers, read with what was lost in them.

The columns of a file may come in any order, some may be missing and others added. The first lines of all files
are read in one distributed pass; files whose wanted columns stand at the same places are then read by one
scan, so the number of scans is that of different headers and not of studies. A file that cannot be read, because it
has no header, lacks its key or names a column twice, is a problem of its study alone.

Rows carry marks: `_file`, `_lost` (a bit for each column whose text did not fit its type and became a missing value)
and `_line` (the text of a line with too many or too few cells). They are counted per study, file and column from
the rows themselves, so large files are not read again for it.
"""

import csv
import re
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators.shape import rename_raw
from tracklake.schema import ENTITIES, FIELDS, raw_fields, raw_schema
from tracklake.sources.raw import MULTI_LINE, typed

PATTERNS = {"folders": "{root}/*/raw/*.csv", "partitions": "{root}/*/study_id=*/*"}
ENTITY_IN_PATH = {"folders": r"/raw/([a-z]+)\.csv$", "partitions": r"/([a-z]+)/study_id="}
STUDY_IN_PATH = {"folders": r"/(\d+)/raw/", "partitions": r"/study_id=(\d+)/"}
MARKS = ("_file", "_lost", "_line")
PROBLEM_SCHEMA = "study_id bigint, entity string, file string, kind string, column string, num bigint"
# Problems that a study cannot be loaded with.
FATAL = ("empty", "header", "missing")
SPLIT = 1 << 30
# Of a file with more bytes only the first line is read for its header.
LARGE = 16 << 20
FILE_SCHEMA = "study_id bigint, entity string, path string, size bigint, modified timestamp"


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches something, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def list_raw(spark: SparkSession, root: str, layout: str = "folders") -> DataFrame:
    """(study_id, entity, path, size, modified) of the raw files; none is opened."""
    pattern = PATTERNS[layout].format(root=root)
    if not any_file(spark, pattern):
        return spark.createDataFrame([], FILE_SCHEMA)
    files = spark.read.format("binaryFile").load(pattern)
    files = files.select(
        F.regexp_extract("path", STUDY_IN_PATH[layout], 1).try_cast("bigint").alias("study_id"),
        F.regexp_extract("path", ENTITY_IN_PATH[layout], 1).alias("entity"),
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
    )
    return files.where(F.col("entity").isin(*ENTITIES))


def plain_path(path: str) -> str:
    """The path of a file's metadata as a listing writes it."""
    return re.sub(r"^(\w+):///", r"\1:/", unquote(path))


def first_lines(spark: SparkSession, paths: list[str], large: list[str] = ()) -> dict[str, str]:
    """First line of each file that has one; of large files no more than that is read.

    Small files are read whole, several to a task. Each split of a large file is a task of its own that stops after a
    line; a session of its own holds the settings for it.
    """
    found = []
    if paths:
        lines = spark.read.text(paths).select("_metadata.file_path", "_metadata.file_block_start", "value").where("file_block_start = 0")
        # Lines of a split come in their order, and the first split of a file is in one task.
        found += lines.groupBy("file_path").agg(F.first("value").alias("line")).collect()
    if large:
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT))
        own.conf.set("spark.sql.files.openCostInBytes", str(SPLIT + 1))
        own.conf.unset("spark.sql.files.maxPartitionNum")
        own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
        lines = own.read.text(large).select("_metadata.file_path", "_metadata.file_block_start", "value")

        def first(batches):
            for batch in batches:
                if batch.num_rows:
                    if batch.column(1)[0].as_py() == 0:
                        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["file_path", "line"])
                    return

        found += lines.mapInArrow(first, "file_path string, line string").collect()
    # A row per file; the driver holds the list of files as well.
    return {plain_path(r["file_path"]): r["line"] for r in found}


def places(line: str | None, entity: str, fields=FIELDS) -> tuple[tuple[str, ...], list[str], str | None]:
    """The wanted column at each place of a header ("" elsewhere), the missing ones, and what is wrong with it."""
    wanted = [f.raw for f in raw_fields(entity, fields)]
    if line is None or not line.strip():
        return (), wanted, "empty"
    names = [n.strip() for n in next(csv.reader([line.removeprefix("﻿")]))]
    at = tuple(n if n in wanted else "" for n in names)
    missing = [n for n in wanted if n not in at]
    twice = [n for n in wanted if at.count(n) > 1]
    return at, missing, "header" if twice or wanted[0] in missing else None


def changed_studies(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Studies of a listing with a file that is new, gone or of another size or time than in the listing before."""
    parts = ["study_id", "path", "size", "modified"]
    now, before = listed.where("study_id is not null").select(*parts), known.select(*parts)
    changed = now.join(before, parts, "left_anti").unionByName(before.join(now, parts, "left_anti"))
    return now.select("study_id").distinct().join(changed, "study_id", "left_semi")


def append_manifest(listed: DataFrame, path: str) -> None:
    """Keep a listing; it takes the place of earlier ones of its studies."""
    listed.where("study_id is not null").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The latest listing of each study; empty where none has been kept."""
    if not any_file(spark, f"{path}/*.parquet"):
        return spark.createDataFrame([], FILE_SCHEMA)
    lines = spark.read.schema(f"{FILE_SCHEMA}, at timestamp").parquet(path)
    latest = lines.groupBy("study_id").agg(F.max("at").alias("at"))
    return lines.join(latest, ["study_id", "at"]).drop("at")


@dataclass
class RawFiles:
    """Marked rows per table, and the problems that were seen before any row was read."""

    tables: dict[str, DataFrame]
    problems: DataFrame
    studies: DataFrame


def _scan(spark: SparkSession, paths: list[str], at: tuple[str, ...], entity: str, study: str, fields) -> DataFrame:
    """Marked rows of files with the same places of columns."""
    kinds = {f.name: f.dataType for f in raw_schema(entity, fields)}
    names = [n or f"_other{i}" for i, n in enumerate(at)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    # All columns are parsed, or the parser would not see that a line has another number of cells.
    text = spark.read.option("columnPruning", False).csv(
        paths, schema=schema, header=True, enforceSchema=True, nullValue="NA", multiLine=entity in MULTI_LINE, quote='"',
        escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_line",
    )
    columns, lost = [], F.lit(0).cast("bigint")
    for bit, (name, kind) in enumerate(kinds.items()):
        if name not in names:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        value = typed(F.col(name), kind)
        columns.append(value.alias(name))
        if not isinstance(kind, T.StringType):
            gone = (F.trim(name) != "") & value.isNull() & F.col("_line").isNull()
            lost = lost + F.when(gone, F.lit(1 << bit).cast("bigint")).otherwise(0)
    path = F.col("_metadata.file_path")
    # Spark refuses to read nothing but broken lines, so their text is tied to a cell.
    line = F.concat("_line", F.substring(F.coalesce(F.col(names[0]), F.lit("")), 1, 0)).alias("_line")
    marks = [F.regexp_extract(path, study, 1).try_cast("bigint").alias("_path_study"), path.alias("_file"), lost.alias("_lost"), line]
    df = rename_raw(text.select(*columns, *marks), entity, fields)
    own = F.col("study_id") if "study_id" in df.columns else F.lit(None).cast("bigint")
    return df.withColumn("study_id", F.coalesce(own, F.col("_path_study"))).drop("_path_study")


def rename_keeps(entity: str, fields=FIELDS) -> list[str]:
    """Names of the columns whose bits `_lost` holds, in the order of the bits."""
    return [f.raw for f in raw_fields(entity, fields)]


def read_files(spark: SparkSession, files: DataFrame, layout: str = "folders", fields=FIELDS) -> RawFiles:
    """Marked rows of listed files (see list_raw); files whose path names no study are a problem without one."""
    listed = files.select("study_id", "entity", "path", "size").collect()
    small, large = ([r["path"] for r in listed if (r["size"] > LARGE) == kind] for kind in (False, True))
    lines = first_lines(spark, small, large)
    groups: dict[str, dict[tuple, list[str]]] = {e: {} for e in ENTITIES}
    problems = []
    for r in listed:
        study, entity, path = r["study_id"], r["entity"], r["path"]
        if study is None:
            problems.append((None, entity, path, "path", None, 1))
            continue
        at, missing, wrong = places(lines.get(plain_path(path)), entity, fields)
        if wrong:
            problems.append((study, entity, path, wrong, ",".join(missing) or None, 1))
            continue
        problems += [(study, entity, path, "column", name, 1) for name in missing]
        groups[entity].setdefault(at, []).append(path)
    # A listing passes over files of no bytes; they are missing too.
    there = {(r["study_id"], r["entity"]) for r in listed}
    studies = {study for study, _ in there if study is not None}
    problems += [(s, e, None, "missing", None, 1) for s in sorted(studies) for e in ENTITIES if (s, e) not in there]
    tables = {}
    for entity, of in groups.items():
        scans = [_scan(spark, paths, at, entity, STUDY_IN_PATH[layout], fields) for at, paths in sorted(of.items())]
        if not scans:
            # A header alone, so that the columns are the same.
            kinds = raw_schema(entity, fields)
            marks = [F.lit(None).cast("string").alias("_file"), F.lit(0).cast("bigint").alias("_lost"), F.lit(None).cast("string").alias("_line")]
            empty = rename_raw(spark.createDataFrame([], kinds).select("*", *marks), entity, fields)
            scans = [empty if "study_id" in empty.columns else empty.withColumn("study_id", F.lit(None).cast("bigint"))]
        out = scans[0]
        for more in scans[1:]:
            out = out.unionByName(more)
        tables[entity] = out
    return RawFiles(
        tables, spark.createDataFrame(problems, PROBLEM_SCHEMA), spark.createDataFrame([(s,) for s in sorted(studies)], "study_id bigint")
    )


def without_marks(df: DataFrame) -> DataFrame:
    """Rows as read_raw gives them: without marks and without the lines that have another number of cells."""
    return df.where(F.col("_line").isNull()).drop(*MARKS)


def lost_in(marked: DataFrame, entity: str, fields=FIELDS) -> DataFrame:
    """Lines with another number of cells, and values that did not fit, per study, file and column."""
    names = rename_keeps(entity, fields)
    counts = [F.count("_line").alias("_lines")]
    counts += [F.count_if(F.col("_lost").bitwiseAND(1 << bit) != 0).alias(f"_{bit}") for bit in range(len(names))]
    wide = marked.where("_line is not null or _lost <> 0").groupBy("study_id", "_file").agg(*counts)
    cells = [F.struct(F.lit("line").alias("kind"), F.lit(None).cast("string").alias("column"), F.col("_lines").alias("num"))]
    cells += [
        F.struct(F.lit("value").alias("kind"), F.lit(name).alias("column"), F.col(f"_{bit}").alias("num"))
        for bit, name in enumerate(names)
    ]
    long = wide.select("study_id", F.lit(entity).alias("entity"), F.col("_file").alias("file"), F.inline(F.array(*cells)))
    return long.where("num > 0")


def lines_in(marked: DataFrame, entity: str) -> DataFrame:
    """The lines that were left out, with their files."""
    return marked.where("_line is not null").select(
        "study_id", F.lit(entity).alias("entity"), F.col("_file").alias("file"), F.col("_line").alias("line")
    )

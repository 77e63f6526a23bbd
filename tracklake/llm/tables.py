"""Reading the given tables, and picking columns without clashes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; whatever else the frame holds is left out."""
    return df.select(*(df[name].alias(own) for own, name in columns.items()))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds

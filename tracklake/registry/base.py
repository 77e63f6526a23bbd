"""Registering queries: a name, the inventory ids it covers, a function and its SQL."""

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.registry.mapping import RELATIONS, Testbed

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Callable[[Testbed], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(ids: str, sql: str | None = None):
    """Register a function of the testbed under its own name.

    Times in the result become text, so that time zones play no part in the comparison.
    """

    def add(function):
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(name, ids, function, None if sql is None else with_relations(sql))
        return function

    return add


def plain(df: DataFrame) -> DataFrame:
    """Times and dates as text."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(F.date_format(f.name, TIME_TEXT).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def with_relations(sql: str) -> str:
    """SQL with the mapped relations it names put in front, and time helpers filled in.

    `{{ts:x}}` prints a time with microseconds.
    """
    sql = re.sub(r"\{\{ts:([^}]+)\}\}", r"strftime(\1, '%Y-%m-%d %H:%M:%S.%f')", sql)
    used = _relations_in(sql)
    needed = [n for n in RELATIONS if n in used]
    if not needed:
        return sql
    head = ", ".join(f"{n} as ({RELATIONS[n]})" for n in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"


def _relations_in(sql: str) -> set[str]:
    """Mapped relations a statement uses, directly or through other ones."""
    used, new = set(), {n for n in RELATIONS if re.search(rf"\b{n}\b", sql)}
    while new:
        used |= new
        inside = " ".join(RELATIONS[n] for n in new)
        new = {n for n in RELATIONS if re.search(rf"\b{n}\b", inside)} - used
    return used


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, folder: plain(q.run(Testbed(spark, folder)))

    return {name: bind(q) for name, q in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql is not None}

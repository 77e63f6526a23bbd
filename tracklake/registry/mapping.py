"""The driver's tables seen as tracking data.

Nation is the study, customer the individual. Two kinds of events:

- fixes: from `events`. Unique ids, sub-second times, all raw columns, every fourth or so broken
  in one way. One event in ten has a second copy 250 ms later with other values present, one in
  thirty a third. Tags: five per customer, one per event type.
- ships: from `lineitem`, the largest table. One tag per order, dates only, spread over years.

All expressions are plain SQL that Spark and DuckDB read alike; both sides build on this text.
Coordinates are multiples of 1/8, so that sums are exact in any order.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators.joins import join_facts
from tracklake.schema import SENSOR_TYPES, sensor_types
from tracklake.session import configure

AS_OF = "2024-01-29 00:00:00"
EXCLUDED = "homo sapien"

STUDY = {
    "study_id": "cast(n_nationkey as bigint)",
    "study_name": "n_name",
    "number_of_individuals": "cast(n_nationkey * 2 as bigint)",
    "number_of_deployments": "cast(n_nationkey * 10 as bigint)",
    "number_of_deployed_locations": "cast(n_nationkey * 100 as bigint)",
    "timestamp_first_deployed_location": "timestamp '2024-01-01 00:00:00' + interval '1' day * n_nationkey",
    "timestamp_last_deployed_location": "timestamp '2024-02-01 00:00:00' - interval '1' day * n_nationkey",
}
INDIVIDUAL = {
    "individual_id": "c_custkey",
    "local_identifier": "c_name",
    "nick_name": "case when c_custkey % 9 = 0 then null else concat('N', c_custkey % 50) end",
    "study_id": "cast(c_nationkey as bigint)",
    "sex": "case when c_custkey % 2 = 0 then 'm' else 'f' end",
    "taxon_canonical_name": "case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 then 'Homo Sapiens' else c_mktsegment end",
}
# k is the number of the tag of this individual.
TAG = {
    "tag_id": "c_custkey * 8 + k",
    "local_identifier": "concat('T-', c_custkey * 8 + k)",
    "manufacturer_name": "concat('maker ', k)",
    "study_id": "cast(c_nationkey as bigint)",
}
TYPE_OF_K = "cast(case when {k} < 3 then 653 else 2365683 end as bigint)"
SENSOR = {
    "sensor_id": "(c_custkey * 8 + k) * 2",
    "sensor_type_id": TYPE_OF_K.format(k="k"),
    "tag_id": "c_custkey * 8 + k",
    "study_id": "cast(c_nationkey as bigint)",
}
DEPLOYMENT = {
    "deployment_id": "c_custkey * 8 + k",
    "local_identifier": "case when k = 1 then 'NA' else concat('D', k) end",
    "individual_id": "c_custkey",
    "tag_id": "c_custkey * 8 + k",
    "deploy_on_timestamp": "case when (c_custkey + k) % 5 = 0 then null else timestamp '2024-01-01 00:00:00' + interval '1' day * ((c_custkey * 7 + k * 3) % 10) end",
    "deploy_off_timestamp": "case when (c_custkey + k) % 7 = 0 then null else timestamp '2024-01-16 00:00:00' + interval '1' day * ((c_custkey * 3 + k) % 12) end",
    "study_id": "cast(c_nationkey as bigint)",
}
K = "case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end"
# d is the number of the copy of the event.
RAW_EVENT = {
    "event_id": "event_id * 4 + d",
    "individual_id": "case when event_id % 211 = 0 then null else user_id end",
    "lon": "case when event_id % 29 = 0 then null when event_id % 31 = 0 then 0.0e0 else cast((event_id * 37) % 3200 as double) / 8 - 200 end",
    "lat": "case when event_id % 37 = 0 then cast('NaN' as double) else cast((event_id * 53) % 1520 as double) / 8 - 95 end",
    "timestamp": "case when event_id % 97 = 0 then null when event_id % 101 = 0 then timestamp '1970-01-01 00:00:00' else ts + interval '1' millisecond * (d * 250) end",
    "sensor_type_id": TYPE_OF_K.format(k=f"({K})"),
    "tag_id": f"user_id * 8 + ({K})",
    "ground_speed": "case when (event_id + d) % 2 = 0 then null when event_id % 17 = 0 then cast('NaN' as double) else value end",
    "gps_speed_accuracy_estimate": "case when event_id % 6 = 0 then value / 4 end",
    "visible": "case when event_id % 3 = 0 then null when event_id % 41 = 0 then false else true end",
    "gps_dop": "case when (event_id + d) % 3 = 0 then value / 2 end",
    "gps_hdop": "cast(null as double)",
    "gps_vdop": "cast(null as double)",
    "eobs_horizontal_accuracy_estimate": "case when event_id % 20 = 1 then cast('NaN' as double) when event_id % 4 = 1 then value end",
    "gps_horizontal_accuracy_estimate": "case when event_id % 4 < 2 then value * 2 end",
    "location_error_numerical": "cast(null as double)",
    "location_error_percentile": "cast(null as double)",
    "location_error_text": "case when event_id % 50 = 0 then 'far off' end",
    "gps_fix_type": "case when event_id % 2 = 0 then 3.0e0 end",
    "gps_satellite_count": "cast(event_id % 12 as double)",
    "gps_time_to_fix": "case when event_id % 3 = 1 then 30.0e0 end",
    "eobs_type_of_fix": "case when event_id % 5 = 0 then 2.0e0 end",
    "eobs_used_time_to_get_fix": "case when event_id % 7 = 0 then 60.0e0 end",
    "eobs_status": "case when event_id % 5 = 0 then 'A' when event_id % 43 = 0 then 'B' end",
}
SHIP = {
    "individual_id": "o_custkey",
    "tag_id": "l_orderkey",
    "sensor_type_id": "cast(653 as bigint)",
    "timestamp": "l_shipdate",
    "lon": "cast(l_partkey % 400 - 200 as double)",
    "lat": "cast(l_suppkey * 7 % 200 - 100 as double)",
    "ground_speed": "case when l_linenumber % 3 = 0 then null else l_quantity end",
}
SHIP_DEPLOYMENT = {
    "deployment_id": "o_orderkey",
    "tag_id": "o_orderkey",
    "individual_id": "o_custkey",
    "deploy_on_timestamp": "case when o_orderkey % 5 = 0 then null else o_orderdate end",
    "deploy_off_timestamp": "case when o_orderkey % 7 = 0 then null else o_orderdate + interval '60' day end",
}
# An export from the web page: names instead of ids.
UI_EVENT = {
    "event_id": "event_id",
    "lon": "cast((event_id * 37) % 3200 as double) / 8 - 200",
    "lat": "cast((event_id * 53) % 1520 as double) / 8 - 95",
    "timestamp": "ts",
    "ground_speed": "value",
    "manually_marked_outlier": "case when event_id % 19 = 0 then true when event_id % 3 = 0 then false end",
    "visible": "case when event_id % 3 = 0 then null else true end",
    "tag_local_identifier": f"concat('T-', user_id * 8 + ({K}))",
    "individual_local_identifier": "case when event_id % 83 = 0 then 'unknown' else concat('Customer#', lpad(cast(user_id as varchar(20)), 9, '0')) end",
    "sensor_type": f"case when ({K}) < 3 then 'GPS' else 'acceleration' end",
}
COPIES = "d = 0 or (d = 1 and event_id % 10 = 3) or (d = 2 and event_id % 30 = 3)"
DEPLOYED_K = "k < 5 and not (k = 4 and c_custkey % 3 = 0) or (k = 5 and c_custkey % 101 = 3)"
SENSOR_K = "not (c_custkey % 89 = 7 and k = 1)"
EXTRA_SENSOR = "c_custkey % 97 = 5"


def columns(mapping: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in mapping.items())


# The same relations as SQL for DuckDB, in the order they build on each other.
SENSOR_TYPE_SQL = "select * from (values {}) t(id, name)".format(
    ", ".join(f"({number}, '{title}')" for _, number, _, title in SENSOR_TYPES)
)
RELATIONS = {
    "m_sensor_type": SENSOR_TYPE_SQL,
    "m_study": f"select {columns(STUDY)} from nation",
    "m_individual": f"select {columns(INDIVIDUAL)} from customer",
    "m_tag": f"select {columns(TAG)} from customer, (select unnest(range(0, 5)) as k)",
    "m_sensor": (
        f"select {columns(SENSOR)} from customer, (select unnest(range(0, 5)) as k) where {SENSOR_K} "
        f"union all select c_custkey * 16 + 1, cast(653 as bigint), c_custkey * 8, cast(c_nationkey as bigint) "
        f"from customer where {EXTRA_SENSOR}"
    ),
    # The sixth deployment of an individual repeats the tag of the third.
    "m_deployment": (
        "select deployment_id, local_identifier, individual_id, "
        "case when k = 5 then tag_id - 3 else tag_id end as tag_id, "
        "deploy_on_timestamp, deploy_off_timestamp, study_id from "
        f"(select {columns(DEPLOYMENT)}, k from customer, (select unnest(range(0, 6)) as k) where {DEPLOYED_K})"
    ),
    "m_raw": (
        f"select e.*, cast(c.c_nationkey as bigint) as study_id from (select {columns(RAW_EVENT)}, user_id "
        f"from events, (select unnest(range(0, 3)) as d) where {COPIES}) e left join customer c on e.user_id = c.c_custkey"
    ),
    "m_ui": (
        f"select e.*, cast(c.c_nationkey as bigint) as study_id from (select {columns(UI_EVENT)}, user_id from events) e "
        "left join customer c on e.user_id = c.c_custkey"
    ),
    "m_ship": f"select {columns(SHIP)} from lineitem, orders where l_orderkey = o_orderkey",
    "m_ship_deployment": f"select {columns(SHIP_DEPLOYMENT)} from orders",
}

# The expected cleaning of the fixes, stated once for the queries that check parts of it.
GROUP = "study_id, individual_id, tag_id, sensor_type_id"
RULE_SQL = {
    "visible": "coalesce(visible, true)",
    "position": "(lon is not null and not isnan(lon) and lat is not null and not isnan(lat))",
    "zero": "(lon <> 0 and lat <> 0)",
    "lon_range": "(lon >= -180 and lon <= 180)",
    "lat_range": "(lat >= -90 and lat <= 90)",
    "time": "timestamp is not null",
    "epoch": "timestamp <> timestamp '1970-01-01 00:00:00'",
    "future": f"timestamp < timestamp '{AS_OF}'",
    "status": "(eobs_status is null or eobs_status = 'A')",
}
BAD_SQL = "case " + " ".join(
    f"when not coalesce({sql}, false) then '{name}'" for name, sql in RULE_SQL.items()
) + " end"
DOUBLES = [
    "lon", "lat", "ground_speed", "gps_speed_accuracy_estimate", "gps_dop", "gps_hdop", "gps_vdop",
    "eobs_horizontal_accuracy_estimate", "gps_horizontal_accuracy_estimate",
    "location_error_numerical", "location_error_percentile", "gps_fix_type", "gps_satellite_count",
    "gps_time_to_fix", "eobs_type_of_fix", "eobs_used_time_to_get_fix",
]
OTHERS = [c for c in RAW_EVENT if c not in DOUBLES]
NUMVALS_SQL = " + ".join(
    [f"(case when {c} is not null and not isnan({c}) then 1 else 0 end)" for c in DOUBLES]
    + [f"(case when {c} is not null then 1 else 0 end)" for c in OTHERS]
)


def merged_sql(first: str, second: str) -> str:
    return f"case when {first} is not null and not isnan({first}) then {first} else {second} end"


FINAL_SQL = (
    "study_id, event_id, individual_id, lon, lat, timestamp, tag_id, sensor_type_id, "
    "case when isnan(ground_speed) then null else ground_speed end as ground_speed, "
    "gps_speed_accuracy_estimate, gps_dop, gps_hdop, gps_vdop, gps_satellite_count, "
    + merged_sql("eobs_horizontal_accuracy_estimate", "gps_horizontal_accuracy_estimate")
    + " as horizontal_accuracy, "
    + merged_sql("eobs_used_time_to_get_fix", "gps_time_to_fix")
    + " as time_to_fix, cast("
    + merged_sql("eobs_type_of_fix", "gps_fix_type")
    + " as integer) as fix_type"
)
# The same with the time as text, as results are compared.
FINAL_TEXT_SQL = FINAL_SQL.replace(", timestamp,", ", {{ts:timestamp}} as timestamp,")
INSIDE_SQL = (
    "(deploy_on_timestamp is null or timestamp >= deploy_on_timestamp) and "
    "(deploy_off_timestamp is null or timestamp < deploy_off_timestamp)"
)
RELATIONS.update(
    {
        "m_kept_individual": (
            "select * from m_individual where taxon_canonical_name is null "
            f"or lower(taxon_canonical_name) not like '%{EXCLUDED}%'"
        ),
        "m_kept_deployment": (
            "select * from m_deployment d where exists (select 1 from m_kept_individual i "
            "where i.individual_id = d.individual_id and i.study_id = d.study_id)"
        ),
        "m_kept_tag": (
            "select * from m_tag t where exists (select 1 from m_kept_deployment d "
            "where d.tag_id = t.tag_id and d.study_id = t.study_id)"
        ),
        "m_kept_sensor": (
            "select * from m_sensor s where exists (select 1 from m_kept_tag t "
            "where t.tag_id = s.tag_id and t.study_id = s.study_id)"
        ),
        "m_owner": (
            "select * from m_kept_individual i where exists (select 1 from m_kept_deployment d "
            "where d.individual_id = i.individual_id and d.study_id = i.study_id)"
        ),
        "m_good": f"select * from m_raw where ({BAD_SQL}) is null",
        "m_located": (
            "select e.*, d.deployment_id, d.deploy_on_timestamp, d.deploy_off_timestamp from m_good e "
            "join m_kept_deployment d on e.study_id = d.study_id and e.individual_id = d.individual_id "
            f"and e.tag_id = d.tag_id where {INSIDE_SQL}"
        ),
        "m_unique": (
            "select * from (select *, row_number() over (partition by "
            f"{GROUP}, date_trunc('second', timestamp) order by numvals desc, timestamp, event_id) as rn "
            f"from (select *, {NUMVALS_SQL} as numvals from m_located)) where rn = 1"
        ),
        "m_final": f"select {FINAL_SQL} from m_unique",
    }
)


# Customers that a task makes tags, sensors and deployments of.
PEOPLE_OF_TASK = 100_000
# Schemas of the driver's files, so that each file's footer is read for it once.
_SCHEMAS: dict[str, T.StructType] = {}


class Testbed:
    """Frames over one folder of driver tables."""

    __test__ = False  # not a test case, whatever its name

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A driver table, times without zone taken as UTC."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        for f in df.schema:
            if isinstance(f.dataType, T.TimestampNTZType):
                df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
        return df

    def mapped(self, df: DataFrame, mapping: dict[str, str], *extra: str) -> DataFrame:
        out = df.selectExpr(*[f"{sql} as {name}" for name, sql in mapping.items()], *extra)
        times = [f.name for f in out.schema if isinstance(f.dataType, T.TimestampNTZType)]
        return out.withColumns({n: F.col(n).cast("timestamp") for n in times}) if times else out

    @cached_property
    def _people(self):
        """Customers with a bounded number to a task, however large the pieces of their file, as each becomes several rows."""
        customers = self.table("customer")
        more = customers.count() // PEOPLE_OF_TASK
        return customers.repartition(more + 1, "c_custkey") if more else customers

    def numbered(self, df: DataFrame, name: str, count: int) -> DataFrame:
        return df.withColumn(name, F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(count)])))

    @cached_property
    def study(self):
        return self.mapped(self.table("nation"), STUDY)

    @cached_property
    def individual(self):
        return self.mapped(self.table("customer"), INDIVIDUAL)

    @cached_property
    def tag(self):
        return self.mapped(self.numbered(self._people, "k", 5), TAG)

    @cached_property
    def sensor(self):
        base = self.mapped(self.numbered(self._people, "k", 5).where(SENSOR_K), SENSOR)
        doubled = self.table("customer").where(EXTRA_SENSOR)
        extra = doubled.selectExpr(
            "c_custkey * 16 + 1 as sensor_id",
            "cast(653 as bigint) as sensor_type_id",
            "c_custkey * 8 as tag_id",
            "cast(c_nationkey as bigint) as study_id",
        )
        return base.unionByName(extra)

    @cached_property
    def deployment(self):
        rows = self.numbered(self._people, "k", 6).where(DEPLOYED_K)
        out = self.mapped(rows, DEPLOYMENT, "k")
        tag = F.when(F.col("k") == 5, F.col("tag_id") - 3).otherwise(F.col("tag_id"))
        return out.withColumn("tag_id", tag).drop("k")

    @cached_property
    def _owned(self):
        """Events with the study of their user, joined while they are narrow."""
        events = self.table("events").select("event_id", "ts", "user_id", "event_type", "value")
        owners = self.table("customer").selectExpr(
            "c_custkey as user_id", "cast(c_nationkey as bigint) as study_id"
        )
        return join_facts(events, owners, ["user_id"], "left")

    @cached_property
    def raw_event(self):
        """Raw events of the fixes, with the study of their file."""
        copies = self.numbered(self._owned, "d", 3).where(COPIES)
        return self.mapped(copies, RAW_EVENT, "study_id")

    @cached_property
    def ui_event(self):
        return self.mapped(self._owned, UI_EVENT, "study_id")

    @cached_property
    def ship(self):
        """Events from lineitem; their individual comes from the order."""
        orders = self.table("orders").selectExpr("o_orderkey as l_orderkey", "o_custkey")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
        )
        return self.mapped(join_facts(lines, orders, ["l_orderkey"]), SHIP)

    @cached_property
    def ship_deployment(self):
        return self.mapped(self.table("orders"), SHIP_DEPLOYMENT)

    @cached_property
    def sensor_types(self):
        return sensor_types(self.spark)

    @cached_property
    def raw(self):
        """The six raw tables of the fixes."""
        return {
            "study": self.study,
            "individual": self.individual,
            "tag": self.tag,
            "sensor": self.sensor,
            "deployment": self.deployment,
            "event": self.raw_event,
        }

    @cached_property
    def ships(self):
        """The six tables with the ships as events."""
        orders = self.table("orders")
        tag = orders.selectExpr("o_orderkey as tag_id", "o_orderpriority as manufacturer_name")
        sensor = orders.selectExpr(
            "o_orderkey as sensor_id", "cast(653 as bigint) as sensor_type_id", "o_orderkey as tag_id"
        )
        return {
            "study": self.study,
            "individual": self.individual,
            "tag": tag,
            "sensor": sensor,
            "deployment": self.ship_deployment,
            "event": self.ship,
        }

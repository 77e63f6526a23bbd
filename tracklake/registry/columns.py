"""Column rules and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions import times, values
from tracklake.operators import relate, repair, reports, shape
from tracklake.operators.filters import event_rules, keep_valid
from tracklake.registry.base import query
from tracklake.registry.filters import EPOCH_TEXT_SQL, epoch_texts
from tracklake.registry.mapping import AS_OF, FINAL_TEXT_SQL, Testbed

# --- B: columns ---


@query("B1", "select c_custkey as individual_id, c_name as local_identifier, concat('S', c_nationkey) as sex from customer")
def renamed_individuals(t: Testbed):
    raw = t.table("customer").selectExpr("c_custkey as id", "c_name as local_identifier", "concat('S', c_nationkey) as sex")
    return shape.rename_raw(raw, "individual")


@query(
    "B2 B3 B5",
    f"select {FINAL_TEXT_SQL} from m_good",
)
def final_events(t: Testbed):
    raw = shape.rename_position(t.raw_event.withColumnsRenamed({"lon": "location_long", "lat": "location_lat"}))
    out = shape.final_event_columns(shape.merge_vendor_columns(keep_valid(raw, event_rules(AS_OF))))
    speed = F.when(values.present(out, "ground_speed"), F.col("ground_speed"))
    return out.withColumn("ground_speed", speed)


@query("B4", "select tag_id, local_identifier, manufacturer_name, study_id from m_tag")
def dictionary_columns(t: Testbed):
    wide = t.tag.withColumn("not_in_dictionary", F.lit(1))
    return shape.dictionary_columns(wide, "tag")


@query(
    "B6",
    "select event_id, tag_local_identifier, individual_local_identifier, sensor_type from m_ui",
)
def normalised_headers(t: Testbed):
    ui = t.ui_event.select("event_id", "tag_local_identifier", "individual_local_identifier", "sensor_type")
    export = ui.toDF(*[c.replace("_", "-") for c in ui.columns])
    return shape.normalise_headers(export)


@query("B7", "select tag_id, manufacturer_name, study_id, local_identifier from m_tag")
def column_last(t: Testbed):
    return shape.column_last(t.tag, "local_identifier")


@query("B8", "select event_id, cast(653 as bigint) as sensor_type_id from events")
def constant_sensor_type(t: Testbed):
    df = shape.with_constant(t.table("events").select("event_id"), "sensor_type_id", 653)
    return df.withColumn("sensor_type_id", F.col("sensor_type_id").cast("bigint"))


@query(
    "B9 H1",
    "select event_id, strftime(timestamp + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g') as timestamp from m_raw",
)
def times_as_text(t: Testbed):
    return shape.map_columns(t.raw_event.select("event_id", "timestamp"), T.TimestampType, times.millis_text)


@query("B10", "select event_id, user_id, event_type from events")
def without_columns(t: Testbed):
    return shape.without_columns(t.table("events"), "ts", "value", "props")


@query("B11", "select event_id, i.study_id from m_raw r left join m_individual i on r.individual_id = i.individual_id")
def filled_study(t: Testbed):
    events = t.raw_event.select("event_id", "individual_id")
    return relate.fill_study(events, t.individual).select("event_id", "study_id")


@query(
    "B12",
    "select event_id, case when event_id % 2 = 0 then 3 end as fix_type, cast(null as double) as gps_dop from events",
)
def added_columns(t: Testbed):
    """Old rows lack the newer columns; they are added empty before the union."""
    events = t.table("events")
    old = events.where("event_id % 2 = 1").select("event_id")
    new = events.where("event_id % 2 = 0").select("event_id", F.lit(3).alias("fix_type"))
    old = shape.add_missing_columns(old, {"gps_dop": "double"})
    return shape.union_by_name(old, new).select("event_id", "fix_type", "gps_dop")


@query(
    "B13",
    "select study_id, event_id, individual_id, tag_id, {{ts:timestamp}} as timestamp from m_raw where individual_id is null",
)
def events_without_owner(t: Testbed):
    lost = t.raw_event.where(F.col("individual_id").isNull())
    return lost.select("study_id", "event_id", "individual_id", "tag_id", "timestamp")


# --- H: functions ---


@query(
    "H2",
    "select event_id, case when event_id % 5 = 4 then null when event_id % 5 in (1, 2) then "
    "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') else "
    "strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') end as parsed from events",
)
def parsed_times(t: Testbed):
    """Text in all known forms: blank or T, with or without milliseconds, or junk."""
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.unix_timestamp("ts").cast("string"))
    )
    return t.table("events").select("event_id", times.parse_time(text).alias("parsed"))


@query(
    "H3",
    "select event_id, case when event_id % 3 = 2 then 'NA' else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as t from events",
)
def repaired_epoch_times(t: Testbed):
    return repair.epoch_text(epoch_texts(t), ["t"])


@query(
    "H4 H5 H6 H7 H8 H16",
    "select event_id, {{ts:date_trunc('second', ts)}} as sec, strftime(ts, '%Y') as year, "
    "cast(cast(ts as date) as varchar) as date, strftime(ts, '%Y-%m-%d %H:%M:%S') as sec_text, "
    "right(strftime(ts + interval 500 microseconds, '%Y-%m-%d %H:%M:%S.%g'), 4) as millis, "
    "(epoch_us(ts) - epoch_us(date_trunc('second', ts))) / 1000.0e0 as millis_in from events",
)
def time_parts(t: Testbed):
    ts = F.col("ts")
    second = times.to_unit(ts, "second")
    return t.table("events").select(
        "event_id",
        second.alias("sec"),
        times.year_text(ts).alias("year"),
        times.day(ts).alias("date"),
        times.second_text(ts).alias("sec_text"),
        times.millis_suffix(times.millis_text(ts)).alias("millis"),
        times.millis_between(second, ts).alias("millis_in"),
    )


TIDY_SQL = r"regexp_replace(regexp_replace({c}, '[\r\n]', ' ', 'g'), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g')"


@query("H9 B9", f"select doc_id, md5({TIDY_SQL.format(c='text')}) as text_md5, length({TIDY_SQL.format(c='text')}) as n from documents")
def tidy_documents(t: Testbed):
    """Whole texts without line breaks; compared by hash to keep the result small."""
    docs = repair.tidy_text(t.table("documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n"))


@query("H10", "select doc_id from documents where lower(text) like '%the%'")
def documents_with_word(t: Testbed):
    return t.table("documents").where(values.contains_ignoring_case(F.col("text"), "The")).select("doc_id")


@query(
    "H11 B5",
    "select event_id, case when eobs_used_time_to_get_fix is not null then eobs_used_time_to_get_fix else gps_time_to_fix end as time_to_fix, "
    "case when visible is null then 'unknown' when visible then 'yes' else 'no' end as seen from m_raw",
)
def chosen_values(t: Testbed):
    raw = t.raw_event
    seen = F.when(F.col("visible").isNull(), "unknown").when(F.col("visible"), "yes").otherwise("no")
    fix = values.first_present(raw, "eobs_used_time_to_get_fix", "gps_time_to_fix")
    return raw.select("event_id", fix.alias("time_to_fix"), seen.alias("seen"))


LOGICAL_SQL = (
    "select event_id, case when event_id % 3 = 0 then 'TRUE' when event_id % 3 = 1 then 'FALSE' else event_type end as a, "
    "case when event_id % 4 = 0 then 'TRUE' else 'true' end as b from events"
)


def logical_table(t: Testbed):
    return t.table("events").selectExpr(
        "event_id",
        "case when event_id % 3 = 0 then 'TRUE' when event_id % 3 = 1 then 'FALSE' else event_type end as a",
        "case when event_id % 4 = 0 then 'TRUE' else 'true' end as b",
    )


@query(
    "H12",
    "select event_id, case a when 'TRUE' then '1' when 'FALSE' then '0' else a end as a, "
    f"case b when 'TRUE' then '1' when 'FALSE' then '0' else b end as b from ({LOGICAL_SQL})",
)
def logical_text(t: Testbed):
    return repair.logical_text(logical_table(t))


@query(
    "H12",
    f"select 'a' as column_name, count(*) filter (where a in ('TRUE', 'FALSE')) as num_rows from ({LOGICAL_SQL}) "
    f"union all select 'b', count(*) filter (where b in ('TRUE', 'FALSE')) from ({LOGICAL_SQL})",
)
def logical_text_report(t: Testbed):
    return repair.logical_text_report(logical_table(t))


NULLS_SQL = (
    "select event_id, case when event_id % 4 = 0 then 'NA' else event_type end as a, "
    "case when event_id % 5 = 0 then ' na ' when event_id % 5 = 1 then 'NA' else 'nab' end as b from events"
)


def null_table(t: Testbed):
    return t.table("events").selectExpr(
        "event_id",
        "case when event_id % 4 = 0 then 'NA' else event_type end as a",
        "case when event_id % 5 = 0 then ' na ' when event_id % 5 = 1 then 'NA' else 'nab' end as b",
    )


@query("H13", f"select event_id, nullif(a, 'NA') as a, nullif(b, 'NA') as b from ({NULLS_SQL})")
def null_text(t: Testbed):
    return repair.null_text(null_table(t))


@query(
    "H13",
    f"select 'a' as column_name, count(*) filter (where a = 'NA') as num_rows from ({NULLS_SQL}) "
    f"union all select 'b', count(*) filter (where b = 'NA') from ({NULLS_SQL})",
)
def null_text_report(t: Testbed):
    return repair.null_text_report(null_table(t))


@query(
    "H14",
    f"select event_id, nullif(a, 'NA') as a, case when upper(trim(b)) = 'NA' then null else b end as b from ({NULLS_SQL})",
)
def null_text_loosely(t: Testbed):
    return repair.null_text(null_table(t), loosely=True)


@query("H15", "select c_custkey, round_even(cast(c_custkey as double) / 8, 2) as r from customer")
def rounded_even(t: Testbed):
    return t.table("customer").select(
        "c_custkey", values.round_even(F.col("c_custkey").cast("double") / 8, 2).alias("r")
    )


@query(
    "C16",
    "select individual_id, {{ts:timestamp}} as timestamp, cast(epoch_us(timestamp) % 1000000 // 1000 as integer) as millis from m_raw "
    "where epoch_us(timestamp) % 1000000 // 1000 not in (0, 1, 999)",
)
def unusual_millis(t: Testbed):
    return reports.unusual_millis(t.raw_event)



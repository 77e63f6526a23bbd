"""The data model: field dictionary, table schemas and lookup values."""

import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Parents first: the order in which tables are filled.
ENTITIES = ("tag", "study", "sensor", "individual", "deployment", "event")

PRIMARY_KEY = {
    "study": "study_id",
    "individual": "individual_id",
    "tag": "tag_id",
    "sensor": "sensor_id",
    "deployment": "deployment_id",
    "event": "event_id",
}

# child entity, column, parent entity
FOREIGN_KEYS = (
    ("sensor", "tag_id", "tag"),
    ("individual", "study_id", "study"),
    ("deployment", "tag_id", "tag"),
    ("deployment", "individual_id", "individual"),
    ("event", "tag_id", "tag"),
    ("event", "study_id", "study"),
    ("event", "individual_id", "individual"),
)

# --- Fixed values: the field dictionary --------------------------------------------------
# table, raw name, raw type, clean name, clean type. Types: c text, d number, i whole number,
# l logical, T time. A blank clean name means the field ends with cleaning; a blank raw name
# means the field is derived.
FIELD_DICTIONARY = """\
table,name_raw,type_raw,name_clean,type_clean
study,id,i,study_id,i
study,name,c,study_name,c
study,principal_investigator_name,c,principal_investigator_name,c
study,principal_investigator_email,c,principal_investigator_email,c
study,principal_investigator_address,c,principal_investigator_address,c
study,main_location_long,d,main_location_long,d
study,main_location_lat,d,main_location_lat,d
study,acknowledgements,c,acknowledgements,c
study,citation,c,citation,c
study,grants_used,c,grants_used,c
study,has_quota,l,has_quota,l
study,i_am_owner,l,i_am_owner,l
study,license_terms,c,license_terms,c
study,number_of_deployments,i,number_of_deployments,i
study,number_of_individuals,i,number_of_individuals,i
study,number_of_tags,i,number_of_tags,i
study,study_objective,c,study_objective,c
study,study_type,c,study_type,c
study,suspend_license_terms,l,suspend_license_terms,l
study,i_can_see_data,l,i_can_see_data,l
study,there_are_data_which_i_cannot_see,l,there_are_data_which_i_cannot_see,l
study,timestamp_first_deployed_location,T,timestamp_first_deployed_location,T
study,timestamp_last_deployed_location,T,timestamp_last_deployed_location,T
study,number_of_deployed_locations,i,number_of_deployed_locations,i
study,taxon_ids,c,taxon_ids,c
study,sensor_type_ids,c,sensor_type_ids,c
individual,id,i,individual_id,i
individual,local_identifier,c,local_identifier,c
individual,nick_name,c,nick_name,c
individual,study_id,i,study_id,i
individual,ring_id,c,ring_id,c
individual,sex,c,sex,c
individual,taxon_id,i,taxon_id,i
individual,taxon_canonical_name,c,taxon_canonical_name,c
individual,access_profile_id,i,access_profile_id,i
individual,default_profile_eventdata_id,i,default_profile_eventdata_id,i
individual,earliest_date_born,T,earliest_date_born,T
individual,latest_date_born,T,latest_date_born,T
individual,exact_date_of_birth,T,exact_date_of_birth,T
individual,external_id,i,external_id,i
individual,external_id_namespace_id,i,external_id_namespace_id,i
individual,i_am_owner,l,i_am_owner,l
individual,death_comments,c,death_comments,c
individual,comments,c,comments,c
tag,id,i,tag_id,i
tag,local_identifier,c,local_identifier,c
tag,manufacturer_name,c,manufacturer_name,c
tag,beacon_frequency,d,beacon_frequency,d
tag,model,c,model,c
tag,processing_type,c,processing_type,c
tag,serial_no,c,serial_no,c
tag,tag_failure_comments,c,tag_failure_comments,c
tag,tag_production_date,c,tag_production_date,c
tag,weight,d,weight,d
tag,comments,c,comments,c
deployment,id,i,deployment_id,i
deployment,local_identifier,c,local_identifier,c
deployment,individual_id,i,individual_id,i
deployment,tag_id,i,tag_id,i
deployment,deploy_on_timestamp,T,deploy_on_timestamp,T
deployment,deploy_off_timestamp,T,deploy_off_timestamp,T
event,event_id,i,event_id,i
event,individual_id,i,individual_id,i
event,location_long,d,lon,d
event,location_lat,d,lat,d
event,timestamp,T,timestamp,T
event,sensor_type_id,i,sensor_type_id,i
event,tag_id,i,tag_id,i
event,ground_speed,d,ground_speed,d
event,gps_speed_accuracy_estimate,d,gps_speed_accuracy_estimate,d
event,visible,l,,
event,gps_dop,d,gps_dop,d
event,gps_hdop,d,gps_hdop,d
event,gps_vdop,d,gps_vdop,d
event,eobs_horizontal_accuracy_estimate,d,,
event,gps_horizontal_accuracy_estimate,d,,
event,location_error_numerical,d,,
event,location_error_percentile,d,,
event,location_error_text,c,,
event,gps_fix_type,d,,
event,gps_satellite_count,d,gps_satellite_count,d
event,gps_time_to_fix,d,,
event,eobs_type_of_fix,d,,
event,eobs_used_time_to_get_fix,d,,
event,eobs_status,c,,
event,,,horizontal_accuracy,d
event,,,time_to_fix,d
event,,,fix_type,i
sensor,id,i,sensor_id,i
sensor,sensor_type_id,i,sensor_type_id,i
sensor,tag_id,i,tag_id,i
"""

# The event columns after cleaning, in table order.
CLEAN_EVENT_COLUMNS = (
    "event_id", "individual_id", "lon", "lat", "timestamp", "tag_id", "sensor_type_id",
    "ground_speed", "gps_speed_accuracy_estimate", "gps_dop", "gps_hdop", "gps_vdop",
    "gps_satellite_count", "horizontal_accuracy", "time_to_fix", "fix_type",
)

# Sensor types: external id, id, records locations, name.
SENSOR_TYPES = (
    ("bird-ring", 397, True, "Bird Ring"),
    ("gps", 653, True, "GPS"),
    ("radio-transmitter", 673, True, "Radio Transmitter"),
    ("argos-doppler-shift", 82798, True, "Argos Doppler Shift"),
    ("natural-mark", 2365682, True, "Natural Mark"),
    ("acceleration", 2365683, False, "Acceleration"),
    ("solar-geolocator", 3886361, True, "Solar Geolocator"),
    ("accessory-measurements", 7842954, False, "Accessory Measurements"),
    ("solar-geolocator-raw", 9301403, False, "Solar Geolocator Raw"),
    ("barometer", 77740391, False, "Barometer"),
    ("magnetometer", 77740402, False, "Magnetometer"),
)
GPS_SENSOR_TYPE = 653
# --- End of fixed values -----------------------------------------------------------------

SENSOR_TYPE_SCHEMA = "external_id string, id bigint, is_location_sensor boolean, name string"
STATUS_SCHEMA = "study_id bigint, step string, result string"
EVENT_STATS_SCHEMA = (
    "individual_id bigint, ts_min timestamp, ts_max timestamp, lon_min double, lon_max double, "
    "lon_mean double, lat_min double, lat_max double, lat_mean double"
)

SPARK_TYPES = {
    "c": T.StringType(),
    "d": T.DoubleType(),
    "i": T.LongType(),
    "l": T.BooleanType(),
    "T": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    entity: str
    raw: str
    raw_type: str
    clean: str
    clean_type: str


def parse_dictionary(lines) -> list[Field]:
    """Fields from dictionary lines in CSV form."""
    return [
        Field(r["table"], r["name_raw"], r["type_raw"], r["name_clean"], r["type_clean"])
        for r in csv.DictReader(lines)
    ]


def read_dictionary(path: str) -> list[Field]:
    """A field dictionary from a file; a byte-order mark and CRLF line ends are fine."""
    with open(path, encoding="utf-8-sig", newline="") as lines:
        return parse_dictionary(lines)


FIELDS = parse_dictionary(FIELD_DICTIONARY.splitlines())


def raw_fields(entity: str, fields: list[Field] = FIELDS) -> list[Field]:
    return [f for f in fields if f.entity == entity and f.raw]


def raw_schema(entity: str, fields: list[Field] = FIELDS) -> T.StructType:
    """Types of the raw columns, under their raw names."""
    return T.StructType(
        [T.StructField(f.raw, SPARK_TYPES[f.raw_type or "c"]) for f in raw_fields(entity, fields)]
    )


def clean_names(entity: str, fields: list[Field] = FIELDS) -> dict[str, str]:
    """Raw name to clean name, for the fields that survive cleaning."""
    return {f.raw: f.clean for f in raw_fields(entity, fields) if f.clean}


def table_schema(entity: str, fields: list[Field] = FIELDS) -> T.StructType:
    """Columns of a clean table. Every table also holds the study its rows came with."""
    by_name = {
        f.clean: T.StructField(f.clean, SPARK_TYPES[f.clean_type or "c"])
        for f in fields
        if f.entity == entity and f.clean
    }
    if entity == "event":
        by_name = {n: by_name[n] for n in CLEAN_EVENT_COLUMNS}
        by_name["fix_type"] = T.StructField("fix_type", T.IntegerType())
    by_name.setdefault("study_id", T.StructField("study_id", T.LongType()))
    return T.StructType(list(by_name.values()))


def empty_table(spark: SparkSession, entity: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(entity))


def empty_event_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EVENT_STATS_SCHEMA)


def sensor_types(spark: SparkSession) -> DataFrame:
    """The sensor type lookup, eleven rows."""
    return spark.createDataFrame(list(SENSOR_TYPES), SENSOR_TYPE_SCHEMA)

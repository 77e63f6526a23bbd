"""Raw CSV files of three small studies, written as they are downloaded."""

from pathlib import Path

HEADERS = {
    "study": "id,name,principal_investigator_name,principal_investigator_email,principal_investigator_address,"
    "main_location_long,main_location_lat,acknowledgements,citation,grants_used,has_quota,i_am_owner,license_terms,"
    "number_of_deployments,number_of_individuals,number_of_tags,study_objective,study_type,suspend_license_terms,"
    "i_can_see_data,there_are_data_which_i_cannot_see,timestamp_first_deployed_location,"
    "timestamp_last_deployed_location,number_of_deployed_locations,taxon_ids,sensor_type_ids",
    "individual": "id,local_identifier,nick_name,study_id,ring_id,sex,taxon_id,taxon_canonical_name,access_profile_id,"
    "default_profile_eventdata_id,earliest_date_born,latest_date_born,exact_date_of_birth,external_id,"
    "external_id_namespace_id,i_am_owner,death_comments,comments",
    "tag": "id,local_identifier,manufacturer_name,beacon_frequency,model,processing_type,serial_no,"
    "tag_failure_comments,tag_production_date,weight,comments",
    "deployment": "id,local_identifier,individual_id,tag_id,deploy_on_timestamp,deploy_off_timestamp",
    "sensor": "id,sensor_type_id,tag_id",
    "event": "event_id,individual_id,location_long,location_lat,timestamp,sensor_type_id,tag_id,ground_speed,"
    "gps_speed_accuracy_estimate,visible,gps_dop,gps_hdop,gps_vdop,eobs_horizontal_accuracy_estimate,"
    "gps_horizontal_accuracy_estimate,location_error_numerical,location_error_percentile,location_error_text,"
    "gps_fix_type,gps_satellite_count,gps_time_to_fix,eobs_type_of_fix,eobs_used_time_to_get_fix,eobs_status",
}


def line(entity: str, **values) -> str:
    names = HEADERS[entity].split(",")
    unknown = set(values) - set(names)
    assert not unknown, unknown
    return ",".join(str(values.get(n, "")) for n in names)


def event(event_id, individual_id, tag_id, timestamp, lon=10.5, lat=20.25, **more) -> str:
    return line(
        "event", event_id=event_id, individual_id=individual_id, tag_id=tag_id, timestamp=timestamp,
        location_long=lon, location_lat=lat, sensor_type_id=more.pop("sensor_type_id", 653), **more,
    )


def study(base: int, events: list[str], extra: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Two animals with a tag each, a human, and a tag nobody wears. Ids start at base."""
    files = {
        "study": [
            line("study", id=base, name='"Storks, ""white"" ones"', has_quota="TRUE", i_am_owner="false",
                 number_of_individuals=2, number_of_deployments=2, number_of_deployed_locations=len(events),
                 timestamp_first_deployed_location="2020-01-01 00:00:00.000", citation='"two\nlines"')
        ],
        "individual": [
            line("individual", id=base + 1, local_identifier="one", study_id=base,
                 taxon_canonical_name="Ciconia ciconia", comments='" blank at the start"', nick_name='""'),
            line("individual", id=base + 2, local_identifier="two", study_id=base, taxon_canonical_name="NA"),
            line("individual", id=base + 3, local_identifier="me", study_id=base, taxon_canonical_name="Homo SAPIENS"),
            line("individual", id=base + 4, local_identifier="spare", study_id=base),
        ],
        "tag": [
            line("tag", id=base + 11, local_identifier="007", serial_no="0012", manufacturer_name="eobs", weight="1.5"),
            line("tag", id=base + 12, local_identifier="T2", manufacturer_name="NA"),
            line("tag", id=base + 13, local_identifier="T3"),
            line("tag", id=base + 14, local_identifier="T4"),
        ],
        "sensor": [
            line("sensor", id=base + 21, sensor_type_id=653, tag_id=base + 11),
            line("sensor", id=base + 22, sensor_type_id=653, tag_id=base + 12),
            line("sensor", id=base + 23, sensor_type_id=653, tag_id=base + 13),
            line("sensor", id=base + 24, sensor_type_id=653, tag_id=base + 14),
        ],
        "deployment": [
            line("deployment", id=base + 31, individual_id=base + 1, tag_id=base + 11,
                 deploy_on_timestamp="2020-01-01 00:00:00.000", deploy_off_timestamp="2020-02-01T00:00:00Z"),
            line("deployment", id=base + 32, individual_id=base + 2, tag_id=base + 12),
            line("deployment", id=base + 33, individual_id=base + 3, tag_id=base + 13),
        ],
        "event": events,
    }
    for entity, lines in (extra or {}).items():
        files[entity] = files[entity] + lines
    return files


def write(root: Path, studies: dict[int, dict[str, list[str]]], newline: str = "\n") -> str:
    for study_id, files in studies.items():
        folder = root / str(study_id) / "raw"
        folder.mkdir(parents=True)
        for entity, lines in files.items():
            text = newline.join([HEADERS[entity], *lines]) + newline
            (folder / f"{entity}.csv").write_text(text, newline="")
    return str(root)


def good_events(base: int) -> list[str]:
    a, b = (base + 1, base + 11), (base + 2, base + 12)
    return [
        event(base * 100 + 1, *a, "2020-01-05 10:00:00.000"),
        # the same second, fuller: replaces the first
        event(base * 100 + 2, *a, "2020-01-05 10:00:00.001", ground_speed="1.07",
              eobs_horizontal_accuracy_estimate="36.61", eobs_used_time_to_get_fix="60", eobs_type_of_fix="3",
              eobs_status="A"),
        event(base * 100 + 3, *a, "2020-02-01 00:00:00.000"),  # at the end of the deployment
        event(base * 100 + 4, *b, "2020-03-01 10:00:00", gps_horizontal_accuracy_estimate="5",
              eobs_horizontal_accuracy_estimate="NaN"),
        event(base * 100 + 5, *b, "2020-03-01 11:00:00", visible="FALSE"),
        event(base * 100 + 6, *b, "2020-03-01 12:00:00", lon=0),
        event(base * 100 + 7, base + 3, base + 13, "2020-03-01 12:00:00"),  # the human
        event(base * 100 + 8, "NA", base + 12, "2020-03-01 13:00:00"),
        event(base * 100 + 9, *b, "2020-03-01T14:00:00.500Z"),
    ]


def three_studies() -> dict[int, dict[str, list[str]]]:
    """The first two are fine; the third has a tag with a doubled sensor."""
    doubled = [line("sensor", id=3029, sensor_type_id=653, tag_id=3012)]
    return {
        1000: study(1000, good_events(1000)),
        2000: study(2000, good_events(2000)),
        3000: study(3000, good_events(3000), {"sensor": doubled}),
    }

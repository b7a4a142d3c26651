"""Literal bronze rows."""

import json
from datetime import date

from pyspark.sql import types as T

from skyledger.session import literal_rows

NEO_COLUMNS = (
    "event_id LONG, neo_id STRING, neo_reference_id STRING, neo_name STRING, "
    "is_potentially_hazardous_asteroid BOOLEAN, absolute_magnitude_h DOUBLE, "
    "estimated_diameter STRING, close_approach_date DATE, close_approach_date_full STRING, "
    "epoch_date_close_approach LONG, relative_velocity STRING, miss_distance STRING, "
    "orbiting_body STRING, raw_neo STRING"
)


def event(event_id, neo_id, full="2025-Jan-03 12:34", body="Earth", **changes):
    row = {
        "event_id": event_id,
        "neo_id": neo_id,
        "neo_reference_id": neo_id,
        "neo_name": f"name {neo_id}",
        "is_potentially_hazardous_asteroid": False,
        "absolute_magnitude_h": 20.0,
        "estimated_diameter": json.dumps(
            {"kilometers": {"estimated_diameter_min": 0.1, "estimated_diameter_max": 0.25}}
        ),
        "close_approach_date": date(2025, 1, 3),
        "close_approach_date_full": full,
        "epoch_date_close_approach": 1735907640000,
        "relative_velocity": json.dumps(
            {
                "kilometers_per_second": "12.5",
                "kilometers_per_hour": "45000",
                "miles_per_hour": "27961.7",
            }
        ),
        "miss_distance": json.dumps(
            {"astronomical": "0.05", "lunar": "19.5", "kilometers": "7480000", "miles": "4647855"}
        ),
        "orbiting_body": body,
        "raw_neo": json.dumps({"id": neo_id}),
    }
    row.update(changes)
    return tuple(row.values())


def neo_frame(spark, *events):
    return literal_rows(spark, T.StructType.fromDDL(NEO_COLUMNS), events)


SATCAT_COLUMNS = (
    "id LONG, snapshot_group STRING, snapshot_date DATE, raw_csv_row STRING, parsed_record STRING"
)


def record(id_, norad="25544", day=date(2025, 1, 3), group="active", **changes):
    fields = {
        "NORAD_CAT_ID": norad,
        "OBJECT_ID": "1998-067A",
        "OBJECT_NAME": f"sat {norad}",
        "OBJECT_TYPE": "PAY",
        "OWNER": "US",
        "OPS_STATUS_CODE": "+",
        "LAUNCH_DATE": "1998-11-20",
        "LAUNCH_SITE": "TYMSC",
        "DECAY_DATE": "",
        "ORBIT_CENTER": "EA",
        "ORBIT_TYPE": "ORB",
        "RCS": "399.05",
        "PERIOD": "92.9",
        "INCLINATION": "51.6",
        "APOGEE": "420",
        "PERIGEE": "410",
    }
    fields.update(changes)
    return (id_, group, day, "raw", json.dumps(fields))


def satcat_frame(spark, *records):
    return literal_rows(spark, T.StructType.fromDDL(SATCAT_COLUMNS), records)


def dicts(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]

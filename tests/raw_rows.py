"""Raw rows for tests."""

import datetime as dt

from transitlens.schemas import RAW_WITH_TIE

TS = dt.datetime(2024, 1, 1, 12, 0, 0)


def raw_row(vehicle="v1", line="x", loc=None, t=60, ts=TS, naptan="A1", event_id=1, **kw):
    """A RAW_ARRIVALS row (+ event_id) with defaults for the columns a test ignores."""
    row = {
        "vehicle_id": vehicle, "line_id": line, "line_name": kw.get("line_name", line.upper()),
        "station_naptan_id": naptan, "station_name": "next", "platform_name": "p",
        "direction": "inbound", "destination_name": "dest", "destination_naptan_id": "D",
        "current_location": loc, "towards": "tw", "time_to_station": t,
        "expected_arrival": None, "timestamp_utc": ts, "ingestion_id": "b1", "event_id": event_id,
    }
    return tuple(row[f.name] for f in RAW_WITH_TIE.fields)


def make_raw(spark, rows):
    return spark.createDataFrame(rows, RAW_WITH_TIE)

"""Landing records, flatten with defaults, rejects, report, by-name append."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from transitlens.schemas import RAW_COLUMNS
from transitlens.sources import ingest as I

FULL = {"id": "11", "vehicleId": "201", "lineId": "victoria", "lineName": "Victoria",
        "naptanId": "940G1", "stationName": "Oval", "platformName": "Northbound - Platform 1",
        "direction": "inbound", "destinationName": "Walthamstow", "destinationNaptanId": "940G9",
        "currentLocation": "At Oval", "towards": "Walthamstow", "timeToStation": 65,
        "expectedArrival": "2024-01-01T12:01:05Z", "timing": {"source": "x"}}


def _payloads(spark, bodies):
    rows = [("run-1", "2024-01-01T12:00:00", f"l{i}", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, I.LANDING_SCHEMA)


def _run(spark, bodies, **kw):
    good, rejected = I.raw_from_payloads(_payloads(spark, bodies), **kw)
    return good.collect(), rejected.collect()


def _flat(spark, bodies):
    return I.flatten_predictions(I.explode_predictions(_payloads(spark, bodies)))


def test_text_after_the_body_and_null_elements(spark):
    good, rej = _run(spark, [json.dumps([FULL]) + " junk", json.dumps([FULL]) + ",[]", json.dumps([None, FULL])])
    assert len(good) == 1
    assert sorted((r.line_id, r.reject_reason) for r in rej) == [
        ("l0", "unparseable payload"), ("l1", "unparseable payload"), ("l2", "prediction is not an object")]


def test_report_parses_once(spark):
    plan = I.ingest_report(_flat(spark, [json.dumps([FULL])]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_full_object(spark):
    good, rej = _run(spark, [json.dumps([FULL])])
    assert not rej and len(good) == 1
    r = good[0]
    assert (r.vehicle_id, r.line_id, r.current_location, r.time_to_station) == ("201", "victoria", "At Oval", 65)
    assert r.expected_arrival == dt.datetime(2024, 1, 1, 12, 1, 5)
    assert r.timestamp_utc == dt.datetime(2024, 1, 1, 12, 0, 0) and r.ingestion_id == "run-1"
    assert r.event_id == 11 and list(good[0].asDict())[:15] == RAW_COLUMNS


def test_missing_keys_default_and_null_stays_null(spark):
    missing = {k: v for k, v in FULL.items() if k not in ("vehicleId", "timeToStation", "expectedArrival")}
    nulls = dict(FULL, vehicleId=None, timeToStation=None, currentLocation=None, expectedArrival=None)
    good, rej = _run(spark, [json.dumps([missing, nulls])])
    assert not rej
    by_loc = {r.current_location: r for r in good}
    m, n = by_loc["At Oval"], by_loc[None]
    assert (m.vehicle_id, m.time_to_station, m.expected_arrival) == ("", 0, None)
    assert (n.vehicle_id, n.time_to_station, n.expected_arrival) == (None, None, None)


def test_empty_expected_arrival_is_null(spark):
    good, _ = _run(spark, [json.dumps([dict(FULL, expectedArrival="")])])
    assert good[0].expected_arrival is None


def test_text_time_is_rejected_others_go_on(spark):
    good, rej = _run(spark, [json.dumps([dict(FULL, timeToStation="soon"), FULL])])
    assert len(good) == 1 and len(rej) == 1
    assert rej[0].reject_reason == "timeToStation is not an integer"


def test_broken_payload_rejected_other_payloads_load(spark):
    good, rej = _run(spark, ["[{broken", json.dumps([FULL, FULL]), "[]"])
    assert len(good) == 2 and len(rej) == 1 and rej[0].reject_reason == "unparseable payload"


def test_empty_array_gives_nothing(spark):
    good, rej = _run(spark, ["[]"])
    assert good == [] and rej == []


def test_run_stamp_literals(spark):
    good, _ = _run(spark, [json.dumps([FULL, FULL])], ingestion_id="u-1",
                   timestamp_utc=dt.datetime(2024, 5, 1, 8, 0, 0))
    assert {(r.ingestion_id, r.timestamp_utc) for r in good} == {("u-1", dt.datetime(2024, 5, 1, 8, 0, 0))}


def test_report_and_strict_mode(spark):
    rep = I.ingest_report(_flat(spark, [json.dumps([FULL, dict(FULL, timeToStation="x")])]))
    assert [(r.rows_inserted, r.rows_errored, r.payloads_skipped) for r in rep.collect()] == [(1, 1, 0)]
    with pytest.raises(RuntimeError):
        I.check_report(rep)
    assert I.check_report(rep, strict=False) == {"rows_inserted": 1, "rows_errored": 1, "payloads_skipped": 0}


def test_failed_payload_is_skipped_not_an_error(spark):
    rep = I.ingest_report(_flat(spark, ["[{broken", None, json.dumps([FULL])]))
    assert I.check_report(rep) == {"rows_inserted": 1, "rows_errored": 0, "payloads_skipped": 2}


def test_append_by_name_ignores_case_and_order(spark, tmp_path):
    good, _ = I.raw_from_payloads(_payloads(spark, [json.dumps([FULL])]))
    odd = good.select(*[F.col(c).alias(c.upper()) for c in reversed(good.columns)])
    path = str(tmp_path / "raw")
    I.append_raw(odd, path)
    I.append_raw(odd.drop("TOWARDS"), path)
    back = I.read_raw(spark, path)
    assert back.count() == 2
    # A column the input lacks lands as NULL.
    assert sorted((r.towards is None, r.towards or "") for r in back.collect()) == [
        (False, "Walthamstow"), (True, "")]
    assert "ingest_date" in back.columns


def test_landing_files_roundtrip(spark, tmp_path):
    path = str(tmp_path / "landing")
    _payloads(spark, [json.dumps([FULL]), "not json"]).write.json(path)
    good, rej = I.raw_from_payloads(I.read_predictions(spark, path))
    assert good.count() == 1 and rej.count() == 1


def test_ingest_run(spark, tmp_path):
    landing, raw = (str(tmp_path / n) for n in ("landing", "raw"))
    _payloads(spark, [json.dumps([FULL, FULL]), json.dumps([dict(FULL, timeToStation="x")])]).write.json(landing)
    with pytest.raises(RuntimeError):
        I.ingest_run(spark, landing, raw)
    assert I.read_raw(spark, raw).count() == 2 and I.read_rejects(spark, raw).count() == 1
    assert I.ingest_run(spark, landing, raw, strict=False) == {"rows_inserted": 2, "rows_errored": 1, "payloads_skipped": 0}
    empty = str(tmp_path / "empty")
    _payloads(spark, ["[]"]).write.json(empty)
    assert I.ingest_run(spark, empty, str(tmp_path / "raw2")) == {
        "rows_inserted": 0, "rows_errored": 0, "payloads_skipped": 0}
    assert not list((tmp_path / "raw2").rglob("*.parquet"))

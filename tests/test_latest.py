"""Latest prediction per (vehicle, line)."""

import datetime as dt

from raw_rows import TS, make_raw, raw_row
from pyspark.sql import Window
from pyspark.sql import functions as F

from transitlens.operators.latest import latest_per_vehicle
from transitlens.sources import standin

LATER = TS + dt.timedelta(minutes=1)


def _pick(spark, rows):
    return {(r.vehicle_id, r.line_id): r.event_id for r in latest_per_vehicle(make_raw(spark, rows)).collect()}


def test_later_timestamp_beats_smaller_t(spark):
    assert _pick(spark, [raw_row(t=5, event_id=1), raw_row(t=100, ts=LATER, event_id=2)]) == {("v1", "x"): 2}


def test_same_timestamp_smaller_t_wins(spark):
    assert _pick(spark, [raw_row(t=50, event_id=1), raw_row(t=10, event_id=2)]) == {("v1", "x"): 2}


def test_null_t_loses(spark):
    assert _pick(spark, [raw_row(t=None, event_id=1), raw_row(t=500, event_id=2)]) == {("v1", "x"): 2}


def test_tie_by_event_id(spark):
    assert _pick(spark, [raw_row(t=10, event_id=7), raw_row(t=10, event_id=3)]) == {("v1", "x"): 3}


def test_null_timestamp_wins_as_desc_nulls_first(spark):
    assert _pick(spark, [raw_row(ts=None, t=99, event_id=1), raw_row(t=1, event_id=2)]) == {("v1", "x"): 1}


def test_vehicle_on_two_lines_gives_two_rows(spark):
    assert _pick(spark, [raw_row(line="x", event_id=1), raw_row(line="y", event_id=2)]) == {
        ("v1", "x"): 1, ("v1", "y"): 2}


def test_missing_vehicle_ids_collapse_per_line(spark):
    assert _pick(spark, [raw_row(vehicle="", t=5, event_id=1), raw_row(vehicle="", t=9, event_id=2)]) == {
        ("", "x"): 1}


def test_null_tie_loses_in_both_forms(spark):
    from transitlens.operators.latest import latest_by_aggregate
    raw = make_raw(spark, [raw_row(t=10, event_id=None), raw_row(t=10, event_id=5)])
    assert [r.event_id for r in latest_per_vehicle(raw).collect()] == [5]
    assert [r.event_id for r in latest_by_aggregate(raw).collect()] == [5]


def test_hash_tie_when_no_event_id(spark):
    raw = make_raw(spark, [raw_row(t=10, event_id=1), raw_row(t=10, event_id=2)]).drop("event_id")
    out = latest_per_vehicle(raw)
    assert out.count() == 1 and "event_id" not in out.columns


def test_equals_row_number_window_on_standin(spark):
    raw = standin.arrivals(spark, "/root/testdata/sf0.01")
    w = Window.partitionBy("vehicle_id", "line_id").orderBy(
        F.col("timestamp_utc").desc_nulls_first(), F.col("time_to_station").asc_nulls_last(),
        F.col("event_id").asc())
    brute = raw.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    ours = latest_per_vehicle(raw).select(*brute.columns)
    assert ours.count() == 750
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_independent_of_input_order_and_partitioning(spark):
    raw = standin.arrivals(spark, "/root/testdata/sf0.01")
    a = latest_per_vehicle(raw)
    b = latest_per_vehicle(raw.orderBy(F.rand(7)).repartition(13))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_aggregate_form_equals_window_form(spark):
    from transitlens.operators.latest import latest_by_aggregate
    raw = standin.arrivals(spark, "/root/testdata/sf0.01")
    # Also with NULL timestamps in the mix (they win: DESC NULLS FIRST).
    raw = raw.withColumn("timestamp_utc", F.when(F.col("event_id") % 13 != 0, F.col("timestamp_utc")))
    a = latest_per_vehicle(raw)
    b = latest_by_aggregate(raw).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

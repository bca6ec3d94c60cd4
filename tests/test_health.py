"""H1-H10."""

import datetime as dt

from raw_rows import make_raw, raw_row

from transitlens.operators import health as H


def test_freshness_counts_second_boundaries(spark):
    raw = make_raw(spark, [raw_row(ts=dt.datetime(2024, 1, 1, 0, 0, 0, 900000))])
    r = H.freshness(raw, dt.datetime(2024, 1, 1, 0, 0, 2, 100000)).first()
    assert r.lag_seconds == 2 and r.latest_ingestion == dt.datetime(2024, 1, 1, 0, 0, 0, 900000)


def test_raw_volume_and_counts(spark):
    raw = make_raw(spark, [raw_row(event_id=i) for i in range(4)])
    r = H.raw_volume(raw).first()
    assert (r.total_rows, r.batches) == (4, 1)
    tc = {r.table_name: r.row_count for r in H.table_counts({"A": raw, "B": raw.limit(1)}).collect()}
    assert tc == {"A": 4, "B": 1}
    assert [(r.line_id, r.predictions) for r in H.predictions_per_line(raw).collect()] == [("x", 4)]


def test_samples_are_bounded_and_ordered(spark, fixture_stations, fixture_lines):
    from transitlens.plans.positions import train_positions
    raw = make_raw(spark, [raw_row(vehicle=f"v{i:02d}", loc="At Oval", event_id=i) for i in range(30)])
    pos = train_positions(raw, fixture_stations, fixture_lines)
    s = H.position_sample(pos).collect()
    assert len(s) == 20 and [r.vehicle_id for r in s] == [f"v{i:02d}" for i in range(20)]
    assert len(H.line_sample(pos, "x").collect()) == 10
    assert [(r.location_type, r.cnt) for r in H.location_type_counts(pos).collect()] == [("AT_STATION", 30)]


def test_unplaced_counts_by_class(spark, fixture_stations):
    from pyspark.sql import functions as F

    from transitlens.plans.positions import parse_location, positioned
    raw = make_raw(spark, [raw_row(vehicle="a", loc="At Nowhere", event_id=1),
                           raw_row(vehicle="b", loc="Between Oval and Nowhere", t=90, event_id=2),
                           raw_row(vehicle="c", loc="At Oval", event_id=3)])
    pos = positioned(parse_location(raw), fixture_stations)
    un = pos.where(F.col("latitude").isNull() | F.col("longitude").isNull())
    got = {r.location_type: r.cnt for r in H.location_type_counts(un).collect()}
    assert got == {"AT_STATION": 1, "BETWEEN": 1}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_footers(spark, tmp_path):
    from transitlens.sources import ingest as I
    path = str(tmp_path / "raw")
    rows = [raw_row(event_id=i, ts=dt.datetime(2024, 1, 1 + i % 3, 5)) for i in range(9)] + [raw_row(event_id=20, ts=None)]
    I.append_raw(make_raw(spark, rows), path)
    df = H.table_counts({"A": I.raw_footers(spark, path)})
    assert [(r.table_name, r.row_count) for r in df.collect()] == [("A", 10)]
    assert "PushedAggregation: [COUNT(*)]" in _plan(df)
    # other reads of the session stay with the reader they had
    assert "BatchScan" not in _plan(spark.read.parquet(path))


def test_stored_freshness_reads_the_newest_day_only(spark, tmp_path):
    from transitlens.sources import ingest as I
    path, now = str(tmp_path / "raw"), dt.datetime(2024, 1, 9)
    rows = [raw_row(event_id=i, ts=dt.datetime(2024, 1, 1 + i % 7, i)) for i in range(20)] + [raw_row(event_id=50, ts=None)]
    I.append_raw(make_raw(spark, rows), path)
    df = H.stored_freshness(I.read_raw(spark, path), I.raw_days(spark, path), now)
    assert df.collect() == H.freshness(I.read_raw(spark, path), now).collect()
    plan = _plan(df)
    assert "PushedGroupBy: [rejected, ingest_date]" in plan and "PushedAggregation: [COUNT(*)]" in plan
    partition_filters = [line for line in plan.splitlines() if "FileScan" in line and "timestamp_utc" in line]
    assert partition_filters and all("ingest_date" in p.split("PartitionFilters: [")[1].split("PushedFilters")[0] for p in partition_filters)

    nothing = str(tmp_path / "undated")
    I.append_raw(make_raw(spark, [raw_row(event_id=1, ts=None)]), nothing)
    r = H.stored_freshness(I.read_raw(spark, nothing), I.raw_days(spark, nothing), now).first()
    assert (r.latest_ingestion, r.lag_seconds) == (None, None)

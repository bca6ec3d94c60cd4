"""Location cases of FIXTURES.md §3 through the whole TRAIN_POSITIONS plan."""

import pytest
from raw_rows import make_raw, raw_row
from pyspark.sql import functions as F

from transitlens.plans.positions import parse_location, positioned, train_positions

# (current_location, t, next stop naptan, expected type, expected positions)
CASES = [
    ("At Oval", 60, "A1", "AT_STATION", [(51.4, -0.5)]),
    ("At oVAL", 60, "A1", "AT_STATION", [(51.4, -0.5)]),
    ("at Oval", 60, "A1", "OTHER", [(51.0, -0.1)]),
    ("At Acton", 60, "A1", "AT_STATION", [(51.2, -0.3), (51.0, -0.1)]),
    ("At ", 60, "A1", "AT_STATION", []),
    ("At Nowhere", 60, "A1", "AT_STATION", []),
    ("Approaching Oval", 60, "A1", "APPROACHING", [(51.4, -0.5)]),
    ("Approaching Nowhere", 60, "A1", "APPROACHING", [(51.0, -0.1)]),
    ("Left Oval", 60, "A1", "DEPARTED", [(51.0, -0.1)]),
    ("Departed Oval", 60, "A1", "DEPARTED", [(51.0, -0.1)]),
    ("Near Oval", 60, "A1", "OTHER", [(51.0, -0.1)]),
    ("", 60, "A1", "OTHER", [(51.0, -0.1)]),
    (None, 60, "A1", "OTHER", [(51.0, -0.1)]),
    ("Left Oval", 60, "ZZ", "DEPARTED", []),
    ("Between Oval and East Acton", 90, "A1", "BETWEEN", [(51.3, -0.4)]),
    ("Between Oval and East Acton", 0, "A1", "BETWEEN", [(51.2, -0.3)]),
    ("Between Oval and East Acton", -5, "A1", "BETWEEN", [(51.2, -0.3)]),
    ("Between Oval and East Acton", 180, "A1", "BETWEEN", [(51.4, -0.5)]),
    ("Between Oval and East Acton", 500, "A1", "BETWEEN", [(51.4, -0.5)]),
    ("Between Oval and East Acton", None, "A1", "BETWEEN", []),
    ("Between Oval and Acton", 90, "A1", "BETWEEN", [(51.3, -0.4), (51.2, -0.3)]),
    ("Between Oval and Nowhere", 90, "A1", "BETWEEN", []),
    ("Between Oval and Acton Town and East Acton", 90, "A1", "BETWEEN", []),
]


@pytest.fixture(scope="module")
def result(spark, fixture_stations, fixture_lines):
    rows = [raw_row(vehicle=f"v{i}", loc=loc, t=t, naptan=nap, event_id=i)
            for i, (loc, t, nap, _, _) in enumerate(CASES)]
    raw = make_raw(spark, rows)
    pos = train_positions(raw, fixture_stations, fixture_lines).collect()
    parsed = parse_location(raw).collect()
    return pos, parsed


@pytest.mark.parametrize("i", range(len(CASES)))
def test_location_case(result, i):
    pos, parsed = result
    loc, t, nap, typ, expected = CASES[i]
    assert [r.location_type for r in parsed if r.vehicle_id == f"v{i}"] == [typ]
    got = sorted((round(r.latitude, 9), round(r.longitude, 9)) for r in pos if r.vehicle_id == f"v{i}")
    assert got == sorted((round(a, 9), round(b, 9)) for a, b in expected), (loc, t)
    for r in pos:
        if r.vehicle_id == f"v{i}":
            assert r.colour_hex == "#B36305" and r.location_type == typ


def test_other_line_never_matches(spark, fixture_stations, fixture_lines):
    raw = make_raw(spark, [raw_row(vehicle="v", line="y", loc="At Acton", naptan="O2")])
    assert train_positions(raw, fixture_stations, fixture_lines).count() == 0


def test_unplaced_rows_kept_before_filter(spark, fixture_stations):
    raw = make_raw(spark, [raw_row(loc="At Nowhere")])
    rows = positioned(parse_location(raw), fixture_stations).collect()
    assert len(rows) == 1 and rows[0].latitude is None


def test_like_wildcards_and_escape(spark, spark_stations_with_marks):
    # '_' and '%' act as wildcards (the reference's ILIKE); '!' and '\\' are literal.
    st, lines = spark_stations_with_marks
    raw = make_raw(spark, [
        raw_row(vehicle="a", loc="At Hyde_Park", naptan="none"),
        raw_row(vehicle="b", loc="At Bang!", naptan="none"),
        raw_row(vehicle="c", loc="At Back\\slash", naptan="none"),
    ])
    got = {r.vehicle_id: r.latitude for r in train_positions(raw, st, lines).collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 3.0}


@pytest.fixture(scope="module")
def spark_stations_with_marks(spark, fixture_lines):
    from transitlens.schemas import REF_STATIONS
    st = spark.createDataFrame([
        ("H", "Hyde Park Corner", "x", 1.0, 0.0),
        ("B", "Bang! Station", "x", 2.0, 0.0),
        ("S", "Back\\slash Road", "x", 3.0, 0.0),
    ], REF_STATIONS)
    return st, fixture_lines


def test_unique_one_row_per_vehicle_and_subset(spark, fixture_stations, fixture_lines):
    rows = [raw_row(vehicle=f"v{i}", loc=loc, t=t, naptan=nap, event_id=i)
            for i, (loc, t, nap, _, _) in enumerate(CASES)]
    raw = make_raw(spark, rows)
    full = train_positions(raw, fixture_stations, fixture_lines)
    uniq = train_positions(raw, fixture_stations, fixture_lines, unique=True)
    assert uniq.groupBy("vehicle_id", "line_id").count().where(F.col("count") > 1).count() == 0
    assert uniq.exceptAll(full).count() == 0
    # 'At Acton': shortest name wins -> Acton Town Station (51.0, -0.1)
    i = [c[0] for c in CASES].index("At Acton")
    r = uniq.where(F.col("vehicle_id") == f"v{i}").first()
    assert (r.latitude, r.longitude) == (51.0, -0.1)


def test_max_age_drops_stale(spark, fixture_stations, fixture_lines):
    import datetime as dt
    old = dt.datetime(2024, 1, 1)
    new = dt.datetime(2024, 1, 20)
    raw = make_raw(spark, [raw_row(vehicle="old", loc="At Oval", ts=old),
                           raw_row(vehicle="new", loc="At Oval", ts=new)])
    out = train_positions(raw, fixture_stations, fixture_lines, max_age=dt.timedelta(days=5),
                          now=dt.datetime(2024, 1, 21))
    assert [r.vehicle_id for r in out.collect()] == ["new"]


def test_max_age_prunes_ingest_date_partitions(spark, fixture_stations, fixture_lines, tmp_path):
    import datetime as dt
    from transitlens.sources import ingest as I
    path = str(tmp_path / "raw")
    days = [dt.datetime(2024, 1, d) for d in (1, 10, 20)]
    I.append_raw(make_raw(spark, [raw_row(vehicle=f"v{i}", loc="At Oval", ts=d, event_id=i)
                                  for i, d in enumerate(days)]), path)
    raw = I.read_raw(spark, path)
    out = train_positions(raw, fixture_stations, fixture_lines, max_age=dt.timedelta(days=5),
                          now=dt.datetime(2024, 1, 21))
    assert [r.vehicle_id for r in out.collect()] == ["v2"]
    from transitlens.plans.positions import _fresh_raw, prune_raw
    read, _ = _fresh_raw(prune_raw(raw), dt.timedelta(days=5), dt.datetime(2024, 1, 21))
    plan = read._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln and "ingest_date" in ln]
    assert scan and "PartitionFilters: [" in scan[0] and "ingest_date" in scan[0].split("PartitionFilters: [")[1]

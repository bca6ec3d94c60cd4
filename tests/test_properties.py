"""Brute-force checks: Spark expressions against plain-Python versions of the
reference's SQL semantics, on generated inputs."""

import re

from raw_rows import make_raw, raw_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlens.functions import location as L
from transitlens.operators.latest import latest_per_vehicle
from transitlens.plans.positions import train_positions
from transitlens.schemas import REF_STATIONS
from transitlens.sources import standin

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
PIECES = ["At ", "at ", "Between ", " and ", "Approaching ", "Left ", "Departed ", "Oval", "Acton",
          "X", " ", "%", "_", "!", "\\", "and", "Near "]
texts = st.lists(st.sampled_from(PIECES), min_size=0, max_size=6).map("".join)


def py_type(s):
    if s is None:
        return "OTHER"
    for prefix, t in [("At ", "AT_STATION"), ("Between ", "BETWEEN"), ("Approaching ", "APPROACHING"),
                      ("Left ", "DEPARTED"), ("Departed ", "DEPARTED")]:
        if s.startswith(prefix):
            return t
    return "OTHER"


def py_extract(s, pattern, group):
    if s is None:
        return None
    m = re.search(pattern, s)
    return (m.group(group) or None) if m else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=40))
def test_location_parsing_matches_python(spark, locs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(locs)], "i int, s string")
    c = F.col("s")
    got = df.select("i", L.location_type(c).alias("t"), L.from_station_name(c).alias("f"),
                    L.to_station_name(c).alias("to"), L.at_station_name(c).alias("a"),
                    L.approaching_station_name(c).alias("p")).orderBy("i").collect()
    for r, s in zip(got, locs):
        assert r.t == py_type(s), s
        assert r.f == py_extract(s, L.BETWEEN_PATTERN, 1), s
        assert r.to == py_extract(s, L.BETWEEN_PATTERN, 2), s
        assert r.a == py_extract(s, L.AT_PATTERN, 1), s
        assert r.p == py_extract(s, L.APPROACHING_PATTERN, 1), s


def py_ilike(value, name):
    """value ILIKE '%' || name || '%' with no escape character: % and _ are
    wildcards, every other character literal."""
    if value is None or name is None:
        return False
    rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in name)
    return re.fullmatch(".*" + rx + ".*", value, re.IGNORECASE | re.DOTALL) is not None


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=8), st.lists(st.one_of(st.none(), texts), min_size=1, max_size=12))
def test_name_match_matches_python(spark, station_names, names):
    stations = spark.createDataFrame([(f"S{i}", n, "x", float(i), 0.0) for i, n in enumerate(station_names)],
                                     REF_STATIONS)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = df.join(stations, L.name_matches(F.col("station_name"), F.col("n"))).select("i", "naptan_id").collect()
    want = {(i, f"S{j}") for i, n in enumerate(names) for j, sn in enumerate(station_names) if py_ilike(sn, n)}
    assert {(r.i, r.naptan_id) for r in got} == want


def test_partial_group_limit_before_the_shuffle(spark):
    # A third of the rows share one key: the plan must cut them map-side.
    rows = [raw_row(vehicle="", t=i % 50, event_id=i) for i in range(300)] + \
           [raw_row(vehicle=f"v{i}", t=5, event_id=1000 + i) for i in range(600)]
    out = latest_per_vehicle(make_raw(spark, rows).repartition(6))
    assert out.count() == 601
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(vehicle_id")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_view_independent_of_input_order_and_partitioning(spark):
    t = standin.reference_tables(spark, "/root/testdata/sf0.01")
    a = train_positions(t["raw"], t["stations"], t["lines"])
    b = train_positions(t["raw"].orderBy(F.rand(11)).repartition(17), t["stations"], t["lines"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

"""Names matched once and joined back, duplicates included."""

import pytest
from pyspark.sql import functions as F

from transitlens.functions.location import name_matches
from transitlens.operators.latest import latest_per_vehicle
from transitlens.operators.station_match import candidates, match_names, match_station, name_pairs, next_stop
from transitlens.plans.positions import NAME_MATCHES, parse_location, train_positions
from transitlens.session import materialised
from transitlens.sources import standin

SF = "/root/testdata/sf0.01"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _parsed(spark):
    return parse_location(latest_per_vehicle(standin.arrivals(spark, SF)))


def test_equals_the_direct_join(spark):
    parsed, st = _parsed(spark), standin.stations(spark, SF)
    matches = match_names(parsed, st)
    for prefix, name_col in NAME_MATCHES:
        ours = match_station(parsed, matches, name_col, prefix)
        cond = (parsed.line_id == st.line_id) & name_matches(st.station_name, parsed[name_col])
        direct = parsed.join(st, cond, "left").select(*[parsed[c] for c in parsed.columns],
                                                      *[st[c].alias(f"{prefix}_{c}") for c in ("naptan_id", "station_name", "latitude", "longitude")])
        assert ours.count() >= parsed.count() and _same(ours, direct), name_col


@pytest.mark.parametrize("name", ["oval", "O", "va", "%", "_val", "O%l", "100%", "!", "OVAL STATION", "xyz", "_", "\u0130", " ", "%al s"])
def test_names_with_wildcards_and_short_names(spark, name):
    st = spark.createDataFrame([("a", "Oval Station", "x", 1.0, 2.0), ("b", "Hi! 100% _ \u0130stasyon", "x", 1.0, 2.0), ("c", "Oval", "y", 1.0, 2.0)],
                               "naptan_id string, station_name string, line_id string, latitude double, longitude double")
    parsed = spark.createDataFrame([("x", name)], "line_id string, at_station_name string")
    got = {r.naptan_id for r in match_names(parsed, st).collect()}
    want = {r.naptan_id for r in st.where("line_id = 'x'").where(name_matches(F.col("station_name"), F.lit(name))).collect()}
    assert got == want


def test_fan_out_matches_b1(spark):
    # NATION_1 is a substring of NATION_11 and NATION_16 on the same line.
    parsed = _parsed(spark)
    out = match_station(parsed, match_names(parsed, standin.stations(spark, SF)), "at_station_name", "s_at")
    assert out.groupBy("vehicle_id", "line_id").count().where(F.col("count") > 1).count() > 0


def test_one_plan_without_broadcasts(spark):
    """With broadcasts off: raw is not read again, and no exchange is keyed on the line alone."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = train_positions(standin.arrivals(spark, SF), standin.stations(spark, SF), standin.lines(spark, SF))
        plan = out.drop("colour_hex", "colour_r", "colour_g", "colour_b")._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 764
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "events" not in plan and "row_number" not in plan


def test_next_stop_is_pure_equi(spark):
    parsed = _parsed(spark)
    out = next_stop(parsed, standin.stations(spark, SF))
    assert out.count() == parsed.count()


def _probe(spark, n):
    """n stations of one line that share a prefix, and every tenth name without its first letters."""
    st = spark.range(n).select(
        F.format_string("S%d", "id").alias("naptan_id"), F.format_string("Central Station Platform %06d %s", "id", F.md5(F.col("id").cast("string"))).alias("station_name"),
        F.lit("x").alias("line_id"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    names = st.where(F.col("latitude") == 1.0).select("line_id", F.substring("station_name", 9, 40).alias("at_station_name"))
    return names, st


def test_stations_that_share_a_prefix_are_told_apart(spark):
    names, st = _probe(spark, 100_000)
    pairs = name_pairs(names)
    met = materialised(candidates(pairs, st), "met")
    matches = met.where(name_matches(F.col("station_name"), F.col("name")))
    n, m = met.count(), matches.count()
    assert m >= 100_000 and n <= 2 * m
    # the looked-up grams spread over the tasks of the join
    rows = [r["count"] for r in met.groupBy(F.pmod(F.hash("line_id", F.lower("name")), F.lit(8))).count().collect()]
    assert max(rows) <= 2 * sorted(rows)[len(rows) // 2]


def test_a_name_of_wildcards_meets_all_stations_of_its_line(spark):
    _, st = _probe(spark, 2000)
    parsed = spark.createDataFrame([("x", "%"), ("x", "__"), ("y", "%"), ("x", "")], "line_id string, at_station_name string")
    got = {(r.line_id, r.name): r["count"] for r in match_names(parsed, st).groupBy("line_id", "name").count().collect()}
    assert got == {("x", "%"): 2000, ("x", "__"): 2000, ("x", ""): 2000}


def test_the_prefix_itself_finds_all(spark):
    _, st = _probe(spark, 2000)
    parsed = spark.createDataFrame([("x", "CENTRAL station"), ("x", "platform 00001"), ("x", "nowhere at all")], "line_id string, at_station_name string")
    got = {r.name: r["count"] for r in match_names(parsed, st).groupBy("name").count().collect()}
    assert got == {"CENTRAL station": 2000, "platform 00001": 10}

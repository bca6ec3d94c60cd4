"""Reference loads."""

import json
import os
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from transitlens.sources import refdata as R


def test_load_stations(spark):
    docs = spark.createDataFrame([("victoria", json.dumps([
        {"naptanId": "940GZZLUOVL", "commonName": "Oval Underground Station", "lat": 51.4819, "lon": -0.1126},
        {"naptanId": "940GZZLUBXN", "commonName": "Brixton Underground Station", "lat": "51.4627", "lon": "-0.1145"},
    ]))], "line_id string, body string")
    rows = R.load_stations(docs).collect()
    assert [(r.naptan_id, r.line_id, r.latitude) for r in rows] == [
        ("940GZZLUOVL", "victoria", 51.4819), ("940GZZLUBXN", "victoria", 51.4627)]


def test_missing_stop_key_fails(spark):
    docs = spark.createDataFrame([("x", json.dumps([{"naptanId": "a", "commonName": "b", "lat": 1}]))],
                                 "line_id string, body string")
    with pytest.raises(Exception):
        R.load_stations(docs).collect()


def test_load_routes(spark):
    docs = spark.createDataFrame([
        ("x", "inbound", json.dumps({"lineStrings": ["[[[0.5,51.25],[0.5,51.5]]]", "[[1.0,2.0]]"]})),
        ("x", "outbound", json.dumps({"lineStrings": [[[1.5, 51.25], [2.5, 51.5]]]})),
        ("y", "inbound", json.dumps({"name": "no lineStrings"})),
        ("y", "outbound", None),
    ], "line_id string, direction string, body string")
    rows = R.load_routes(docs).collect()
    assert [(r.line_id, r.direction) for r in rows] == [("x", "inbound"), ("x", "inbound"), ("x", "outbound")]
    assert rows[0].coordinates == "[[[0.5, 51.25], [0.5, 51.5]]]"
    assert rows[1].coordinates == "[[1.0, 2.0]]"
    assert json.loads(rows[2].coordinates) == [[1.5, 51.25], [2.5, 51.5]]


def test_route_text_is_written_as_json_dumps_writes_it(spark):
    texts = ["[[0.5,51.20],[1,2]]", "[[[0.10,51.0]],  [[-0.25 ,1.5]]]", "[]", "[[]]"]
    docs = spark.createDataFrame([("x", "inbound", json.dumps({"lineStrings": texts}))], "line_id string, direction string, body string")
    assert [r.coordinates for r in R.load_routes(docs).collect()] == [json.dumps(json.loads(t)) for t in texts]


@pytest.mark.parametrize("body", ["{broken", "[1, 2]", json.dumps({"lineStrings": ["not paths"]}), json.dumps({"lineStrings": 5}),
                                  json.dumps({"lineStrings": ["[[1,2]]"]}) + " junk"])
def test_bad_routes_fail(spark, body):
    docs = spark.createDataFrame([("x", "inbound", body)], "line_id string, direction string, body string")
    with pytest.raises(Exception):
        R.load_routes(docs).count()


STOP = {"naptanId": "a", "commonName": "b", "lat": 1, "lon": 2}


@pytest.mark.parametrize("body", [None, "{broken", json.dumps([STOP]) + " junk", json.dumps([None]), json.dumps([dict(STOP, lat=None)]),
                                  json.dumps([dict(STOP, lon="east")]), json.dumps([{k: v for k, v in STOP.items() if k != "naptanId"}])])
def test_bad_stops_fail_before_the_table_is_replaced(spark, tmp_path, body):
    path = str(tmp_path / "stations")
    good = spark.createDataFrame([("x", json.dumps([STOP]))], "line_id string, body string")
    R.replace_table(R.load_stations(good), path)
    bad = R.load_stations(spark.createDataFrame([("x", json.dumps([STOP])), ("y", body)], "line_id string, body string"))
    for broken in (lambda: bad.count(), lambda: bad.select("line_id").collect(), lambda: R.replace_table(bad, path)):
        with pytest.raises(Exception):
            broken()
    assert spark.read.parquet(path).count() == 1


def test_lines_and_summary(spark):
    lines = R.load_lines(spark)
    assert lines.count() == 11
    vic = lines.where("line_id = 'victoria'").first()
    assert (vic.colour_hex, vic.colour_r, vic.colour_g, vic.colour_b) == ("#0098D4", 0, 152, 212)
    st = spark.createDataFrame([("a", "A", "victoria", 1.0, 2.0)] * 3,
                               "naptan_id string, station_name string, line_id string, latitude double, longitude double")
    rt = spark.createDataFrame([("victoria", "inbound", "[]")] * 2, "line_id string, direction string, coordinates string")
    s = R.load_summary(st, rt, lines).first().summary
    assert s == "Reference data loaded: 3 stations, 2 routes, 11 lines"


def test_replace_table_overwrites(spark, tmp_path):
    p = str(tmp_path / "lines")
    R.replace_table(R.load_lines(spark), p)
    R.replace_table(R.load_lines(spark).limit(2), p)
    assert spark.read.parquet(p).count() == 2


def test_fixed_line_colours_consistent(spark):
    # Each line's r, g, b must be the channels of its hex colour.
    from pyspark.sql import functions as F

    from transitlens.functions.geometry import hex_rgb
    rows = R.load_lines(spark).select("colour_r", "colour_g", "colour_b",
                                      hex_rgb(F.col("colour_hex"), 0).alias("c")).collect()
    assert all(r.c[:3] == [r.colour_r, r.colour_g, r.colour_b] for r in rows)


@pytest.fixture
def catalog_table(spark):
    name = f"lines_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_readers_never_miss_a_switched_table(spark, tmp_path, catalog_table):
    folder = str(tmp_path)
    rows = lambda n: spark.range(1000).selectExpr("id", f"{n}L AS version").repartition(4)
    R.switch_table(rows(0), catalog_table, folder)
    seen, failed, stop = [], [], threading.Event()

    def reader():
        while not stop.is_set():
            try:
                r = spark.table(catalog_table).selectExpr("count(*) AS n", "min(version) AS a", "max(version) AS b").first()
                seen.append((r.n, r.a == r.b))
            except Exception as e:      # any failure of a reader fails the test
                failed.append(e)
    t = threading.Thread(target=reader)
    t.start()
    try:
        for n in range(1, 21):
            R.switch_table(rows(n), catalog_table, folder)
    finally:
        stop.set()
        t.join()
    assert not failed and len(seen) > 5 and set(seen) == {(1000, True)}
    assert spark.table(catalog_table).first().version == 20


def test_switch_keeps_the_table_of_a_failed_load_and_removes_old_folders(spark, tmp_path, catalog_table):
    folder = str(tmp_path)
    first = R.switch_table(R.load_lines(spark), catalog_table, folder)
    other = R.switch_table(R.load_lines(spark), catalog_table + "s", folder)
    bad = R.load_lines(spark).withColumn("line_name", F.raise_error(F.lit("broken")).cast("string"))
    for rows in (bad, R.load_lines(spark).drop("line_name")):
        with pytest.raises(Exception):
            R.switch_table(rows, catalog_table, folder)
    assert R.location(spark, catalog_table).endswith(first.rsplit("/", 1)[-1])
    now = R.switch_table(R.load_lines(spark).limit(2), catalog_table, folder)
    assert spark.table(catalog_table).count() == 2
    assert len(list(tmp_path.glob(f"{catalog_table}@*"))) >= 2           # the old folder stays for its readers
    time.sleep(0.1)
    last = R.switch_table(R.load_lines(spark).limit(3), catalog_table, folder, grace=0.0)
    left = {p.name for p in tmp_path.glob(f"{catalog_table}@*")}
    assert last.rsplit("/", 1)[-1] in left and now.rsplit("/", 1)[-1] not in left
    assert spark.table(catalog_table).count() == 3 and spark.table(catalog_table + "s").count() == 11
    assert other
    spark.sql(f"DROP TABLE {catalog_table}s")


def test_a_folder_stays_for_the_grace_after_the_table_left_it(spark, tmp_path, catalog_table):
    """Daily loads: the rows are a day old when their folder is left, and its readers still have an hour."""
    folder, hour = str(tmp_path), 3600.0

    def aged(path, hours):
        at = time.time() - hours * hour
        os.utime(path, (at, at))

    first, second = (R.switch_table(R.load_lines(spark).limit(n), catalog_table, folder) for n in (1, 2))
    aged(first, 48), aged(second, 24)
    reader = spark.table(catalog_table)
    third = R.switch_table(R.load_lines(spark).limit(3), catalog_table, folder)
    assert reader.count() == 2                                           # planned before the switch
    left = {str(p) for p in tmp_path.glob("*@*")}
    assert left == {second, third}                                       # the first one was left a day ago
    aged(third, 0.5)
    fourth = R.switch_table(R.load_lines(spark).limit(4), catalog_table, folder)
    assert {str(p) for p in tmp_path.glob("*@*")} == {second, third, fourth}     # left half an hour ago
    aged(third, 3), aged(fourth, 2)
    fifth = R.switch_table(R.load_lines(spark).limit(5), catalog_table, folder)
    assert {str(p) for p in tmp_path.glob("*@*")} == {fourth, fifth}
    assert R.stored(spark, catalog_table).count() == 5 and R.stored_folder(spark, catalog_table).endswith(R._name(fifth))

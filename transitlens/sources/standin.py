"""Stand-in tables derived from the given TPC-H-ish parquet.

There are no arrival predictions in the test data, so: regions act as lines,
nations as stations, events as predictions. Everything is a plain column
expression over ``events``, ``region`` and ``nation``; the work grows with the
events table. The DuckDB oracle carries the same derivation as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from .refdata import load_lines

# The stand-in line colours, taken by region key 0..4.
STANDIN_PALETTE = ["#1D4ED8", "#0F766E", "#B45309", "#7E22CE", "#BE123C"]
# Fixed values of the stand-in raw rows.
PLATFORM_NAME = "Platform 1"
DESTINATION_NAPTAN_ID = "N0"
NULL_TIME_EVERY = 97          # event_id % 97 = 0 has an unknown time_to_station
LINE_COUNT = 5                # event_id % 5 picks the region (line)


# Declared schemas of the source tables read here: a read with a schema
# needs no footer-inference job (one Spark job per read otherwise).
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def _nation_label(k: Column) -> Column:
    return F.concat(F.lit("NATION_"), k.cast("string"))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")


def line_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, line_name, colour_hex): one line per region, colour by region key."""
    palette = F.array(*[F.lit(h) for h in STANDIN_PALETTE])
    return _regions(spark, sf_dir).select(
        F.lower("r_name").alias("line_id"), F.col("r_name").alias("line_name"),
        F.element_at(palette, F.col("r_regionkey") + 1).alias("colour_hex"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REF_LINES stand-in."""
    return load_lines(spark, line_metadata(spark, sf_dir))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REF_STATIONS stand-in: nation = station, its region = its line."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _regions(spark, sf_dir)
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("naptan_id"),
            F.concat(F.col("n_name"), F.lit(" Station")).alias("station_name"),
            F.lower("r_name").alias("line_id"),
            F.expr("CAST(51.4 + n_nationkey * 0.01 AS DOUBLE)").alias("latitude"),
            F.expr("CAST(-0.3 + n_nationkey * 0.02 AS DOUBLE)").alias("longitude"),
        )
    )


def route_coordinates(k: Column, direction: Column) -> Column:
    """Route JSON text: depth 3 (two segments) for inbound on odd keys, else depth 2."""
    ks = k.cast("string")
    depth3 = F.concat(F.lit("[[["), ks, F.lit(".5, 51.25], [0.5, 51.5]], [[1.5, 51.75], [2.5, 52.0]]]"))
    depth2 = F.concat(F.lit("[["), ks, F.lit(".5, 51.25], [0.5, 51.5]]"))
    return F.when((direction == "inbound") & (k % 2 == 1), depth3).otherwise(depth2)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REF_LINE_ROUTES stand-in: each region in both directions."""
    dirs = F.explode(F.array(F.lit("inbound"), F.lit("outbound"))).alias("direction")
    return (
        _regions(spark, sf_dir)
        .select("r_regionkey", F.lower("r_name").alias("line_id"), dirs)
        .select("line_id", "direction",
                route_coordinates(F.col("r_regionkey"), F.col("direction")).alias("coordinates"))
    )


def current_location(event_type: Column, event_id: Column, user_id: Column, f: Column, t: Column) -> Column:
    fn, tn = _nation_label(f), _nation_label(t)
    return (
        F.when(event_type == "view", F.concat(F.lit("At "), fn))
        .when(event_type == "signup", F.concat(F.lit("Between "), fn, F.lit(" and "), tn))
        .when(event_type == "purchase", F.concat(F.lit("Approaching "), fn))
        .when((event_type == "click") & (user_id % 2 == 0), F.concat(F.lit("Left "), fn))
        .when(event_type == "click", F.concat(F.lit("Departed "), fn))
        .when((event_type == "error") & (event_id % 3 == 0), F.lit(""))
        .when((event_type == "error") & (event_id % 3 == 1), F.lit(None).cast("string"))
        .when(event_type == "error", F.lit("Near a platform"))
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_ARRIVALS stand-in (15 columns + event_id as the W1 tie-break)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    region = _regions(spark, sf_dir)
    e, u = F.col("event_id"), F.col("user_id")
    f = e % LINE_COUNT + 5 * (u % 6)
    t = e % LINE_COUNT + 5 * ((u + e) % 5)
    tts = F.when(e % NULL_TIME_EVERY != 0, F.floor("value").cast("int"))
    day = F.to_date("ts").cast("timestamp_ntz")
    joined = ev.join(region, (e % LINE_COUNT) == region.r_regionkey.cast("long"))
    return (
        joined.select(
            u.cast("string").alias("vehicle_id"),
            F.lower("r_name").alias("line_id"),
            F.col("r_name").alias("line_name"),
            F.concat(F.lit("N"), t.cast("string")).alias("station_naptan_id"),
            _nation_label(t).alias("station_name"),
            F.lit(PLATFORM_NAME).alias("platform_name"),
            F.when(u % 2 == 0, F.lit("inbound")).otherwise(F.lit("outbound")).alias("direction"),
            _nation_label(t).alias("destination_name"),
            F.lit(DESTINATION_NAPTAN_ID).alias("destination_naptan_id"),
            current_location(F.col("event_type"), e, u, f, t).alias("current_location"),
            _nation_label(t).alias("towards"),
            tts.alias("time_to_station"),
            F.timestamp_add("SECOND", tts, day).alias("expected_arrival"),
            day.alias("timestamp_utc"),
            F.concat(F.lit("batch-"), F.date_format(day, "yyyy-MM-dd")).alias("ingestion_id"),
            e.alias("event_id"),
        )
    )


def reference_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "raw": arrivals(spark, sf_dir),
        "stations": stations(spark, sf_dir),
        "lines": lines(spark, sf_dir),
        "routes": routes(spark, sf_dir),
    }


# ---------------------------------------------------------------- source documents
# The loaders (ingest S1-S7, refdata S8-S9) read API-shaped JSON. These build
# that JSON from the stand-in tables, so that parsing it back must give the
# stand-in tables again. Each document holds a bounded number of entries.

PAYLOAD_ID_SPAN = 500     # event ids per payload chunk: at most 100 per line
# Faults in the payloads: events with this id modulus bring a second prediction
# with a time that is no number, chunks with this modulus a body that breaks off.
BAD_TIME_EVERY = 89
BROKEN_CHUNK_EVERY = 5
BROKEN_BODY = '[{"id":"1","lineId":'


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records: (ingestion_id, timestamp_utc, line_id, body) where
    body is the JSON array the arrivals API would return for that line, with
    at most PAYLOAD_ID_SPAN / LINE_COUNT predictions each."""
    raw = arrivals(spark, sf_dir)
    pred = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("vehicle_id").alias("vehicleId"),
        F.col("line_id").alias("lineId"),
        F.col("line_name").alias("lineName"),
        F.col("station_naptan_id").alias("naptanId"),
        F.col("station_name").alias("stationName"),
        F.col("platform_name").alias("platformName"),
        F.col("direction").alias("direction"),
        F.col("destination_name").alias("destinationName"),
        F.col("destination_naptan_id").alias("destinationNaptanId"),
        F.col("current_location").alias("currentLocation"),
        F.col("towards").alias("towards"),
        F.col("time_to_station").alias("timeToStation"),
        F.when(F.col("expected_arrival").isNotNull(),
               F.concat(_iso(F.col("expected_arrival")), F.lit("Z"))).alias("expectedArrival"),
    ), {"ignoreNullFields": "false"})
    faulty = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("line_id").alias("lineId"),
                                F.lit("soon").alias("timeToStation")))
    both = F.when(F.col("event_id") % BAD_TIME_EVERY == 0, F.concat(pred, F.lit(","), faulty)).otherwise(pred)
    chunk = F.floor(F.col("event_id") / PAYLOAD_ID_SPAN).alias("chunk")
    whole = (
        raw.groupBy("ingestion_id", _iso(F.col("timestamp_utc")).alias("timestamp_utc"), "line_id", chunk)
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(both), ","), F.lit("]")).alias("body")))
    broken = F.when(F.col("chunk") % BROKEN_CHUNK_EVERY == 0, F.array("body", F.lit(BROKEN_BODY))).otherwise(F.array("body"))
    return whole.select("ingestion_id", "timestamp_utc", "line_id", F.explode(broken).alias("body"))


def stop_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, body): stop points of a line as the API lists them, in
    chunks of at most ten stations."""
    st = stations(spark, sf_dir)
    stop = F.to_json(F.struct(
        F.col("naptan_id").alias("naptanId"), F.col("station_name").alias("commonName"),
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))
    chunk = F.floor(F.substring("naptan_id", 2, 9).cast("int") / 10).alias("chunk")
    return (st.groupBy("line_id", chunk)
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list(stop), ","), F.lit("]")).alias("body"))
            .drop("chunk"))


def route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, direction, body): route sequence documents with lineStrings."""
    return routes(spark, sf_dir).select(
        "line_id", "direction",
        F.to_json(F.struct(F.array(F.replace("coordinates", F.lit(" "), F.lit(""))).alias("lineStrings"))).alias("body"))

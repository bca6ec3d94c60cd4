"""Registered queries: key -> (spark, sf_dir) -> DataFrame, plus DuckDB SQL.

Every query reads the given parquet tables (through the stand-in
derivation) over their whole extent; no id subsets, prefixes or row caps.
A ``limit`` appears only where the reference's query is a top-k sample.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import location as L
from ..operators.latest import latest_per_vehicle
from ..operators.station_match import line_colours, match_names, match_station, next_stop
from ..operators import health as H
from ..operators import views as V
from ..session import footer_table, materialised, scratch_path
from ..sources import ingest as I
from ..sources import refdata as R
from ..sources import standin
from ..streaming import commits as C
from ..streaming import live as M
from . import positions as P
from .oracle import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered keys.
FRESH_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)
FRESH_MAX_AGE = dt.timedelta(days=10)


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """raw, stations, lines (routes only where a key needs them)."""
    return {"raw": standin.arrivals(spark, sf_dir), "stations": standin.stations(spark, sf_dir),
            "lines": standin.lines(spark, sf_dir)}


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_location(latest_per_vehicle(standin.arrivals(spark, sf_dir)))


# ---------------------------------------------------------------- W1, P1-P5

@register("latest_per_vehicle", with_ctes(["latest"], "SELECT * FROM latest"))
def latest_q(spark, sf_dir):
    return latest_per_vehicle(standin.arrivals(spark, sf_dir))


@register("location_type", with_ctes(["parsed"], "SELECT * FROM parsed"))
def location_type_q(spark, sf_dir):
    return _parsed(spark, sf_dir)


def _names_over_raw(spark, sf_dir, cols: dict):
    raw = standin.arrivals(spark, sf_dir)
    return raw.select("event_id", "vehicle_id", "line_id", "current_location",
                      *[fn(F.col("current_location")).alias(name) for name, fn in cols.items()])


_RAW_NAMES_SQL = """SELECT event_id, vehicle_id, line_id, current_location, {cols} FROM arrivals"""


@register("between_stations", with_ctes(["arrivals"], _RAW_NAMES_SQL.format(cols="""
    nullif(regexp_extract(current_location, 'Between (.+) and (.+)', 1), '') AS from_station_name,
    nullif(regexp_extract(current_location, 'Between (.+) and (.+)', 2), '') AS to_station_name""")))
def between_q(spark, sf_dir):
    return _names_over_raw(spark, sf_dir, {"from_station_name": L.from_station_name,
                                           "to_station_name": L.to_station_name})


@register("at_station", with_ctes(["arrivals"], _RAW_NAMES_SQL.format(cols="""
    nullif(regexp_extract(current_location, '^At (.+)$', 1), '') AS at_station_name""")))
def at_q(spark, sf_dir):
    return _names_over_raw(spark, sf_dir, {"at_station_name": L.at_station_name})


@register("approaching_station", with_ctes(["arrivals"], _RAW_NAMES_SQL.format(cols="""
    nullif(regexp_extract(current_location, '^Approaching (.+)$', 1), '') AS approaching_station_name""")))
def approaching_q(spark, sf_dir):
    return _names_over_raw(spark, sf_dir, {"approaching_station_name": L.approaching_station_name})


# ---------------------------------------------------------------- J1-J6

_MATCH_FIELDS = ("naptan_id", "station_name", "latitude", "longitude")


def _join_sql(prefix: str, name_col: str, needs: list[str], table: str, on: str) -> str:
    fields = ", ".join(f"m.{c} AS {prefix}_{c}" for c in _MATCH_FIELDS)
    return with_ctes(needs, f"""
        SELECT p.vehicle_id, p.line_id, p.{name_col}, {fields}
        FROM parsed p LEFT JOIN {table} m ON m.line_id = p.line_id AND m.{on} = p.{name_col}""")


def _name_join_sql(prefix: str, name_col: str) -> str:
    return _join_sql(prefix, name_col, ["parsed", "hits"], "hits", "name")


def _name_join(prefix: str, name_col: str) -> Query:
    def q(spark, sf_dir):
        parsed = materialised(_parsed(spark, sf_dir), "parsed")
        out = match_station(parsed, match_names(parsed, standin.stations(spark, sf_dir)), name_col, prefix)
        return out.select("vehicle_id", "line_id", name_col, *[f"{prefix}_{c}" for c in _MATCH_FIELDS])
    return q


for _key, _prefix, _name in [
    ("join_at_station", "s_at", "at_station_name"),
    ("join_approaching", "s_approaching", "approaching_station_name"),
    ("join_from_station", "s_from", "from_station_name"),
    ("join_to_station", "s_to", "to_station_name"),
]:
    register(_key, _name_join_sql(_prefix, _name))(_name_join(_prefix, _name))


@register("join_next_stop", _join_sql("s_dest", "station_naptan_id", ["parsed", "stations"], "stations", "naptan_id"))
def next_stop_q(spark, sf_dir):
    out = next_stop(_parsed(spark, sf_dir), standin.stations(spark, sf_dir), "s_dest")
    return out.select("vehicle_id", "line_id", "station_naptan_id",
                      *[f"s_dest_{c}" for c in ("naptan_id", "station_name", "latitude", "longitude")])


@register("join_line_colours", with_ctes(["parsed", "lines"], """
    SELECT p.vehicle_id, p.line_id, l.colour_hex, l.colour_r, l.colour_g, l.colour_b
    FROM parsed p LEFT JOIN lines l ON l.line_id = p.line_id"""))
def line_colours_q(spark, sf_dir):
    out = line_colours(_parsed(spark, sf_dir), standin.lines(spark, sf_dir))
    return out.select("vehicle_id", "line_id", "colour_hex", "colour_r", "colour_g", "colour_b")


# ---------------------------------------------------------------- X1-X5

@register("progress_fraction", with_ctes(["arrivals"], """
    SELECT event_id, vehicle_id, line_id, time_to_station,
           CASE WHEN time_to_station IS NOT NULL THEN
             least(greatest(CAST(180.0 AS DOUBLE) - CAST(time_to_station AS DOUBLE), CAST(0.0 AS DOUBLE)),
                   CAST(180.0 AS DOUBLE)) / CAST(180.0 AS DOUBLE) END AS progress_fraction
    FROM arrivals"""))
def progress_q(spark, sf_dir):
    raw = standin.arrivals(spark, sf_dir)
    return raw.select("event_id", "vehicle_id", "line_id", "time_to_station",
                      G.progress_fraction(F.col("time_to_station")).alias("progress_fraction"))


@register("interpolated_between", with_ctes(["progress"], """
    SELECT vehicle_id, line_id, from_station_name, to_station_name, time_to_station,
           share AS progress_fraction, latitude, longitude FROM progress"""))
def interpolated_q(spark, sf_dir):
    parsed = materialised(_parsed(spark, sf_dir).where(F.col("location_type") == L.BETWEEN), "parsed")
    matches = match_names(parsed, standin.stations(spark, sf_dir))
    m = match_station(parsed, matches, "from_station_name", "s_from")
    m = match_station(m, matches, "to_station_name", "s_to")
    frac = G.progress_fraction(F.col("time_to_station"))
    return m.select(
        "vehicle_id", "line_id", "from_station_name", "to_station_name", "time_to_station",
        frac.alias("progress_fraction"),
        G.interpolate(F.col("s_from_latitude"), F.col("s_to_latitude"), frac).alias("latitude"),
        G.interpolate(F.col("s_from_longitude"), F.col("s_to_longitude"), frac).alias("longitude"),
    )


@register("positioned", with_ctes(["positioned"], "SELECT * FROM positioned"))
def positioned_q(spark, sf_dir):
    return P.positioned(_parsed(spark, sf_dir), standin.stations(spark, sf_dir))


@register("train_positions", with_ctes(["positions"], "SELECT * FROM positions"))
def train_positions_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return P.train_positions(t["raw"], t["stations"], t["lines"])


# One station per name: the name itself, then the shortest station name, then the id.
_BEST_HITS = """
        SELECT n.line_id, n.name, s.naptan_id, s.station_name, s.latitude, s.longitude
        FROM names n JOIN stations s ON s.line_id = n.line_id AND contains(lower(s.station_name), lower(n.name))
        QUALIFY row_number() OVER (PARTITION BY n.line_id, n.name ORDER BY
            lower(s.station_name) <> lower(n.name), length(s.station_name), s.naptan_id) = 1"""


@register("train_positions_unique", with_ctes(["positions"], "SELECT * FROM positions", overrides={"hits": _BEST_HITS}))
def train_positions_unique_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return P.train_positions(t["raw"], t["stations"], t["lines"], unique=True)


_FRESH_CUTOFF = (FRESH_NOW - FRESH_MAX_AGE).strftime("%Y-%m-%d %H:%M:%S")


@register("train_positions_fresh", with_ctes(
    ["positions"], f"SELECT * FROM positions WHERE timestamp_utc >= TIMESTAMP '{_FRESH_CUTOFF}'"))
def train_positions_fresh_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return P.train_positions(t["raw"], t["stations"], t["lines"], max_age=FRESH_MAX_AGE, now=FRESH_NOW)


@register("unpositioned_counts", with_ctes(["positioned"], """
    SELECT location_type, count(*) AS cnt FROM positioned
    WHERE latitude IS NULL OR longitude IS NULL GROUP BY location_type"""))
def unpositioned_q(spark, sf_dir):
    pos = positioned_q(spark, sf_dir)
    return (pos.where(F.col("latitude").isNull() | F.col("longitude").isNull())
            .groupBy("location_type").agg(F.count(F.lit(1)).alias("cnt")))


# ---------------------------------------------------------------- V1-V8, J7


# Fixed parameter: the lines picked in the dashboard's filter for V2, V3, V6,
# three of the stand-in's five.
PICKED_LINES = ("africa", "asia", "europe")
_PICKED_SQL = ", ".join(f"'{x}'" for x in PICKED_LINES)
SAMPLE_LINE = "europe"
FRESHNESS_NOW = dt.datetime(2024, 2, 1, 0, 0, 0)


def _positions(spark, sf_dir):
    return train_positions_q(spark, sf_dir)


@register("line_picker", with_ctes(["lines"], "SELECT line_id, line_name, colour_hex FROM lines"))
def line_picker_q(spark, sf_dir):
    return V.line_picker(standin.lines(spark, sf_dir))


@register("trains_on_lines", with_ctes(["positions"], f"""
    SELECT vehicle_id, line_id, line_name, direction, destination_name, current_location, location_type,
           time_to_station, towards, timestamp_utc, latitude, longitude,
           colour_hex, colour_r, colour_g, colour_b
    FROM positions WHERE line_id IN ({_PICKED_SQL})"""))
def trains_on_q(spark, sf_dir):
    return V.trains_on(_positions(spark, sf_dir), PICKED_LINES)


@register("header_metrics", with_ctes(["positions"], """
    SELECT count(*) AS active_trains, count(DISTINCT line_id) AS lines_active,
           CASE WHEN count(*) = 0 THEN 'No data' WHEN max(timestamp_utc) IS NULL THEN 'N/A'
                ELSE strftime(max(timestamp_utc), '%Y-%m-%d %H:%M:%S') END AS last_update
    FROM positions"""))
def header_q(spark, sf_dir):
    return V.header_metrics(_positions(spark, sf_dir))


@register("route_colours", with_ctes(["lines"], """
    SELECT line_id, colour_hex, [colour_r, colour_g, colour_b, 180] AS colour FROM lines"""))
def route_colours_q(spark, sf_dir):
    return V.route_colours(standin.lines(spark, sf_dir))


@register("route_paths", with_ctes(["routes", "lines"], """
    SELECT line_id, direction, CAST(generate_subscripts(segs, 1) - 1 AS INTEGER) AS segment, unnest(segs) AS path,
           [coalesce(r, 128), coalesce(g, 128), coalesce(b, 128), 180] AS colour
    FROM segments""", extra={
        "first_colour": """SELECT line_id, arg_min(colour_hex, line_name) AS colour_hex FROM lines GROUP BY line_id""",
        "segments": f"""
        SELECT r.line_id, r.direction,
               CASE WHEN json_type(r.coordinates, '$[0][0]') = 'ARRAY'
                    THEN from_json(r.coordinates, '[[["DOUBLE"]]]')
                    ELSE [from_json(r.coordinates, '[["DOUBLE"]]')] END AS segs,
               CAST(('0x' || substr(c.colour_hex, 2, 2)) AS INTEGER) AS r,
               CAST(('0x' || substr(c.colour_hex, 4, 2)) AS INTEGER) AS g,
               CAST(('0x' || substr(c.colour_hex, 6, 2)) AS INTEGER) AS b
        FROM routes r LEFT JOIN first_colour c ON c.line_id = r.line_id
        WHERE r.line_id IN ({_PICKED_SQL}) AND r.direction = 'inbound'"""}))
def route_paths_q(spark, sf_dir):
    return V.route_paths(standin.routes(spark, sf_dir), standin.lines(spark, sf_dir), PICKED_LINES)


@register("train_markers", with_ctes(["positions"], """
    SELECT vehicle_id, line_id, line_name, towards, current_location, longitude, latitude,
           [colour_r, colour_g, colour_b, 220] AS colour FROM positions"""))
def train_markers_q(spark, sf_dir):
    return V.train_markers(_positions(spark, sf_dir))


@register("trains_per_line", with_ctes(["positions"], """
    SELECT line_name, count(*) AS trains FROM positions WHERE line_name IS NOT NULL GROUP BY line_name"""))
def trains_per_line_q(spark, sf_dir):
    return V.trains_per_line(_positions(spark, sf_dir))


# ---------------------------------------------------------------- H1-H10

@register("raw_volume", with_ctes(["arrivals"], """
    SELECT count(*) AS total_rows, count(DISTINCT ingestion_id) AS batches FROM arrivals"""))
def raw_volume_q(spark, sf_dir):
    return H.raw_volume(standin.arrivals(spark, sf_dir))


@register("active_trains", with_ctes(["positions"], """
    SELECT count(*) AS active_trains, count(DISTINCT line_id) AS lines_active FROM positions"""))
def active_trains_q(spark, sf_dir):
    return H.active_trains(_positions(spark, sf_dir))


@register("line_sample", with_ctes(["positions"], f"""
    SELECT line_name, vehicle_id, current_location, latitude, longitude FROM positions
    WHERE line_id = '{SAMPLE_LINE}'
    ORDER BY line_name ASC NULLS FIRST, vehicle_id ASC NULLS FIRST, current_location ASC NULLS FIRST,
             latitude ASC NULLS FIRST, longitude ASC NULLS FIRST
    LIMIT 10"""))
def line_sample_q(spark, sf_dir):
    return H.line_sample(_positions(spark, sf_dir), SAMPLE_LINE)


@register("position_sample", with_ctes(["positions"], """
    SELECT line_name, vehicle_id, current_location, location_type, latitude, longitude, colour_hex
    FROM positions
    ORDER BY line_name ASC NULLS FIRST, vehicle_id ASC NULLS FIRST, current_location ASC NULLS FIRST,
             location_type ASC NULLS FIRST, latitude ASC NULLS FIRST, longitude ASC NULLS FIRST,
             colour_hex ASC NULLS FIRST
    LIMIT 20"""))
def position_sample_q(spark, sf_dir):
    return H.position_sample(_positions(spark, sf_dir))


@register("predictions_per_line", with_ctes(["arrivals"], """
    SELECT line_id, count(*) AS predictions FROM arrivals GROUP BY line_id"""))
def predictions_per_line_q(spark, sf_dir):
    return H.predictions_per_line(standin.arrivals(spark, sf_dir))


@register("location_type_counts", with_ctes(["positions"], """
    SELECT location_type, count(*) AS cnt FROM positions GROUP BY location_type"""))
def location_type_counts_q(spark, sf_dir):
    return H.location_type_counts(_positions(spark, sf_dir))


@register("table_counts", with_ctes(["arrivals", "stations", "lines", "routes", "positions"], """
    SELECT 'RAW_ARRIVALS' AS table_name, count(*) AS row_count FROM arrivals
    UNION ALL SELECT 'REF_STATIONS', count(*) FROM stations
    UNION ALL SELECT 'REF_LINES', count(*) FROM lines
    UNION ALL SELECT 'REF_LINE_ROUTES', count(*) FROM routes
    UNION ALL SELECT 'TRAIN_POSITIONS', count(*) FROM positions"""))
def table_counts_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return H.table_counts({
        "RAW_ARRIVALS": t["raw"], "REF_STATIONS": t["stations"], "REF_LINES": t["lines"],
        "REF_LINE_ROUTES": standin.routes(spark, sf_dir),
        "TRAIN_POSITIONS": P.train_positions(t["raw"], t["stations"], t["lines"]),
    })


@register("freshness", with_ctes(["arrivals"], f"""
    SELECT max(timestamp_utc) AS latest_ingestion,
           epoch_us(date_trunc('second', TIMESTAMP '{FRESHNESS_NOW:%Y-%m-%d %H:%M:%S}')) // 1000000
           - epoch_us(date_trunc('second', max(timestamp_utc))) // 1000000 AS lag_seconds
    FROM arrivals"""))
def freshness_q(spark, sf_dir):
    return H.freshness(standin.arrivals(spark, sf_dir), FRESHNESS_NOW)


def _stored_raw(spark, sf_dir) -> str:
    path = f"{scratch_path(spark, 'stored')}/raw"
    I.append_raw(standin.arrivals(spark, sf_dir), path)
    return path


@register("stored_counts", with_ctes(["arrivals", "stations", "lines", "routes"], """
    SELECT 'RAW_ARRIVALS' AS table_name, count(*) AS row_count FROM arrivals
    UNION ALL SELECT 'REF_STATIONS', count(*) FROM stations
    UNION ALL SELECT 'REF_LINES', count(*) FROM lines
    UNION ALL SELECT 'REF_LINE_ROUTES', count(*) FROM routes"""))
def stored_counts_q(spark, sf_dir):
    """H7 over written tables: every count comes from file footers."""
    tables = {"RAW_ARRIVALS": I.raw_footers(spark, _stored_raw(spark, sf_dir))}
    base = scratch_path(spark, "refs")
    for name, df in (("REF_STATIONS", standin.stations(spark, sf_dir)), ("REF_LINES", standin.lines(spark, sf_dir)),
                     ("REF_LINE_ROUTES", standin.routes(spark, sf_dir))):
        df.write.parquet(f"{base}/{name}")
        tables[name] = footer_table(spark, f"{base}/{name}")
    return H.table_counts(tables)


@register("stored_freshness", ORACLE["freshness"])
def stored_freshness_q(spark, sf_dir):
    """H8 over the written raw table: the newest day from footers, then that day's timestamps."""
    path = _stored_raw(spark, sf_dir)
    return H.stored_freshness(I.read_raw(spark, path), I.raw_days(spark, path), FRESHNESS_NOW)


@register("route_lengths", with_ctes(["routes"], """
    SELECT line_id, direction, CAST(length(coordinates) AS INTEGER) AS coord_length FROM routes
    ORDER BY line_id, direction LIMIT 5"""))
def route_lengths_q(spark, sf_dir):
    return H.route_lengths(standin.routes(spark, sf_dir))


# ---------------------------------------------------------------- S1-S11


# Fixed parameters: the stamp of one ingest run for S5.
RUN_ID = "0b7e4a52-6f1c-4d8e-9a3b-2c5d7e9f1a00"
RUN_SECOND = dt.datetime(2024, 2, 1, 12, 0, 0)


def _flat(spark, sf_dir, ingestion_id=None, timestamp_utc=None):
    return I.flatten_predictions(I.explode_predictions(standin.payloads(spark, sf_dir)), ingestion_id, timestamp_utc)


def _good_and_rejected(spark, sf_dir, ingestion_id=None, timestamp_utc=None):
    return I.split_rejects(_flat(spark, sf_dir, ingestion_id, timestamp_utc))


@register("predictions_parsed", with_ctes(["arrivals", "faults"], """
    SELECT ingestion_id, line_id, vehicle_id, current_location,
           CAST(time_to_station AS VARCHAR) AS time_to_station_text, event_id FROM arrivals
    UNION ALL
    SELECT ingestion_id, line_id, NULL, NULL, CASE WHEN event_id IS NOT NULL THEN 'soon' END, event_id FROM faults"""))
def predictions_parsed_q(spark, sf_dir):
    preds = I.explode_predictions(standin.payloads(spark, sf_dir))
    m = F.col("prediction")
    return preds.select("ingestion_id", "line_id", m["vehicleId"].alias("vehicle_id"),
                        m["currentLocation"].alias("current_location"),
                        m["timeToStation"].alias("time_to_station_text"),
                        m["id"].cast("long").alias("event_id"))


@register("predictions_rejected", with_ctes(["faults"], """
    SELECT ingestion_id, line_id, reject_reason, prediction_json FROM faults"""))
def predictions_rejected_q(spark, sf_dir):
    return _good_and_rejected(spark, sf_dir)[1]


@register("raw_arrivals", with_ctes(["arrivals"], "SELECT * FROM arrivals"))
def raw_arrivals_q(spark, sf_dir):
    return _good_and_rejected(spark, sf_dir)[0]


@register("expected_arrival", with_ctes(["arrivals"], """
    SELECT event_id, vehicle_id, line_id, expected_arrival FROM arrivals"""))
def expected_arrival_q(spark, sf_dir):
    return _good_and_rejected(spark, sf_dir)[0].select("event_id", "vehicle_id", "line_id", "expected_arrival")


@register("batch_stamp", with_ctes(["arrivals"], f"""
    SELECT '{RUN_ID}' AS ingestion_id, TIMESTAMP '{RUN_SECOND:%Y-%m-%d %H:%M:%S}' AS timestamp_utc,
           count(*) AS row_count FROM arrivals"""))
def batch_stamp_q(spark, sf_dir):
    good, _ = _good_and_rejected(spark, sf_dir, RUN_ID, RUN_SECOND)
    return good.groupBy("ingestion_id", "timestamp_utc").agg(F.count(F.lit(1)).alias("row_count"))


@register("append_by_name", with_ctes(["arrivals"], "SELECT * FROM arrivals"))
def append_by_name_q(spark, sf_dir):
    good, _ = _good_and_rejected(spark, sf_dir)
    # Upper-case names in reverse order: the sink matches them by name.
    shuffled = good.select(*[F.col(c).alias(c.upper()) for c in reversed(good.columns)])
    path = scratch_path(spark, "raw_arrivals")
    I.append_raw(shuffled, path)
    return I.read_raw(spark, path).drop("ingest_date")


@register("ingest_report", with_ctes(["arrivals", "faults"], """
    SELECT ingestion_id, count(*) FILTER (kind = 'good') AS rows_inserted,
           count(*) FILTER (kind = 'timeToStation is not an integer') AS rows_errored,
           count(*) FILTER (kind = 'unparseable payload') AS payloads_skipped
    FROM (SELECT ingestion_id, 'good' AS kind FROM arrivals UNION ALL SELECT ingestion_id, reject_reason FROM faults)
    GROUP BY ingestion_id"""))
def ingest_report_q(spark, sf_dir):
    return I.ingest_report(_flat(spark, sf_dir))


@register("ref_stations", with_ctes(["stations"], "SELECT * FROM stations"))
def ref_stations_q(spark, sf_dir):
    return R.load_stations(standin.stop_documents(spark, sf_dir))


@register("ref_line_routes", with_ctes(["routes"], "SELECT * FROM routes"))
def ref_line_routes_q(spark, sf_dir):
    return R.load_routes(standin.route_documents(spark, sf_dir))


@register("ref_lines", with_ctes(["lines"], "SELECT * FROM lines"))
def ref_lines_q(spark, sf_dir):
    return R.load_lines(spark, standin.line_metadata(spark, sf_dir))


@register("load_summary", with_ctes(["stations", "routes", "lines"], """
    SELECT s.n AS stations, r.n AS routes, l.n AS lines,
           printf('Reference data loaded: %d stations, %d routes, %d lines', s.n, r.n, l.n) AS summary
    FROM (SELECT count(*) AS n FROM stations) s, (SELECT count(*) AS n FROM routes) r,
         (SELECT count(*) AS n FROM lines) l"""))
def load_summary_q(spark, sf_dir):
    return R.load_summary(R.load_stations(standin.stop_documents(spark, sf_dir)),
                          R.load_routes(standin.route_documents(spark, sf_dir)),
                          standin.lines(spark, sf_dir))


# ---------------------------------------------------------------- M1-M5


AVAILABLE_NOW = {"availableNow": True}


def _landing(spark, sf_dir) -> str:
    """Write the stand-in payloads as landing files (one record per line)."""
    path = scratch_path(spark, "landing")
    standin.payloads(spark, sf_dir).write.json(path)
    return path


def _ingested(spark, sf_dir) -> tuple[str, str]:
    base = scratch_path(spark, "live")
    raw_dir = f"{base}/raw"
    M.ingest_available(spark, _landing(spark, sf_dir), raw_dir, f"{base}/ckpt")
    return base, raw_dir


@register("stream_raw_arrivals", with_ctes(["arrivals"], "SELECT * FROM arrivals"))
def stream_raw_q(spark, sf_dir):
    _, raw_dir = _ingested(spark, sf_dir)
    return I.read_raw(spark, raw_dir).drop("ingest_date")


@register("stream_rejected", with_ctes(["faults"], """
    SELECT ingestion_id, line_id, reject_reason, prediction_json FROM faults"""))
def stream_rejected_q(spark, sf_dir):
    """The live ingest keeps what it rejects."""
    _, raw_dir = _ingested(spark, sf_dir)
    return I.read_rejects(spark, raw_dir)


@register("stream_ingest_report", with_ctes(["arrivals", "faults"], """
    SELECT a.n AS rows_inserted, f.errored AS rows_errored, f.skipped AS payloads_skipped, a.n + f.errored AS token
    FROM (SELECT count(*) AS n FROM arrivals) a,
         (SELECT count(*) FILTER (reject_reason = 'timeToStation is not an integer') AS errored,
                 count(*) FILTER (reject_reason = 'unparseable payload') AS skipped FROM faults) f"""))
def stream_ingest_report_q(spark, sf_dir):
    """S7 live: the commit log of an ingest in several micro-batches, over two runs."""
    base = scratch_path(spark, "commits")
    landing = f"{base}/landing"
    half = F.col("line_id") < "asia"
    for part in (half, ~half):
        standin.payloads(spark, sf_dir).where(part).write.mode("append").json(landing)
        M.ingest_available(spark, landing, f"{base}/raw", f"{base}/ckpt", max_files_per_trigger=16)
    return C.commit_report(C.read_commits(spark, f"{base}/ckpt/commits"))


@register("stream_polls", with_ctes(["arrivals"], "SELECT * FROM arrivals"))
def stream_polls_q(spark, sf_dir):
    """S1 as a streaming source: the ingest reads numbered poll cycles; a second run goes on after the last one read."""
    base = scratch_path(spark, "polls")
    landing = f"{base}/landing"
    cycle = F.datediff(F.to_date("timestamp_utc"), F.lit("2024-01-01").cast("date"))
    pays = standin.payloads(spark, sf_dir).withColumn("cycle", cycle)
    early = F.col("cycle") < 15
    for part in (early, ~early):
        pays.where(part).repartition("cycle").write.mode("append").partitionBy("cycle").json(landing)
        M.ingest_available(spark, landing, f"{base}/raw", f"{base}/ckpt", polls=True)
    return I.read_raw(spark, f"{base}/raw").drop("ingest_date")


@register("stream_latest", with_ctes(["latest"], "SELECT * FROM latest"))
def stream_latest_q(spark, sf_dir):
    base, raw_dir = _ingested(spark, sf_dir)
    out = f"{base}/latest"
    M.run_available(M.start_view(spark, raw_dir, out, f"{base}/ckpt", trigger=AVAILABLE_NOW))
    return M.read_view(spark, out)


def _reference_paths(spark, sf_dir, base, without_line: str | None = None) -> tuple[str, str]:
    paths = f"{base}/ref_stations", f"{base}/ref_lines"
    stations = R.load_stations(standin.stop_documents(spark, sf_dir))
    R.replace_table(stations.where(F.col("line_id") != without_line) if without_line else stations, paths[0])
    R.replace_table(standin.lines(spark, sf_dir), paths[1])
    return paths


def positions_over(spark, sf_dir, landing: str):
    """The live path over landing files: ingest stream, live view, its positions."""
    base = scratch_path(spark, "live")
    raw_dir, out = f"{base}/raw", f"{base}/positions"
    M.ingest_available(spark, landing, raw_dir, f"{base}/ckpt")
    M.run_available(M.start_positions(spark, raw_dir, *_reference_paths(spark, sf_dir, base), out,
                                      f"{base}/ckpt", AVAILABLE_NOW))
    return M.read_positions(spark, out)


@register("stream_positions", with_ctes(["positions"], "SELECT * FROM positions"))
def stream_positions_q(spark, sf_dir):
    return positions_over(spark, sf_dir, _landing(spark, sf_dir))


@register("view_refresh", with_ctes(["positions"], "SELECT * FROM positions"))
def view_refresh_q(spark, sf_dir):
    """M4 as a scheduled refresh: the stream over raw runs ``availableNow``
    twice; the second part of raw holds older days than the first."""
    base = scratch_path(spark, "refresh")
    raw_dir, out = f"{base}/raw", f"{base}/view"
    raw = standin.arrivals(spark, sf_dir)
    paths = _reference_paths(spark, sf_dir, base)
    late = F.col("timestamp_utc") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (raw.where(~late), raw.where(late)):
        I.append_raw(part, raw_dir)
        M.run_available(M.start_positions(spark, raw_dir, *paths, out, f"{base}/ckpt", AVAILABLE_NOW))
    return M.read_positions(spark, out)


@register("view_reloaded", with_ctes(["positions"], "SELECT * FROM positions"))
def view_reloaded_q(spark, sf_dir):
    """M3: the first trigger knows no station of one line; then the stations are
    reloaded, and the next trigger places what it changes and all rows of the older version."""
    base = scratch_path(spark, "reload")
    raw_dir, out = f"{base}/raw", f"{base}/view"
    raw = standin.arrivals(spark, sf_dir)
    late = F.col("timestamp_utc") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for part, missing in ((raw.where(~late), "asia"), (raw.where(late), None)):
        I.append_raw(part, raw_dir)
        paths = _reference_paths(spark, sf_dir, base, missing)
        M.run_available(M.start_positions(spark, raw_dir, *paths, out, f"{base}/ckpt", AVAILABLE_NOW))
    return M.read_positions(spark, out)


@register("stream_positions_folded", with_ctes(["positions"], "SELECT * FROM positions"))
def stream_positions_folded_q(spark, sf_dir):
    """M2-M4 with raw read in several bounded micro-batches, each folded into the state. The ingest writes about two
    files a day (good and rejected rows) and more for large days only, so the batches grow with the bytes, not the tasks."""
    base, raw_dir = _ingested(spark, sf_dir)
    out = f"{base}/positions"
    M.run_available(M.start_positions(spark, raw_dir, *_reference_paths(spark, sf_dir, base), out, f"{base}/ckpt",
                                      AVAILABLE_NOW, max_files_per_trigger=16))
    return M.read_positions(spark, out)

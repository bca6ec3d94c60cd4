"""Health and verification queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_COLUMNS = ["line_name", "vehicle_id", "current_location", "latitude", "longitude"]
POSITION_SAMPLE_COLUMNS = ["line_name", "vehicle_id", "current_location", "location_type",
                           "latitude", "longitude", "colour_hex"]


def raw_volume(raw: DataFrame) -> DataFrame:
    """H1: rows and distinct ingestion batches."""
    return raw.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct("ingestion_id").alias("batches"))


def active_trains(positions: DataFrame) -> DataFrame:
    """H2: positioned rows and distinct lines."""
    return positions.agg(F.count(F.lit(1)).alias("active_trains"),
                         F.count_distinct("line_id").alias("lines_active"))


def line_sample(positions: DataFrame, line_id: str, n: int = 10) -> DataFrame:
    """H3: a sample of one line; ordered so the sample is the same every run."""
    return (positions.where(F.col("line_id") == F.lit(line_id)).select(*SAMPLE_COLUMNS)
            .orderBy(*SAMPLE_COLUMNS).limit(n))


def position_sample(positions: DataFrame, n: int = 20) -> DataFrame:
    """H4: top-n by line name, vehicle id (remaining columns break ties)."""
    return positions.select(*POSITION_SAMPLE_COLUMNS).orderBy(*POSITION_SAMPLE_COLUMNS).limit(n)


def predictions_per_line(raw: DataFrame) -> DataFrame:
    """H5: raw predictions per line, descending."""
    return (raw.groupBy("line_id").agg(F.count(F.lit(1)).alias("predictions"))
            .orderBy(F.col("predictions").desc(), "line_id"))


def location_type_counts(positions: DataFrame) -> DataFrame:
    """H6: rows per location class."""
    return positions.groupBy("location_type").agg(F.count(F.lit(1)).alias("cnt"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """H7: one (table_name, row_count) row per table, by UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _epoch_seconds(ts: Column) -> Column:
    # Whole seconds since the epoch of a UTC wall-clock timestamp (T7: the
    # session zone is UTC, so the ntz -> ltz cast keeps the wall clock).
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)).cast("long")


def freshness(raw: DataFrame, now: dt.datetime | Column | None = None) -> DataFrame:
    """H8: latest ingestion and the seconds from it to ``now`` (boundaries
    crossed, A5). ``now`` defaults to the current time."""
    if now is None:
        now_col = F.current_timestamp()
    elif isinstance(now, Column):
        now_col = now
    else:
        now_col = F.lit(now).cast("timestamp_ntz")
    latest = F.max("timestamp_utc")
    return raw.agg(latest.alias("latest_ingestion"),
                   (_epoch_seconds(now_col) - _epoch_seconds(latest)).alias("lag_seconds"))


def stored_freshness(stored: DataFrame, days: DataFrame, now: dt.datetime | Column | None = None) -> DataFrame:
    """H8 over a raw table partitioned by ``ingest_date``: the newest day comes from ``days``
    (ingest_date, n; ``ingest.raw_days`` gets them from footers), and only that day's timestamps are read."""
    newest = days.where("n > 0").agg(F.max("ingest_date").alias("day")).scalar()
    return freshness(stored.where(F.col("ingest_date").eqNullSafe(newest)), now)


def route_lengths(routes: DataFrame, n: int = 5) -> DataFrame:
    """H9: length of the route JSON text, a sample of n (ordered)."""
    from .views import coordinates_text
    return (routes.select("line_id", "direction", F.length(coordinates_text(routes)).alias("coord_length"))
            .orderBy("line_id", "direction").limit(n))

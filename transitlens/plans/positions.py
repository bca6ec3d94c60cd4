"""The TRAIN_POSITIONS view as one DataFrame plan.

raw -> latest per vehicle (W1) -> parse location (P1-P5) -> five station
matches (J1-J5) -> position CASE (X3) -> line colours (J6) -> drop rows
without a position (X4).

Physical shape (see README "Plans"): one hash shuffle for W1, pre-aggregated
map-side, whose rows are written once; the distinct names are matched once and
joined back on (line, name).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import location as L
from ..operators.latest import latest_per_vehicle
from ..operators.station_match import line_colours, match_names, match_station, next_stop
from ..schemas import PARSED_BASE, TIE_COLUMN, TRAIN_POSITIONS
from ..session import materialised

# (prefix of the joined station columns, name column) per name match.
NAME_MATCHES = [
    ("s_at", "at_station_name"),
    ("s_approaching", "approaching_station_name"),
    ("s_from", "from_station_name"),
    ("s_to", "to_station_name"),
]


def parse_location(latest: DataFrame) -> DataFrame:
    """Project the parsed set and add the class and four names."""
    loc = F.col("current_location")
    return latest.select(
        *PARSED_BASE,
        L.location_type(loc).alias("location_type"),
        L.from_station_name(loc).alias("from_station_name"),
        L.to_station_name(loc).alias("to_station_name"),
        L.at_station_name(loc).alias("at_station_name"),
        L.approaching_station_name(loc).alias("approaching_station_name"),
    )


def with_station_matches(parsed: DataFrame, stations: DataFrame, unique: bool = False) -> DataFrame:
    """At, approaching, next stop, from, to.

    The parsed rows (one per vehicle and line) are written to the shared folder
    first, since both the names and the joins read them; otherwise W1 would run
    twice. ``unique=True`` keeps the best station of every name (see ``match_names``).
    """
    parsed = materialised(parsed, "parsed")
    matches = match_names(parsed, stations, unique)
    out = parsed
    for prefix, name_col in NAME_MATCHES:
        out = match_station(out, matches, name_col, prefix)
    return next_stop(out, stations, "s_dest", unique)


def _position(axis: str, fraction: Column) -> Column:
    """LEFT and DEPARTED trains, like all others, stand at their next stop."""
    lt = F.col("location_type")
    return (
        F.when(lt == L.AT_STATION, F.col(f"s_at_{axis}"))
        .when(lt == L.APPROACHING, F.coalesce(F.col(f"s_approaching_{axis}"), F.col(f"s_dest_{axis}")))
        .when(lt == L.BETWEEN, G.interpolate(F.col(f"s_from_{axis}"), F.col(f"s_to_{axis}"), fraction))
        .otherwise(F.col(f"s_dest_{axis}"))
    )


def positioned(parsed: DataFrame, stations: DataFrame, unique: bool = False) -> DataFrame:
    """Parsed rows with latitude / longitude (NULL when unplaced; before X4)."""
    matched = with_station_matches(parsed, stations, unique)
    frac = G.progress_fraction(F.col("time_to_station"))
    return matched.select(
        *parsed.columns,
        _position("latitude", frac).alias("latitude"),
        _position("longitude", frac).alias("longitude"),
    )


def _fresh_raw(raw: DataFrame, max_age: dt.timedelta | None, now) -> tuple[DataFrame, Column | None]:
    """Pre-filter for max_age that keeps W1's answer: a NULL timestamp still
    wins W1 (and is then dropped), so it is kept until after W1. The filter on
    timestamp_utc reaches the scan, which prunes ingest-date partitions."""
    if max_age is None:
        return raw, None
    now_col = F.lit(now).cast("timestamp_ntz") if now is not None else F.current_timestamp().cast("timestamp_ntz")
    cutoff = now_col - F.make_dt_interval(secs=F.lit(max_age.total_seconds()))
    keep = F.col("timestamp_utc") >= cutoff
    pre = keep | F.col("timestamp_utc").isNull()
    if "ingest_date" in raw.columns:
        # Raw written by append_raw is partitioned by ingest date: prune days.
        pre = pre & ((F.col("ingest_date") >= F.to_date(cutoff)) | F.col("ingest_date").isNull())
    return raw.where(pre), keep


def prune_raw(raw: DataFrame) -> DataFrame:
    """Only the columns the view reads (plus the W1 tie-break, if any). Done
    before W1, so unused raw columns are neither scanned (ReadSchema) nor
    carried through its shuffle or kept in streaming state."""
    keep = [c for c in PARSED_BASE + [TIE_COLUMN, "ingest_date"] if c in raw.columns]
    return raw.select(*keep)


def is_placed() -> Column:
    """A row has a position."""
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def placed(latest: DataFrame, stations: DataFrame, lines: DataFrame, unique: bool = False) -> DataFrame:
    """X3 -> J6 on rows that are already one per (vehicle, line), those without a position included."""
    return line_colours(positioned(parse_location(latest), stations, unique), lines).select(*PARSED_BASE, *[c for c in TRAIN_POSITIONS if c not in PARSED_BASE])


def positions_from_latest(latest: DataFrame, stations: DataFrame, lines: DataFrame,
                          unique: bool = False) -> DataFrame:
    """X3 -> X4 -> J6 on rows that are already one per (vehicle, line)."""
    pos = positioned(parse_location(latest), stations, unique)
    return line_colours(pos.where(is_placed()), lines).select(*TRAIN_POSITIONS)


def latest_for_view(raw: DataFrame) -> DataFrame:
    """W1 over the pruned raw columns (the live view's state)."""
    return latest_per_vehicle(prune_raw(raw))


def train_positions(raw: DataFrame, stations: DataFrame, lines: DataFrame, unique: bool = False,
                    max_age: dt.timedelta | None = None, now=None) -> DataFrame:
    """The TRAIN_POSITIONS view.

    ``unique=True`` keeps one row per (vehicle, line) by preferring, per
    name, the exact name, then the shortest station name, then the naptan id.
    The latest rows are computed and written when this is called.
    ``max_age`` drops vehicles whose latest prediction is older than
    ``now - max_age`` (``now`` defaults to the current time).
    """
    raw, keep = _fresh_raw(prune_raw(raw), max_age, now)
    latest = latest_per_vehicle(raw)
    if keep is not None:
        latest = latest.where(keep)
    return positions_from_latest(latest, stations, lines, unique)

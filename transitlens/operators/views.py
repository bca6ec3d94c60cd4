"""The datasets behind the map, as DataFrames.

Only these results would be collected by a dashboard; every step before
that stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions import geometry as G

DASHBOARD_COLUMNS = [
    "vehicle_id", "line_id", "line_name", "direction", "destination_name", "current_location",
    "location_type", "time_to_station", "towards", "timestamp_utc", "latitude", "longitude",
    "colour_hex", "colour_r", "colour_g", "colour_b",
]
ROUTE_DEPTH3 = "array<array<array<double>>>"
ROUTE_DEPTH2 = "array<array<double>>"
# Types of VARIANT values that are paths: three levels of lists (any of which may be empty), and two.
_NUMBER = r"(DOUBLE|FLOAT|BIGINT|DECIMAL\([0-9]+,[0-9]+\))"
DEEP = rf"^ARRAY<(VOID|ARRAY<(VOID|ARRAY<(VOID|{_NUMBER})>)>)>$"
FLAT = rf"^ARRAY<ARRAY<{_NUMBER}>>$"


def line_picker(lines: DataFrame) -> DataFrame:
    """V1: id, name, hex ordered by name."""
    return lines.select("line_id", "line_name", "colour_hex").orderBy("line_name", "line_id")


def _in_lines(ids: Sequence[str]):
    # Values go in as literals, never spliced into SQL text. isin([]) is
    # false, so an empty selection gives no rows rather than all of them.
    return F.col("line_id").isin(list(ids)) if ids else F.lit(False)


def trains_on(positions: DataFrame, ids: Sequence[str]) -> DataFrame:
    """V2: positioned trains of the selected lines (the dashboard's columns)."""
    return positions.where(_in_lines(ids)).select(*DASHBOARD_COLUMNS)


def route_colours(lines: DataFrame, alpha: int = G.ROUTE_ALPHA) -> DataFrame:
    """V5: [r, g, b, alpha] per line from its hex colour."""
    return lines.select("line_id", "colour_hex", G.hex_rgb(F.col("colour_hex"), alpha).alias("colour"))


def coordinates_text(routes: DataFrame) -> F.Column:
    """The route coordinates as JSON text, whether the column holds text or a
    VARIANT (the table declares VARIANT, the loader writes text)."""
    if isinstance(routes.schema["coordinates"].dataType, VariantType):
        return F.to_json(F.col("coordinates"))
    return F.col("coordinates")


def coordinates_variant(routes: DataFrame) -> F.Column:
    """The route coordinates as VARIANT; text is parsed once, and text that is no JSON fails the query."""
    c = F.col("coordinates")
    return c if isinstance(routes.schema["coordinates"].dataType, VariantType) else F.parse_json(c)


def route_segments(coordinates) -> F.Column:
    """V6: a route's list of paths, from VARIANT coordinates. Lists of three levels are segments,
    lists of two levels one path; the value's own type tells which."""
    c = F.col(coordinates) if isinstance(coordinates, str) else coordinates
    kind = F.schema_of_variant(c)
    bad = F.raise_error(F.concat(F.lit("route coordinates are no paths but "), kind))
    return (F.when(kind.rlike(DEEP), F.variant_get(c, "$", ROUTE_DEPTH3))
            .when(kind.rlike(FLAT), F.array(F.variant_get(c, "$", ROUTE_DEPTH2)))
            .when(c.isNotNull(), bad.cast(ROUTE_DEPTH3)))


def route_paths(routes: DataFrame, lines: DataFrame, ids: Sequence[str],
                direction: str = "inbound") -> DataFrame:
    """V3 + J7 + V6: one row per path segment of the selected lines, coloured.

    The line colour is the first match in line-name order; unknown lines
    are grey. Empty paths are dropped (T6); coordinates that are no JSON paths
    fail the query instead of vanishing.
    """
    sel = routes.where(_in_lines(ids) & (F.col("direction") == direction)).withColumn(
        "coordinates", coordinates_variant(routes))
    first = (lines.groupBy("line_id")
             .agg(F.min_by("colour_hex", F.struct("line_name", "colour_hex")).alias("colour_hex")))
    rgb = [F.coalesce(G.hex_channel(F.col("colour_hex"), i), F.lit(G.GREY)) for i in range(3)]
    return (
        sel.join(first, "line_id", "left")
        .select("line_id", "direction",
                F.posexplode(route_segments("coordinates")).alias("segment", "path"),
                F.array(*rgb, F.lit(G.ROUTE_ALPHA)).alias("colour"))
        .where(F.size("path") > 0)
    )


def header_metrics(positions: DataFrame) -> DataFrame:
    """V4: one row with the three header figures of the dashboard."""
    n = F.count(F.lit(1))
    latest = F.max("timestamp_utc")
    return positions.agg(
        n.alias("active_trains"),
        F.count_distinct("line_id").alias("lines_active"),
        F.when(n == 0, F.lit("No data"))
        .when(latest.isNull(), F.lit("N/A"))
        .otherwise(F.date_format(latest, "yyyy-MM-dd HH:mm:ss")).alias("last_update"),
    )


def train_markers(positions: DataFrame, alpha: int = G.MARKER_ALPHA) -> DataFrame:
    """V7: marker position, [r, g, b, alpha] colour (NULL-safe) and the tooltip's columns."""
    return positions.select(
        "vehicle_id", "line_id", "line_name", "towards", "current_location", "longitude", "latitude",
        F.array("colour_r", "colour_g", "colour_b", F.lit(alpha)).alias("colour"),
    )


def trains_per_line(positions: DataFrame) -> DataFrame:
    """V8: rows per line name, descending; NULL names dropped as pandas does."""
    return (positions.where(F.col("line_name").isNotNull())
            .groupBy("line_name").agg(F.count(F.lit(1)).alias("trains"))
            .orderBy(F.col("trains").desc(), F.col("line_name")))

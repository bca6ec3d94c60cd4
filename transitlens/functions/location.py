"""Location text: classification (P1) and station-name extraction.

All Column -> Column, built-in expressions only, so they run inside
whole-stage codegen and work unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The location classes, their case-sensitive prefixes and the
# extraction patterns, as the reference's view defines them.
AT_STATION = "AT_STATION"
BETWEEN = "BETWEEN"
APPROACHING = "APPROACHING"
DEPARTED = "DEPARTED"
OTHER = "OTHER"
BETWEEN_PATTERN = "Between (.+) and (.+)"
AT_PATTERN = "^At (.+)$"
APPROACHING_PATTERN = "^Approaching (.+)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def location_type(current_location) -> Column:
    """First matching prefix wins; NULL and '' fall through to OTHER."""
    c = _col(current_location)
    return (
        F.when(c.startswith("At "), F.lit(AT_STATION))
        .when(c.startswith("Between "), F.lit(BETWEEN))
        .when(c.startswith("Approaching "), F.lit(APPROACHING))
        .when(c.startswith("Left ") | c.startswith("Departed "), F.lit(DEPARTED))
        .otherwise(F.lit(OTHER))
    )


def extract(current_location, pattern: str, group: int) -> Column:
    """Regex group or NULL when there is no match (T1: never '')."""
    return F.nullif(F.regexp_extract(_col(current_location), pattern, group), F.lit(""))


def from_station_name(c) -> Column:
    """P2, FROM: greedy first group of 'Between (.+) and (.+)' (B6)."""
    return extract(c, BETWEEN_PATTERN, 1)


def to_station_name(c) -> Column:
    """P2, TO."""
    return extract(c, BETWEEN_PATTERN, 2)


def at_station_name(c) -> Column:
    """P3."""
    return extract(c, AT_PATTERN, 1)


def approaching_station_name(c) -> Column:
    """P4."""
    return extract(c, APPROACHING_PATTERN, 1)


def contains_pattern(name) -> Column:
    """'%' || name || '%' for an ILIKE with '!' as escape character.

    '!' in the data is doubled so it stays literal; '%' and '_' keep acting as
    wildcards, as in the reference. A NULL name gives a NULL pattern, which
    never matches.
    """
    escaped = F.replace(_col(name), F.lit("!"), F.lit("!!"))
    return F.concat(F.lit("%"), escaped, F.lit("%"))


def name_matches(station_name, name) -> Column:
    """station_name ILIKE '%name%' (case-insensitive substring, wildcards kept)."""
    return F.ilike(_col(station_name), contains_pattern(name), F.lit("!"))

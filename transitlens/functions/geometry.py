"""Position arithmetic (X1, X2) and colour expressions (V5, V7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: assumed travel time between two stations, in seconds.
SPAN_SECONDS = 180.0
# Alpha of route paths and of train markers; grey for unknown lines.
ROUTE_ALPHA = 180
MARKER_ALPHA = 220
GREY = 128


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def progress_fraction(time_to_station, span: float = SPAN_SECONDS) -> Column:
    """clamp(span - t, 0, span) / span in double; NULL t gives NULL.

    0 means at the FROM station, 1 at the TO station.
    """
    t = _col(time_to_station)
    s = F.lit(float(span))
    clamped = F.least(F.greatest(s - t.cast("double"), F.lit(0.0)), s)
    return F.when(t.isNotNull(), clamped / s)


def interpolate(start, end, fraction) -> Column:
    """Start + f * (end - start); NULL if any input is NULL."""
    a, b = _col(start), _col(end)
    return a + _col(fraction) * (b - a)


def hex_channel(hex_colour, index: int) -> Column:
    """Two hex digits of '#RRGGBB' (index 0, 1, 2) as an int."""
    h = _col(hex_colour)
    return F.conv(F.substring(h, 2 + 2 * index, 2), 16, 10).cast("int")


def hex_rgb(hex_colour, alpha: int = ROUTE_ALPHA) -> Column:
    """V5: [r, g, b, alpha] from '#RRGGBB'."""
    return F.array(hex_channel(hex_colour, 0), hex_channel(hex_colour, 1),
                   hex_channel(hex_colour, 2), F.lit(alpha))

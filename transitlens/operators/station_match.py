"""LEFT joins of predictions to station and line reference data.

Name matches (J1, J2, J4, J5) are ``line_id = line_id AND station_name ILIKE
'%name%'``. They have one plan, whatever the sizes: the distinct (line, name)
pairs of all four name columns are collected in one pass (``stack``), matched
to the stations once, and joined back on (line, name). There are as many pairs
as names in use, not as rows.

The match itself is an equi join too: stations are listed under the *grams* of
their names (runs of the lengths in ``GRAMS``, lower-cased), with the number of
stations a gram has on its line. A name looks up its rarest literal gram, and the
ILIKE is checked on what meets. So a line's stations are spread by gram, and a prefix that they
all share is looked up only by names that hold nothing else. Several stations can match one name, which multiplies rows
exactly as in the reference (B1). No join is hinted: sizes decide (the matches are
a written table, so the optimiser knows theirs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.location import name_matches
from ..session import materialised

STATION_FIELDS = ["naptan_id", "station_name", "latitude", "longitude"]
NAME_COLUMNS = ["at_station_name", "approaching_station_name", "from_station_name", "to_station_name"]
GRAMS = [1, 2, 3, 6, 12]  # sizes, rising; long ones tell apart names that share most of their letters
SHARES = 64              # parts of a line's stations that names of wildcards only meet


def name_pairs(parsed: DataFrame) -> DataFrame:
    """The distinct (line_id, name) of all name columns, in one pass."""
    names = [c for c in NAME_COLUMNS if c in parsed.columns]
    return (parsed.select("line_id", F.stack(F.lit(len(names)), *[F.col(c) for c in names]).alias("name"))
            .where(F.col("name").isNotNull() & F.col("line_id").isNotNull()).distinct())


def _runs_of(text: Column, n: int) -> Column:
    """Every run of n characters of a text (none if it is shorter)."""
    starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
    return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _name_grams(name: Column) -> Column:
    """The grams a matching station must have: of the longest size in GRAMS that
    some literal run (between wildcards) of the name reaches; none for a name of wildcards only."""
    literal = F.split(F.lower(name), "[%_]")
    out = F.array().cast("array<string>")

    def found(n: int) -> Column:
        return F.flatten(F.transform(literal, lambda run: _runs_of(run, n)))

    for n in GRAMS:                                    # the largest that fits wins
        out = F.when(F.size(found(n)) > 0, F.array_distinct(found(n))).otherwise(out)
    return out


def _station_grams(name: Column) -> Column:
    text = F.lower(name)
    return F.array_distinct(F.concat(*[_runs_of(text, n) for n in GRAMS]))


def candidates(pairs: DataFrame, stations: DataFrame) -> DataFrame:
    """(line_id, name, station fields) that may match: what ILIKE still has to check.

    Every name looks up its rarest gram among the stations of its line; a name
    with a gram that no station has matches none. Names of wildcards only
    match by length, so they meet all stations of their line, dealt out by hash.
    """
    pieces = stations.where(F.col("line_id").isNotNull()).select(
        "line_id", *STATION_FIELDS, F.explode(_station_grams(F.col("station_name"))).alias("gram"))
    asked = pairs.select("line_id", "name", F.explode(_name_grams(F.col("name"))).alias("gram"))
    often = pieces.groupBy("line_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    counted = asked.join(often, ["line_id", "gram"], "left")
    rarest = (counted.groupBy("line_id", "name")
              .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count(F.when(F.col("n").isNull(), 1)).alias("missing"))
              .where(F.col("missing") == 0).drop("missing"))
    found = rarest.join(pieces, ["line_id", "gram"]).select("line_id", "name", *STATION_FIELDS)
    wild = (pairs.where(F.size(_name_grams(F.col("name"))) == 0)
            .select("line_id", "name", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share")))
    dealt = stations.withColumn("share", F.pmod(F.xxhash64("naptan_id", "station_name"), F.lit(SHARES)).cast("int"))
    return found.unionByName(wild.join(dealt, ["line_id", "share"]).select("line_id", "name", *STATION_FIELDS))


def match_names(parsed: DataFrame, stations: DataFrame, unique: bool = False) -> DataFrame:
    """(line_id, name, naptan_id, station_name, latitude, longitude) of every name and matching station.

    ``unique`` keeps one station per (line, name): the name itself (ignoring
    case), then the shortest station name, then the smallest naptan id.
    """
    found = candidates(name_pairs(parsed), stations).where(name_matches(F.col("station_name"), F.col("name")))
    if unique:
        rank = F.struct(F.lower("station_name") != F.lower("name"), F.length("station_name"), "naptan_id")
        best = F.min_by(F.struct(*STATION_FIELDS), rank).alias("best")
        found = found.groupBy("line_id", "name").agg(best).select("line_id", "name", "best.*")
    return materialised(found, "name-matches")


def match_station(df: DataFrame, matches: DataFrame, name_col: str, prefix: str) -> DataFrame:
    """Add ``{prefix}_naptan_id, _station_name, _latitude, _longitude`` for the
    stations that match ``df[name_col]``. Rows without a match keep NULLs (LEFT
    join); several matches give several rows.
    """
    right = matches.select(F.col("line_id").alias("_line"), F.col("name").alias("_name"),
                           *[F.col(c).alias(f"{prefix}_{c}") for c in STATION_FIELDS])
    cond = (F.col("line_id") == F.col("_line")) & (F.col(name_col) == F.col("_name"))
    return df.join(right, cond, "left").drop("_line", "_name")


def next_stop(df: DataFrame, stations: DataFrame, prefix: str = "s_dest", unique: bool = False) -> DataFrame:
    """The station the prediction is for (naptan id and line, pure equi)."""
    right = stations.select(F.col("line_id").alias("_line"), *[F.col(c).alias(f"{prefix}_{c}") for c in STATION_FIELDS])
    if unique:
        rest = F.struct(*[f"{prefix}_{c}" for c in STATION_FIELDS[1:]])
        right = (right.groupBy("_line", f"{prefix}_naptan_id").agg(F.min(rest).alias("rest"))
                 .select("_line", f"{prefix}_naptan_id", "rest.*"))
    cond = (F.col("station_naptan_id") == F.col(f"{prefix}_naptan_id")) & (F.col("line_id") == F.col("_line"))
    return df.join(right, cond, "left").drop("_line")


def line_colours(df: DataFrame, lines: DataFrame) -> DataFrame:
    """Colour columns by line_id (LEFT)."""
    return df.join(lines.select("line_id", "colour_hex", "colour_r", "colour_g", "colour_b"), "line_id", "left")

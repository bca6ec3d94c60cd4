"""Reference tables (stations, routes, lines) and the load summary.

Each load is a full replace of its table. Inputs are API-shaped JSON
documents as DataFrames; the HTTP fetch itself is not part of the package.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import hex_channel
from ..schemas import REF_LINES
from ..session import remove, written_folders

STOPS = "array<map<string,string>>"
STOP_KEYS = ["naptanId", "commonName", "lat", "lon"]

# The reference's eleven lines (id, name, hex, r, g, b).
LINE_COLOURS = [
    ("bakerloo", "Bakerloo", "#B36305", 179, 99, 5),
    ("central", "Central", "#E32017", 227, 32, 23),
    ("circle", "Circle", "#FFD300", 255, 211, 0),
    ("district", "District", "#00782A", 0, 120, 42),
    ("hammersmith-city", "Hammersmith & City", "#F3A9BB", 243, 169, 187),
    ("jubilee", "Jubilee", "#A0A5A9", 160, 165, 169),
    ("metropolitan", "Metropolitan", "#9B0056", 155, 0, 86),
    ("northern", "Northern", "#000000", 0, 0, 0),
    ("piccadilly", "Piccadilly", "#003688", 0, 54, 136),
    ("victoria", "Victoria", "#0098D4", 0, 152, 212),
    ("waterloo-city", "Waterloo & City", "#95CDBA", 149, 205, 186),
]


def _required(ok: Column, what: Column) -> Column:
    """A filter that keeps every row and fails the load where ``ok`` does not
    hold. A filter is evaluated whatever columns a query reads."""
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(what).cast("boolean"))


def _whole(body: Column, kind: str) -> Column:
    """The JSON value of a body, NULL when it is malformed or text follows it."""
    wrapped = F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<{kind}>")
    return F.when(F.size(wrapped) == 1, F.get(wrapped, F.lit(0)))


def load_stations(stop_docs: DataFrame) -> DataFrame:
    """(line_id, body = JSON array of stop points) -> REF_STATIONS.

    A missing or malformed body, a stop point without one of its keys and a
    coordinate that is no number fail the load, before anything is replaced.
    """
    stop = F.col("stop")
    line = F.concat(F.lit("stop points of line "), F.coalesce("line_id", F.lit("?")))
    parsed = stop_docs.select("line_id", _whole(F.col("body"), STOPS).alias("stops"))
    whole = parsed.where(_required(F.col("stops").isNotNull(), F.concat(line, F.lit(" cannot be read"))))
    keys = F.forall(F.array(*[F.lit(k) for k in STOP_KEYS]), lambda k: F.map_contains_key(stop, k))
    numbers = stop["lat"].try_cast("double").isNotNull() & stop["lon"].try_cast("double").isNotNull()
    return (
        whole.select("line_id", F.explode("stops").alias("stop"))
        .where(_required(stop.isNotNull() & keys & numbers, F.concat(line, F.lit(": one lacks naptanId, commonName, lat or lon"))))
        .select(
            stop["naptanId"].alias("naptan_id"),
            stop["commonName"].alias("station_name"),
            F.col("line_id"),
            stop["lat"].cast("double").alias("latitude"),
            stop["lon"].cast("double").alias("longitude"),
        )
    )


def route_text(text: Column) -> Column:
    """Coordinates as the loader stores them: parsed and written again, with a
    space after each comma and numbers without idle zeros. NULL unless they
    are one or two levels of paths of number pairs (or empty)."""
    ok = _whole(text, "array<array<array<double>>>").isNotNull() | _whole(text, "array<array<double>>").isNotNull()
    bare = F.regexp_replace(text, r"\s+", "")
    short = F.regexp_replace(bare, r"(\.[0-9]*?[1-9])0+(?=[,\]])", "$1")
    short = F.regexp_replace(short, r"\.0+(?=[,\]])", ".0")
    return F.when(ok, F.replace(short, F.lit(","), F.lit(", ")))


def load_routes(route_docs: DataFrame) -> DataFrame:
    """(line_id, direction, body) -> REF_LINE_ROUTES, one row per element
    of ``lineStrings``, as text (see ``route_text``). A NULL body is a failed
    fetch and gives no rows, as does a body without ``lineStrings``; a
    malformed body and coordinates that are no paths fail the load."""
    place = F.concat_ws(" ", F.lit("route of line"), "line_id", "direction")
    doc = _whole(F.col("body"), "map<string,string>")
    strings = F.when(F.map_contains_key("doc", F.lit("lineStrings")), _whole(F.col("doc")["lineStrings"], "array<string>"))
    read = route_docs.where(F.col("body").isNotNull()).select("line_id", "direction", doc.alias("doc"))
    whole = (read.where(_required(F.col("doc").isNotNull(), F.concat(place, F.lit(" cannot be read"))))
             .where(F.map_contains_key("doc", F.lit("lineStrings")))
             .select("line_id", "direction", strings.alias("strings"))
             .where(_required(F.col("strings").isNotNull(), F.concat(place, F.lit(": lineStrings is no list")))))
    return (whole.select("line_id", "direction", F.explode("strings").alias("given"))
            .select("line_id", "direction", route_text(F.col("given")).alias("coordinates"))
            .where(_required(F.col("coordinates").isNotNull(), F.concat(place, F.lit(": coordinates are no paths")))))


def load_lines(spark: SparkSession, metadata: DataFrame | None = None) -> DataFrame:
    """The line table. ``metadata`` (line_id, line_name, colour_hex): other
    lines than the fixed ones; their channels come from the hex colour."""
    if metadata is None:
        return spark.createDataFrame(LINE_COLOURS, REF_LINES)
    return metadata.select("line_id", "line_name", "colour_hex",
                           *[hex_channel("colour_hex", i).alias(f"colour_{c}") for i, c in enumerate("rgb")])


def load_summary(stations: DataFrame, routes: DataFrame, lines: DataFrame) -> DataFrame:
    """S11: 'Reference data loaded: n stations, n routes, n lines' (one row,
    one aggregate over the three tables, no join)."""
    tagged = (stations.select(F.lit("s").alias("t"))
              .unionByName(routes.select(F.lit("r").alias("t")))
              .unionByName(lines.select(F.lit("l").alias("t"))))

    def n(tag):
        return F.count(F.when(F.col("t") == tag, 1))
    return tagged.agg(
        n("s").alias("stations"), n("r").alias("routes"), n("l").alias("lines"),
    ).select("stations", "routes", "lines", F.format_string(
        "Reference data loaded: %d stations, %d routes, %d lines",
        F.col("stations"), F.col("routes"), F.col("lines")).alias("summary"))


def location(spark: SparkSession, name: str) -> str:
    """The folder that a catalog table stands for."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def stored(spark: SparkSession, where: str) -> DataFrame:
    """A reference table as it is now: ``where`` is a folder, or, without a slash, the name of a catalog table.

    What this session remembers of a catalog table's location and files is dropped first, so a
    switch made by another session is seen.
    """
    if "/" in where:
        return spark.read.parquet(where)
    spark.catalog.refreshTable(where)
    return spark.table(where)


def stored_folder(spark: SparkSession, where: str) -> str:
    """The folder of such a table."""
    return where if "/" in where else location(spark, where)


def switch_table(df: DataFrame, name: str, folder: str, grace: float = 3600.0) -> str:
    """Full replace of a catalog table by one change of metadata.

    The rows are written to a folder of their own below ``folder`` and read back, then the table's location is
    set to it. A reader has either the old rows or the new ones: a folder stays until the first replace that
    comes ``grace`` seconds after the table has left it, which is the time that a reader has, however old its rows are.
    A failed load, or rows of another schema than the table's, leave the table as it is.
    """
    spark = df.sparkSession
    short = name.split(".")[-1]
    if spark.catalog.tableExists(name):
        have = [(f.name, f.dataType) for f in spark.table(name).schema]
        if have != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{name} has the columns {have}")
        before = _name(location(spark, name))
    else:
        have = None
    path = f"{folder.rstrip('/')}/{short}@{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    spark.read.schema(df.schema).parquet(path).count()
    if have is None:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        _remove_left(spark, folder, short, before, _name(path), grace)
    return path


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _remove_left(spark: SparkSession, folder: str, table: str, before: str, now: str, grace: float) -> None:
    """Remove the folders that the table left for their successor ``grace`` seconds ago; ``before`` was left for ``now``."""
    found = written_folders(spark, folder, f"{table}@")
    written = {_name(p): at for at, p in found}
    for (at, path), (next_at, _) in zip(found, [*found[1:], (time.time(), "")]):
        left = written[now] if _name(path) == before else next_at
        if _name(path) != now and left < time.time() - grace:
            remove(spark, path)


def replace_table(df: DataFrame, path: str) -> None:
    """Full replace of a reference table (the loaders' overwrite).

    The new rows are written beside the table and read back; only then do the
    folders change names. A failed load leaves the old table as it is.
    """
    spark = df.sparkSession
    new, old = (f"{path.rstrip('/')}.{tag}-{uuid.uuid4().hex[:12]}" for tag in ("new", "old"))
    df.write.parquet(new)
    spark.read.parquet(new).count()
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(jvm_path(path))
    if had and not fs.rename(jvm_path(path), jvm_path(old)):
        raise OSError(f"{path} cannot be moved away")
    if not fs.rename(jvm_path(new), jvm_path(path)):
        if had:
            fs.rename(jvm_path(old), jvm_path(path))
        raise OSError(f"{new} cannot take the place of {path}")
    if had:
        fs.delete(jvm_path(old), True)

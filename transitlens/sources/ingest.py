"""Arrival predictions from a landing directory into RAW_ARRIVALS.

The HTTP poller is not part of this package. It (or anything else) drops
landing records, one JSON object per text line:

    {"ingestion_id": "...", "timestamp_utc": "2024-01-01T00:00:00",
     "line_id": "victoria", "body": "<API response: a JSON array of predictions>"}

The body stays text, so a broken body is a skipped payload (a failed fetch,
reported, the run goes on), not a broken file. Batch (``spark.read``) and streaming (``spark.readStream``) read the
same records with the same schema; all parsing is built-in JSON functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_ARRIVALS, RAW_COLUMNS, TIE_COLUMN
from ..session import footer_table
from . import polls

LANDING_SCHEMA = "ingestion_id string, timestamp_utc string, line_id string, body string"
PREDICTIONS = "array<map<string,string>>"

# JSON key of each raw string column, as the API names them.
STRING_KEYS = [
    ("vehicle_id", "vehicleId"),
    ("line_id", "lineId"),
    ("line_name", "lineName"),
    ("station_naptan_id", "naptanId"),
    ("station_name", "stationName"),
    ("platform_name", "platformName"),
    ("direction", "direction"),
    ("destination_name", "destinationName"),
    ("destination_naptan_id", "destinationNaptanId"),
    ("current_location", "currentLocation"),
    ("towards", "towards"),
]
# A payload that is not a JSON array of objects is a failed fetch: that line
# is reported and skipped, the run goes on (not an errored row).
SKIPPED_PAYLOAD = "unparseable payload"
NULL_PREDICTION = "prediction is not an object"
REJECT_COLUMNS = ["reject_reason", "prediction_json"]
TIME_KEY = "timeToStation"
EXPECTED_KEY = "expectedArrival"
ID_KEY = "id"


def read_predictions(spark: SparkSession, path: str, streaming: bool = False,
                     max_files_per_trigger: int | None = None, clean_source: str | None = None,
                     archive_dir: str | None = None) -> DataFrame:
    """Landing records (one API response each) as a batch or stream.

    Streaming options: ``max_files_per_trigger`` turns a backlog into several
    bounded micro-batches; ``clean_source`` ('archive' with ``archive_dir``,
    or 'delete') moves processed landing files away so the listing of the
    landing folder does not grow without end.
    """
    if streaming:
        reader = spark.readStream.schema(LANDING_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if clean_source:
            reader = reader.option("cleanSource", clean_source)
            if archive_dir:
                reader = reader.option("sourceArchiveDir", archive_dir)
        return reader.json(path)
    return spark.read.schema(LANDING_SCHEMA).json(path)


def read_polls(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landing records of numbered poll cycles, through the ``prediction_polls`` source (see ``sources.polls``)."""
    polls.register(spark)
    reader = spark.readStream if streaming else spark.read
    return reader.format(polls.PollSource.name()).load(path)


def explode_predictions(payloads: DataFrame) -> DataFrame:
    """One row per prediction (a map of the object's keys to text).

    ``payload_ok`` is false for a body that is not a JSON array (nothing may
    follow it either); such a payload gives one row with a NULL prediction
    (reported as a skipped payload), the others go on. A null among the
    predictions gives a row with a NULL prediction, which is an errored row.
    An empty array gives no row.
    """
    # inside another array, text after the body makes the whole malformed
    whole = F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), f"array<{PREDICTIONS}>")
    preds = F.when(F.size(whole) == 1, F.get(whole, F.lit(0)))
    parsed = payloads.withColumn("_preds", preds)
    return parsed.select(
        *[c for c in payloads.columns if c != "body"],
        F.col("_preds").isNotNull().alias("payload_ok"),
        F.explode(F.when(F.col("_preds").isNull(), F.array(F.lit(None).cast("map<string,string>")))
                  .otherwise(F.col("_preds"))).alias("prediction"),
    )


def _text(m: Column, key: str) -> Column:
    """Missing key -> '', JSON null -> NULL, else the text."""
    return F.when(F.map_contains_key(m, key), m[key]).otherwise(F.lit(""))


def _stamp(value, kind: str) -> Column:
    if value is None:
        return F.col(kind).cast("timestamp_ntz" if kind == "timestamp_utc" else "string")
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp_ntz" if kind == "timestamp_utc" else "string")


def expected_arrival(text: Column) -> Column:
    """Falsy gives NULL, else every 'Z' removed and read as timestamp_ntz."""
    return F.when(F.coalesce(text, F.lit("")) != "",
                  F.replace(text, F.lit("Z"), F.lit("")).try_cast("timestamp_ntz"))


def flatten_predictions(df: DataFrame, ingestion_id=None, timestamp_utc=None) -> DataFrame:
    """Prediction maps to RAW_ARRIVALS columns, plus validation flags.

    ``ingestion_id`` / ``timestamp_utc``: a literal for the whole run (S5:
    every row of a run carries the same id and second), a Column, or None to
    take the landing record's own columns. Adds ``event_id`` from the
    prediction's ``id`` when present (the W1 tie-break) and ``reject_reason``.
    """
    m = F.col("prediction")
    t_text = m[TIME_KEY]
    time_to_station = F.when(F.map_contains_key(m, TIME_KEY), t_text.try_cast("int")).otherwise(F.lit(0))
    e_text = F.when(F.map_contains_key(m, EXPECTED_KEY), m[EXPECTED_KEY])
    bad_time = F.map_contains_key(m, TIME_KEY) & t_text.isNotNull() & t_text.try_cast("int").isNull()
    bad_expected = (F.coalesce(e_text, F.lit("")) != "") & expected_arrival(e_text).isNull()
    reason = (
        F.when(~F.col("payload_ok"), F.lit(SKIPPED_PAYLOAD))
        .when(m.isNull(), F.lit(NULL_PREDICTION))
        .when(bad_time, F.lit("timeToStation is not an integer"))
        .when(bad_expected, F.lit("expectedArrival is not a timestamp"))
    )
    return df.select(
        *[(F.when(m.isNull(), F.col("line_id")).otherwise(_text(m, key)) if col == "line_id" else _text(m, key)).alias(col)
          for col, key in STRING_KEYS],
        time_to_station.alias("time_to_station"),
        expected_arrival(e_text).alias("expected_arrival"),
        _stamp(timestamp_utc, "timestamp_utc").alias("timestamp_utc"),
        _stamp(ingestion_id, "ingestion_id").alias("ingestion_id"),
        m[ID_KEY].try_cast("long").alias(TIE_COLUMN),
        reason.alias("reject_reason"),
        F.to_json(m).alias("prediction_json"),
    )


def split_rejects(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows in RAW_ARRIVALS shape + event_id, rejected rows)."""
    good = flat.where(F.col("reject_reason").isNull()).select(*RAW_COLUMNS, TIE_COLUMN)
    rejected = flat.where(F.col("reject_reason").isNotNull()).select(
        "ingestion_id", "line_id", "reject_reason", "prediction_json")
    return good, rejected


def raw_from_payloads(payloads: DataFrame, ingestion_id=None, timestamp_utc=None) -> tuple[DataFrame, DataFrame]:
    """S1-S5 in one go: (good raw rows, rejected rows)."""
    return split_rejects(flatten_predictions(explode_predictions(payloads), ingestion_id, timestamp_utc))


def counts() -> list[Column]:
    reason = F.col("reject_reason")
    return [F.count(F.when(reason.isNull(), 1)).alias("rows_inserted"),
            F.count(F.when(reason.isNotNull() & (reason != SKIPPED_PAYLOAD), 1)).alias("rows_errored"),
            F.count(F.when(reason == SKIPPED_PAYLOAD, 1)).alias("payloads_skipped")]


def ingest_report(flat: DataFrame) -> DataFrame:
    """Per ingestion batch, inserted rows, errored rows (values the table
    refuses) and skipped payloads (failed fetches): one aggregate over one parse."""
    return flat.groupBy("ingestion_id").agg(*counts())


def check_report(report: DataFrame, strict: bool = True) -> dict:
    """Totals of a report (one small row). Raises on errored rows when
    strict, as the reference's ingest exits non-zero on them; skipped
    payloads are only reported, as its failed fetches are."""
    tot = report.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                       for c in ("rows_inserted", "rows_errored", "payloads_skipped")]).first()
    out = {c: int(tot[c]) for c in ("rows_inserted", "rows_errored", "payloads_skipped")}
    if strict and out["rows_errored"] > 0:
        raise RuntimeError(f"ingest rejected {out['rows_errored']} rows")
    return out


def align_by_name(df: DataFrame, extra: list[Column] = ()) -> DataFrame:
    """Match columns to RAW_ARRIVALS by name, ignoring case; cast to the
    table's types; a column the input lacks is NULL. ``extra``: further columns."""
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in RAW_ARRIVALS.fields:
        src = lower.get(f.name)
        cols.append((F.col(f"`{src}`") if src else F.lit(None)).cast(f.dataType).alias(f.name))
    tie = F.col(f"`{lower[TIE_COLUMN]}`") if TIE_COLUMN in lower else F.lit(None)
    return df.select(*cols, tie.cast("long").alias(TIE_COLUMN), *extra)


def raw_table(flat: DataFrame) -> DataFrame:
    """Flattened rows as the raw table stores them: RAW_ARRIVALS by name, the
    reject columns (NULL on good rows), and the partition columns ``rejected``
    and ``ingest_date``. Rejected rows are kept beside the good ones, so one
    write of one parse loses nothing; ``read_raw`` shows the good rows only."""
    lower = {c.lower(): c for c in flat.columns}
    reject = [(F.col(f"`{lower[c]}`") if c in lower else F.lit(None)).cast("string") for c in REJECT_COLUMNS]
    extra = [F.when(reject[0].isNotNull(), col).alias(c) for c, col in zip(REJECT_COLUMNS, reject)]
    return (align_by_name(flat, extra)
            .withColumn("rejected", F.col("reject_reason").isNotNull())
            .withColumn("ingest_date", F.to_date("timestamp_utc")))


def by_day(rows: DataFrame) -> DataFrame:
    """The raw table's rows, those of a day gathered before they are written (adaptive execution splits large days,
    on a stream without state too), so a day gets few files, whatever the number of tasks that parsed it."""
    return rows.hint("rebalance", F.col("rejected"), F.col("ingest_date"))


def append_raw(df: DataFrame, path: str, seen: Observation | None = None) -> None:
    """Append by name to the raw table, partitioned by ingest date so a
    max_age filter prunes whole days. ``seen`` observes the counts of what is written."""
    rows = by_day(raw_table(df))
    if seen is not None:
        rows = rows.observe(seen, *counts())
    rows.write.mode("append").partitionBy("rejected", "ingest_date").parquet(path)


def _only(df: DataFrame, rejected: bool) -> DataFrame:
    if "rejected" not in df.columns:
        return df.limit(0) if rejected else df
    return df.where(F.col("rejected") == rejected).drop("rejected")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of the raw table (with ``ingest_date``)."""
    return _only(spark.read.parquet(path), False).drop(*REJECT_COLUMNS)


def raw_footers(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of the raw table, for counts and dates that file footers answer (H1, H7, H8)."""
    return _only(footer_table(spark, path), False)


def raw_days(spark: SparkSession, path: str) -> DataFrame:
    """(ingest_date, n) of the good rows, from file footers. They are pushed down for all partition columns together only."""
    table = footer_table(spark, path)
    by = [c for c in ("rejected", "ingest_date") if c in table.columns]
    if table.schema["ingest_date"].dataType == T.NullType():         # no dated row: the folder names give no type
        dated = [T.StructField(f.name, T.DateType() if f.name == "ingest_date" else f.dataType) for f in table.schema]
        table = footer_table(spark, path, T.StructType(dated))
    return _only(table.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), False)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows kept in the raw table."""
    return _only(spark.read.parquet(path), True).select("ingestion_id", "line_id", *REJECT_COLUMNS)


def ingest_run(spark: SparkSession, landing_path: str, raw_path: str,
               ingestion_id=None, timestamp_utc=None, strict: bool = True) -> dict:
    """One batch ingest run (S1-S7): the landing records are parsed once; good
    and rejected rows are appended in one write, which also counts them.

    A run over no prediction writes no row. Failed payloads (a line whose
    fetch failed) are skipped and reported. With ``strict`` a run with errored
    rows raises after the append, as the reference's ingest exits non-zero
    after its commit.
    """
    flat = flatten_predictions(explode_predictions(read_predictions(spark, landing_path)), ingestion_id, timestamp_utc)
    seen = Observation("ingest")
    append_raw(flat, raw_path, seen)
    totals = {k: int(v) for k, v in seen.get.items()}
    if strict and totals["rows_errored"]:
        raise RuntimeError(f"ingest rejected {totals['rows_errored']} rows")
    return totals

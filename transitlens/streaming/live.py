"""M1-M5: the live form, with Structured Streaming.

M1  landing records -> raw table: one query, one parse, one file sink
    (exactly once through its commit log). Good and rejected rows go to the
    same table under the partition column ``rejected``, so no landing file has
    two readers and no row is dropped. Every micro-batch's counts are appended
    to a commit log (``commits.CommitLog``), which a caller can wait on.
M2  latest per (vehicle, line) as a streaming ``max_by`` aggregate in update
    mode: a trigger hands on the keys that its rows touch, not the whole state.
M3/M4  every trigger, ``foreachBatch`` places the changed keys only and merges
    them into the view table, which is partitioned by a hash bucket of the key:
    the buckets of changed keys are rewritten (dynamic partition overwrite),
    all others stay as they are. Each row notes the version of the reference
    tables it was placed with; after a reload the next trigger (or ``refresh``) places
    the rows of older versions again, from the table itself.
    The rows of the rewritten buckets are staged first, in a folder named by
    the batch, so a batch that fails half-way through the overwrite is finished
    from there when it is tried again. The table also holds keys without a
    position (a bucket never runs empty); readers drop them.
M5  no watermark and no dedup: raw is append-only and the total order of
    W1 makes the answer independent of arrival order. With ``availableNow`` the
    same query is a scheduled refresh: the stream's checkpoint knows which raw files it has
    seen, so rows that arrive late, for old days or without a timestamp are folded in like any other.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import KEYS, latest_per_vehicle
from ..plans.positions import is_placed, latest_for_view, placed, prune_raw
from ..schemas import PARSED_BASE, RAW_WITH_TIE, TRAIN_POSITIONS
from ..session import exists, materialised, remove, scratch_scope
from ..sources import ingest as I
from ..sources.refdata import stored
from .commits import CommitLog

# A new StructType: StructType.add would change RAW_WITH_TIE itself.
RAW_STREAM_SCHEMA = T.StructType(RAW_WITH_TIE.fields + [T.StructField("rejected", T.BooleanType()),
                                                        T.StructField("ingest_date", T.DateType())])
BUCKETS = 256            # of a view table; fixed once a table is written
OWN_COLUMNS = ["built_with", "bucket"]


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": "1 minute"}))


# ---------------------------------------------------------------- M1, S7

def start_ingest(spark: SparkSession, landing_dir: str, raw_dir: str, checkpoint: str,
                 trigger: dict | None = None, max_files_per_trigger: int | None = None,
                 clean_source: str | None = None, archive_dir: str | None = None, polls: bool = False) -> StreamingQuery:
    """M1: landing -> parse -> flatten -> append by name to ``raw_dir``
    (partitioned by ``rejected`` and ingest date), in one query.

    ``polls``: the landing folder holds numbered poll cycles (``sources.polls``); else
    plain files, see ``ingest.read_predictions`` for the options. The query's commit log is its attribute ``commits``.
    """
    name = f"ingest-{uuid.uuid4().hex[:12]}"
    commits = CommitLog(spark, f"{checkpoint}/commits", name)
    landed = I.read_polls(spark, landing_dir, streaming=True) if polls else I.read_predictions(
        spark, landing_dir, streaming=True, max_files_per_trigger=max_files_per_trigger, clean_source=clean_source, archive_dir=archive_dir)
    flat = I.flatten_predictions(I.explode_predictions(landed))
    rows = I.by_day(I.raw_table(flat.observe(CommitLog.METRICS, *I.counts())))
    query = _trigger(rows.writeStream.queryName(name).format("parquet").partitionBy("rejected", "ingest_date")
                     .option("checkpointLocation", f"{checkpoint}/raw"), trigger).start(raw_dir)
    query.commits = commits
    return query


def ingest_available(spark: SparkSession, landing_dir: str, raw_dir: str, checkpoint: str, strict: bool = False,
                     **options) -> dict:
    """One run of the ingest query over what is there; its counts and the log's last token.
    ``strict``: raises when this run added errored rows (they are kept in the table either way)."""
    query = start_ingest(spark, landing_dir, raw_dir, checkpoint, {"availableNow": True}, **options)
    run_available(query)
    totals = query.commits.finished()
    if strict and totals["rows_errored"]:
        raise RuntimeError(f"ingest rejected {totals['rows_errored']} rows")
    return totals


def read_raw_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw table's good rows as a stream. A file-sink folder is read
    through its commit log, so only committed files are seen and nothing is listed."""
    reader = spark.readStream.schema(RAW_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a raw folder without the partition column has good rows only
    return reader.parquet(raw_dir).where(F.coalesce("rejected", F.lit(False)) == F.lit(False)).drop("rejected")


# ---------------------------------------------------------------- M2-M4: a view table by key bucket

def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int").alias("bucket")


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is not among ``keys``; null is a key like others, as in W1."""
    gone = keys.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return rows.join(gone, same[0] & same[1], "left_anti")


def read_view(spark: SparkSession, out_dir: str) -> DataFrame:
    """All rows of a view table, without the columns of its own."""
    if not exists(spark, out_dir):
        raise FileNotFoundError(f"no view under {out_dir} yet")
    return spark.read.parquet(out_dir).drop(*OWN_COLUMNS)


def read_positions(spark: SparkSession, out_dir: str, max_age: dt.timedelta | None = None, now=None) -> DataFrame:
    """TRAIN_POSITIONS from the live table. ``max_age`` leaves out vehicles whose
    latest prediction is older than ``now - max_age`` (``now``: the current time)."""
    rows = read_view(spark, out_dir).where(is_placed())
    if max_age is not None:
        at = F.lit(now).cast("timestamp_ntz") if now is not None else F.current_timestamp().cast("timestamp_ntz")
        rows = rows.where(F.col("timestamp_utc") >= at - F.make_dt_interval(secs=F.lit(max_age.total_seconds())))
    return rows.select(*TRAIN_POSITIONS)


def merge_changes(changed: DataFrame, out_dir: str, build: Callable[[DataFrame], DataFrame], version: str,
                  batch: str, buckets: int = BUCKETS) -> list[int]:
    """Merge changed keys into the view table; returns the buckets that were rewritten.

    ``changed``: the latest row of each changed key. ``build``: rows -> rows of the view, at least one for
    each key and with the columns of its input among others. ``version``: what ``build`` depends on
    besides its rows; rows built with another version are built again. ``batch`` names this merge: when it is
    tried again, it goes on from the staged rows.
    """
    spark, staged = changed.sparkSession, f"{out_dir.rstrip('/')}.staged/{batch}"
    if not exists(spark, f"{staged}/_SUCCESS"):
        with scratch_scope(spark):
            _stage(changed, out_dir, build, version, staged, buckets)
    rows = spark.read.parquet(staged)
    touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())       # at most ``buckets``
    if touched:
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(out_dir))
    remove(spark, staged)
    return touched


def _stage(changed: DataFrame, out_dir: str, build: Callable[[DataFrame], DataFrame], version: str, staged: str, buckets: int) -> None:
    """Write the new rows of all buckets that hold a changed key or a row of another version."""
    spark = changed.sparkSession
    rows = changed = materialised(changed, "changed")
    old = spark.read.parquet(out_dir) if exists(spark, out_dir) else None
    if old is not None:
        # Parquet statistics leave nothing to read here unless the version changed.
        stale = old.where(F.col("built_with") != version).select(*changed.columns).distinct()
        rows = materialised(changed.unionByName(_without(stale, changed)), "rows")
    new = build(rows).withColumn("built_with", F.lit(version)).withColumn("bucket", bucket(buckets))
    if old is not None:
        touched = [r[0] for r in rows.select(bucket(buckets)).distinct().collect()]
        kept = old.where(F.col("bucket").isin(touched) & (F.col("built_with") == version))
        new = new.unionByName(_without(kept, changed))
    new.write.mode("overwrite").parquet(staged)


def start_view(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str,
               build: Callable[[DataFrame], DataFrame] = lambda rows: rows, trigger: dict | None = None,
               columns: list[str] | None = None, max_files_per_trigger: int | None = None,
               version: Callable[[], str] = lambda: "", buckets: int = BUCKETS) -> StreamingQuery:
    """M2 + M4: latest-per-vehicle state; each trigger merges the changed keys
    into the view table. ``columns``: the raw columns that ``build`` reads (all if not given);
    ``build`` and ``version``: see ``merge_changes``."""
    raw = read_raw_stream(spark, raw_dir, max_files_per_trigger).drop("ingest_date")
    latest = latest_per_vehicle(prune_raw(raw) if columns else raw)

    def merge(changed: DataFrame, batch_id: int) -> None:
        merge_changes(changed.select(*(columns or changed.columns)), out_dir, build, version(), f"b{batch_id:012d}", buckets)

    writer = (latest.writeStream.outputMode("update")
              .option("checkpointLocation", f"{checkpoint}/view")
              .foreachBatch(merge))
    return _trigger(writer, trigger).start()


class Places:
    """The reference tables of the view, read again whenever ``reload`` is called; folders or catalog tables (``refdata.stored``)."""

    def __init__(self, spark: SparkSession, stations: str, lines: str, unique: bool = False):
        self.spark, self.tables, self.unique = spark, (stations, lines), unique

    def reload(self) -> str:
        """Read the tables' file lists and give their version: counts and hash sums of the
        rows, so a reload of the same rows is no new version. One small aggregate."""
        self.stations, self.lines = (stored(self.spark, t) for t in self.tables)
        found = [t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(t.columns)).cast("decimal(38,0)")).alias("s"))
                 for t in (self.stations, self.lines)]
        counts = found[0].withColumn("t", F.lit(0)).unionByName(found[1].withColumn("t", F.lit(1))).orderBy("t").collect()
        return "/".join([f"{r.n}:{r.s or 0}" for r in counts] + ["unique"] * self.unique)

    def build(self, latest: DataFrame) -> DataFrame:
        return placed(latest, self.stations, self.lines, self.unique)


def start_positions(spark: SparkSession, raw_dir: str, stations: str, lines: str,
                    out_dir: str, checkpoint: str, trigger: dict | None = None,
                    unique: bool = False, max_files_per_trigger: int | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """M3/M4: TRAIN_POSITIONS kept live; read it with ``read_positions``. A
    reload of the reference tables (S8-S10) shows at the next trigger. ``stations``, ``lines``: folders, or catalog
    tables, whose replace by ``refdata.switch_table`` leaves a trigger that reads them no moment without rows."""
    places = Places(spark, stations, lines, unique)
    return start_view(spark, raw_dir, out_dir, checkpoint, places.build, trigger, PARSED_BASE,
                      max_files_per_trigger, places.reload, buckets)


def refresh(spark: SparkSession, raw_dir: str, stations: str, lines: str,
            out_dir: str, unique: bool = False, buckets: int = BUCKETS) -> list[int]:
    """Bring the live table up to date without a stream; returns the rewritten buckets.

    Where there is a table, only rows of older reference versions are placed
    again, from the table (after a reload with no new raw rows). Where there is none, it is built from raw.
    """
    places = Places(spark, stations, lines, unique)
    version = places.reload()
    if exists(spark, out_dir):
        changed = spark.read.parquet(out_dir).select(*PARSED_BASE).limit(0)
    else:
        changed = latest_for_view(I.read_raw(spark, raw_dir)).select(*PARSED_BASE)
    return merge_changes(changed, out_dir, places.build, version, f"r{uuid.uuid4().hex[:12]}", buckets)


def run_available(queries: list[StreamingQuery] | StreamingQuery) -> None:
    """Wait for availableNow queries to finish; re-raise the failure of any."""
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

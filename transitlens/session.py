"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every job of this package relies on: UTC wall clock for the
# timestamp_ntz columns (T7), AQE for runtime re-planning and skew splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Every Column call otherwise records its Python call site in the JVM
    # (several py4j round trips each): plan construction, not execution, is
    # what that costs, and it is paid again for every streaming micro-batch.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "transitlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Local mode runs every task in the driver JVM: give it a heap that
        # lets sorts and shuffles stay in memory (the default is 1 GB).
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Only the session zone matters for the timestamp logic; pin it even on a
    # session that was created elsewhere.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def cluster_conf(executors: int, cores_per_executor: int) -> dict[str, str]:
    """Settings for a large cluster (pass as ``extra`` to ``build_session``).

    Shuffle partitions start at 4 per core and AQE coalesces them towards
    128 MB; file splits of 256 MB keep map tasks few but within memory; the
    RocksDB state store keeps the live view's per-vehicle state off heap.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(4 * cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset on a local master (tests,
    local runs) a fresh local folder is made and registered; on a cluster an
    unset value is an error, so checkpoints and written tables never land in
    a machine-local folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        conf_dir = tempfile.mkdtemp(prefix="transitlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared directory (never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialised`` writes inside (on this thread) are removed
    when the scope ends, so what reads them must be written or collected inside."""
    stack = _scopes.__dict__.setdefault("paths", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: computed
    once, with sizes that the optimiser knows, and independent of lost executors.
    It is there until the innermost ``scratch_scope`` ends; without one, the
    caller's rows stay readable and the folder is the cluster's to clean."""
    path = scratch_path(df.sparkSession, name)
    for paths in _scopes.__dict__.get("paths", [])[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _hadoop(spark, path)
    return fs.exists(place)


def written_folders(spark: SparkSession, folder: str, prefix: str) -> list[tuple[float, str]]:
    """(seconds of the last change, path) of the completely written tables in a folder with this prefix, oldest first."""
    fs, place = _hadoop(spark, folder)
    return sorted((s.getModificationTime() / 1000, s.getPath().toString()) for s in fs.listStatus(place)
                  if s.getPath().getName().startswith(prefix) and exists(spark, f"{s.getPath().toString()}/_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


_V1_SOURCES = "spark.sql.sources.useV1SourceList"


def footer_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table through Spark's V2 reader, which answers counts, and the extremes of numbers and dates, from
    the files' footers, by partition columns too. Filters on partition columns keep that, others undo it."""
    sources = spark.conf.get(_V1_SOURCES)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")        # the V2 reader's only
    spark.conf.set(_V1_SOURCES, ",".join(s for s in sources.split(",") if s != "parquet"))
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    finally:
        spark.conf.set(_V1_SOURCES, sources)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced if it is there."""
    fs, place = _hadoop(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

"""S7, live: what each micro-batch of the ingest query committed, and a wait for it.

The query observes its counts while it writes (no second pass). When a
micro-batch is committed, Spark reports its progress to the listener below, which
adds one record: the batch, its inserted and errored rows and skipped payloads, and the
*token* reached, i.e. the number of rows (inserted or errored) committed up to
here, over all runs. A batch that runs again replaces its record, so nothing counts
twice. The raw table stays the truth: if the driver dies between a commit and its
record, that record is missing and ``ingest.ingest_report`` still counts the rows.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import exists, write_text

COUNTS = ["rows_inserted", "rows_errored", "payloads_skipped"]
SCHEMA = "batch long, token long, rows_inserted long, rows_errored long, payloads_skipped long"


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed micro-batch."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def commit_report(commits: DataFrame) -> DataFrame:
    """Totals over all micro-batches and the last token (one row)."""
    return commits.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
                       F.coalesce(F.max("token"), F.lit(0)).alias("token"))


class CommitLog(StreamingQueryListener):
    """Records of the query ``name`` under ``path``; listens from when it is made until the query ends."""

    METRICS = "ingest"

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        #: batch -> rows of earlier runs' records; one small row per batch
        self.rows = {r.batch: r.rows_inserted + r.rows_errored for r in read_commits(spark, path).collect()}
        self.run = dict.fromkeys(COUNTS, 0)
        self._state = threading.Condition()
        self._run_id = None
        self._ended = False
        self._failure: Exception | None = None
        spark.streams.addListener(self)

    @property
    def token(self) -> int:
        return sum(self.rows.values())

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run_id = event.runId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or self.METRICS not in progress.observedMetrics:
            return
        counts = {c: int(progress.observedMetrics[self.METRICS][c]) for c in COUNTS}
        with self._state:
            self.rows[progress.batchId] = counts["rows_inserted"] + counts["rows_errored"]
            for c in COUNTS:
                self.run[c] += counts[c]
            record = {"batch": progress.batchId, "token": self.token, **counts}
            try:
                write_text(self.spark, f"{self.path}/{progress.batchId:012d}.json", json.dumps(record) + "\n")
            except Exception as e:  # noqa: BLE001  raised again in the caller's thread
                self._failure = e
            self._state.notify_all()

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run_id:          # sent after the last progress of that query
            with self._state:
                self._ended = True
                self._state.notify_all()

    def wait_for(self, token: int, limit: float) -> int:
        """Wait until ``token`` rows are committed; the token reached. Raises after
        ``limit`` seconds, or when the query ends before."""
        with self._state:
            self._state.wait_for(lambda: self.token >= token or self._ended or self._failure, limit)
            self._check()
            if self.token < token:
                raise TimeoutError(f"{self.token} of {token} rows are committed" + (", and the query has ended" if self._ended else f" after {limit} s"))
            return self.token

    def finished(self, limit: float = 60) -> dict:
        """Counts of this run and the last token, once the query has ended and all its reports are in."""
        with self._state:
            ended = self._state.wait_for(lambda: self._ended or self._failure, limit)
            self._check()
            if not ended:
                raise TimeoutError(f"no end of query {self.name} after {limit} s")
            out = {**self.run, "token": self.token}
        self.spark.streams.removeListener(self)
        return out

    def _check(self) -> None:
        if self._failure is not None:
            raise self._failure

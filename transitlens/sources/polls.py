"""S1 as a streaming source: poll cycles in a landing folder, read with ``format("prediction_polls")``.

A poll cycle asks every line once. Its answers land together as
``<landing>/cycle=<n>/*.json`` (landing records, one JSON object a line), with
n counting up; a cycle's folder is put in place whole (written elsewhere and
renamed, or by a committed Spark write) and never changed afterwards.

The stream's offset is the number of the last cycle read. So the checkpoint
says which cycles are done, whatever their files are called: a restart goes on after the last
committed cycle, and a trigger lists folder names, not files. Each file is one
partition; the bodies stay text and are parsed by Spark's JSON functions like all landing records.

Functions that run in Python tasks are pickled by value, so executors need pyarrow but not this package.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FIELDS = ["ingestion_id", "timestamp_utc", "line_id", "body"]
SCHEMA = "ingestion_id string, timestamp_utc string, line_id string, body string"
ROWS = 256               # landing records a batch of rows


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


def cycles(path: str) -> list[int]:
    """The numbers of the cycles that have landed, in order."""
    store, base = _store(path)
    names = [f.base_name for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if f.type == fs.FileType.Directory]
    return sorted(int(n[6:]) for n in names if re.fullmatch("cycle=[0-9]+", n))


class PollFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Files:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def files(self, after: int, upto: int) -> list[PollFile]:
        store, base = _store(self.path)
        found = []
        for n in cycles(self.path):
            if after < n <= upto:
                listed = store.get_file_info(fs.FileSelector(f"{base}/cycle={n}"))
                found += [f.path for f in listed if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        return [PollFile(p) for p in sorted(found)]

    def read(self, partition: PollFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:                # Spark reads an empty list of partitions as one without content
            return
        store, _ = _store(self.path)
        with store.open_input_stream(partition.path) as stream:
            rows = [json.loads(line) for line in stream.readall().decode().split("\n") if line.strip()]
        for i in range(0, len(rows), ROWS):
            part = rows[i:i + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in part], pa.string()) for f in FIELDS], FIELDS)


class PollReader(_Files, DataSourceReader):
    def partitions(self) -> list[PollFile]:
        landed = cycles(self.path)
        return self.files(landed[0] - 1, landed[-1]) if landed else []


class PollStreamReader(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"cycle": -1}

    def latestOffset(self) -> dict:
        return {"cycle": max(cycles(self.path), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[PollFile]:
        return self.files(start["cycle"], end["cycle"])

    def commit(self, end: dict) -> None:
        """Landed cycles stay; the checkpoint knows what is done."""


class PollSource(DataSource):
    """Options: ``path``, the landing folder."""

    @classmethod
    def name(cls) -> str:
        return "prediction_polls"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PollReader:
        return PollReader(self.options)

    def streamReader(self, schema) -> PollStreamReader:
        return PollStreamReader(self.options)


def register(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PollSource)

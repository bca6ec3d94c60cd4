"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, scratch_path, table_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the folder that ``spark.checkpoint.dir`` names.

    Cuts the lineage: lost executors cost a re-read, not a recomputation. The
    folder is new for every call and belongs to the cluster's clean-up of that folder.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def free(*tables: DataFrame) -> None:
    """Remove tables from ``written`` whose readers have all been written themselves: a lost executor
    needs only those then."""
    for t in tables:
        remove(t.sparkSession, t.written_at)


def per_process(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by a worker process for later tasks. (The globals of this package are pickled by
    value, so every task has its own.)"""
    kept = sys.modules.setdefault("_transitlens_kept", types.ModuleType("_transitlens_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Stands for a null id inside the operators: before all other ids.
NO_ID = -(1 << 63)
#: Ids below this one are not ids: rows without one are told apart by 62 bits of their text in its place.
LEAST_ID = -(1 << 62)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: bool = False) -> DataFrame | list[Column]:
    """(doc, tk, text): the id as long, a text fingerprint of 64 bits, the text (null: empty). ``columns``: the columns only.

    ``doc`` and ``tk`` together name a row by 126 bits or more: rows that repeat an id with another
    text stay apart, and equal rows are one document with one answer. A null id becomes
    a number below ``LEAST_ID`` that the text gives (another hash than ``tk``), so rows without ids stay apart too.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.lit(1), text), 2)
    out = [F.coalesce(F.col(id_col).cast("long"), none).alias("doc"), F.xxhash64(text).alias("tk"), text.alias("text")]
    return out if columns else docs.select(*out)


def given_id(doc: Column) -> Column:
    """The id as given: null where there was none."""
    return F.when(doc >= LEAST_ID, doc)


def real_id(col: str = "doc") -> Column:
    return given_id(F.col(col)).alias("doc_id")

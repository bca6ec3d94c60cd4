"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes every stage to the
shared folder and reads it back, so each one works on what its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm import bpe, decontaminate, line_dedup, minhash, quality
from transitlens.llm.storage import read, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all; ``n_chars`` follows the text."""
    return line_dedup.cleaned(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity of 0.8 or more."""
    return minhash.one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.cleaned(docs, read(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and the text that they decode to."""
    rows = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("bytes", "UTF-8").alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", lines),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no tokenizer or near-duplicate components; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}

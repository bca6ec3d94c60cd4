"""Quality rules as a bitmask ledger (operator 5).

Every rule is evaluated once per document. The ledger row holds the
measurements and ``failed_bits`` (bit i set: rule i fails). A policy is a
version name with a mask of the rules that reject; applying or comparing
policies and ablating rules are bitwise expressions on the ledger, so no
text is read again.

Defined cases: a null or empty text has no words and fails ``few_words``; a
null id is kept as null; repeated rows are judged one by one; an empty table
gives an empty ledger; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .storage import read

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_long_words"]

#: Rule i sets bit i where its condition holds. Integer arithmetic only.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("dup_lines", "2 * n_dup_lines > n_lines"),
    ("no_letters", "4 * n_letter_words < n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "2 * n_long_words > n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, int] = {
    "v1": BIT["few_words"] | BIT["repeated_words"],
    "v2": BIT["few_words"] | BIT["repeated_words"] | BIT["symbols"] | BIT["dup_lines"],
    "v3": (1 << len(RULES)) - 1,
}
CURRENT = "v3"

_SYMBOL = X.table(b"#*$%&|<>")
_LETTER = X.table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
LONG_WORD = 60


def measure_block(b: X.Block) -> dict[str, np.ndarray]:
    """The measurements of every text of a block."""
    sums = b.sums()
    ws, we, row = b.words()
    n = b.n
    out = {"n_words": np.bincount(row, minlength=n)}
    char = (b.data & 0xC0) != 0x80                       # one per code point
    out["word_chars"] = b.per_doc(char & ~X.SPACE[b.data])
    out["n_symbols"] = b.per_doc(_SYMBOL[b.data])
    chars = np.concatenate(([0], np.cumsum(char, dtype=np.int64)))
    letters = np.concatenate(([0], np.cumsum(_LETTER[b.data], dtype=np.int64)))
    out["n_letter_words"] = np.bincount(row[letters[we] > letters[ws]], minlength=n)
    out["n_long_words"] = np.bincount(row[chars[we] - chars[ws] > LONG_WORD], minlength=n)
    # lines: between line feeds; the separators between texts are line feeds too
    le = np.flatnonzero(b.data == 10)
    ls = np.concatenate(([0], le[:-1] + 1))
    lrow = b.doc_of(ls)
    out["n_lines"] = np.bincount(lrow, minlength=n)
    ink = np.concatenate(([0], np.cumsum(~X.SPACE[b.data], dtype=np.int64)))
    full = ink[le] > ink[ls]
    lrow, key = lrow[full], X.in_row(X.span_hashes(sums, ls[full], le[full]), lrow[full])
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(lrow, minlength=n) - np.bincount(lrow[first], minlength=n)
    at, h = X.window_hashes(X.span_hashes(sums, ws, we), row, 5)
    twice = X.repeated(X.in_row(h, row[at]))
    out["n_repeat_words"] = np.bincount(row[X.covered(len(row), at[twice], 5)], minlength=n)
    return out


def _measured(src: DataFrame, field: int | None = None) -> DataFrame:
    """Adds MEASURES to rows (key, text) and drops the text: one pass, no shuffle. ``field``: the text is that
    field of the key, so rows that carry their text send it to Python once."""
    schema = T.StructType([src.schema["key"]] + [T.StructField(m, T.LongType()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in X.blocks(batch.column(1) if field is None else batch.column(0).field(field)):
                got = measure_block(b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, b.n)] + [pa.array(got[m].astype(np.int64)) for m in MEASURES],
                    names=["key", *MEASURES])

    return src.mapInArrow(run, schema)


def ledger(docs: DataFrame, key: str | Column = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, *MEASURES, failed_bits): every rule evaluated once. ``key``: what of a row the ledger carries."""
    key = F.col(key) if isinstance(key, str) else key
    return _failed(_measured(docs.select(key.alias("key"), F.col(text_col).alias("text"))))


def _failed(measured: DataFrame) -> DataFrame:
    bits = " | ".join(f"(CASE WHEN {cond} THEN {1 << i}L ELSE 0L END)" for i, (_, cond) in enumerate(RULES))
    return measured.withColumn("failed_bits", F.expr(bits))


def rejected_by(mask: int, bits: str | Column = "failed_bits") -> Column:
    """True where a policy with this mask rejects."""
    col = F.col(bits) if isinstance(bits, str) else bits
    return col.bitwiseAND(F.lit(mask)) != 0


def ablations(led: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """For every policy and every rule in it: documents that fail the rule, that only this rule rejects, and that the policy rejects.

    One aggregation over the distinct bit patterns (at most 2 ** rules rows), whatever the number of documents.
    """
    patterns = led.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("mask"), F.lit(BIT[r]).alias("bit"))
                      for v, m in policies.items() for r, _ in RULES if m & BIT[r]])
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    return (patterns.select(F.inline(cases), "failed_bits", "n")
            .groupBy("policy", "rule")
            .agg(F.sum(F.when(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_rejected")))


def judged(docs: DataFrame, policy: str = CURRENT, key: str | Column = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger with ``base_failed`` (policy v1) and ``kept`` under the named policy."""
    mask = POLICIES[policy] | POLICIES["v1"]
    return (ledger(docs, key, text_col)
            .withColumn("base_failed", rejected_by(POLICIES["v1"]))
            .withColumn("kept", ~rejected_by(mask)))


def accepted(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows that a policy keeps, with all their columns; nothing is shuffled or joined."""
    led = _failed(_measured(docs.select(F.struct("*").alias("key")), docs.columns.index(text_col)))
    return led.filter(~rejected_by(POLICIES[policy] | POLICIES["v1"])).select("key.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_bits", "n_lines", "n_letter_words", "n_long_words")

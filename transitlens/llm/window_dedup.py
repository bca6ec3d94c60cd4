"""Substring dedup over word windows with a count-min prefilter (operator 9).

First pass: every partition sketches its windows (by their anchors, see
``sketch``); the sketches are merged and kept as one bit a cell. Second pass:
only windows estimated repeated are grouped, exactly, by 128-bit hashes of
their word sequence; each but the first place marks its words.

Defined cases: a null or empty text has no words; texts shorter than the
window lose nothing; rows with the same id and text are one document, with the
same answer; a null id comes before all others, rows that share an id with
other texts are ordered by a text fingerprint; an empty table gives an empty
result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sketch as S
from . import text as X
from .storage import identified, read, real_id

WORDS = 20
GRAM = 8                # words of a gram; a window's anchor is its least gram


def _grams(b: X.Block, k: int, gram: int):
    """(word hashes, rows, gram hashes, first words of whole windows as booleans) of a block."""
    ws, we, row = b.words()
    wh = X.span_hashes(b.sums(), ws, we)
    n = len(wh) - k + 1
    if n <= 0:
        return wh, row, wh[:0], np.zeros(0, bool)
    sums = X.prefix_sums(wh, X._WMULT)
    at = np.arange(len(wh) - gram + 1)
    return wh, row, X.span_hashes(sums, at, at + gram, X._WMULT), row[:n] == row[k - 1:]


def marked_windows(docs: DataFrame, k: int = WORDS, gram: int = GRAM, bits: int = S.BITS) -> DataFrame:
    """(doc, tk, pos) of the first word of every window whose words also start earlier; ``docs`` as from ``identified``."""
    gram = min(gram, k)

    def anchors_of(b: X.Block) -> np.ndarray:
        _, _, g, valid = _grams(b, k, gram)
        return g[S.anchored(g, k - gram + 1, valid)[1]] if len(g) else g

    flags = S.repeated_cells(docs, anchors_of, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = flags.value
        for batch in batches:
            doc, tk = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for b in X.blocks(batch.column(2)):
                wh, row, g, valid = _grams(b, k, gram)
                if not len(g):
                    continue
                least = S.sliding(np.minimum, g, k - gram + 1)
                change = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
                hit = np.repeat(S.estimated_repeated(flat, least[change], bits), np.diff(np.append(change, len(least))))
                at = np.flatnonzero(valid & hit)
                h1 = X.span_hashes(X.prefix_sums(wh, X._WMULT), at, at + k, X._WMULT)
                h2 = X.span_hashes(X.prefix_sums(X.mix64(wh), X._MULT), at, at + k, X._MULT)
                r = row[at]
                pos = at - np.searchsorted(row, np.arange(b.n))[r]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(X.as_i64(h1)), pa.array(X.as_i64(h2)), pa.array(doc[b.first + r]), pa.array(tk[b.first + r]),
                     pa.array(pos.astype(np.int32))], names=["h1", "h2", "doc", "tk", "pos"])

    return S.later_places(docs.select("doc", "tk", "text").mapInArrow(
        run, "h1 bigint, h2 bigint, doc bigint, tk bigint, pos int"))


def _apply(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                total, gone, kept = [], [], []
                for t, m in zip(part.column(1), part.column(2)):
                    words = (t.as_py() or "").encode().split()
                    total.append(len(words))
                    if m.is_valid:
                        drop = X.covered(len(words), np.asarray(m.values), k)
                        gone.append(int(drop.sum()))
                        words = [w for w, d in zip(words, drop.tolist()) if not d]
                    else:
                        gone.append(0)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                                  pa.array(kept, pa.string())], names=["doc", "n_words", "n_removed", "text"])
    return run


def deduped(docs: DataFrame, k: int = WORDS, gram: int = GRAM, bits: int = S.BITS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, text): every row with the words that are left, joined by spaces.

    ``collect_set`` holds window places of one document, at most as many as it has words.
    """
    src = identified(docs, id_col, text_col)
    marks = marked_windows(src, k, gram, bits).groupBy("doc", "tk").agg(F.collect_set("pos").alias("at"))
    return (src.join(marks, ["doc", "tk"], "left").select("doc", "text", "at")
            .mapInArrow(_apply(k), "doc bigint, n_words bigint, n_removed bigint, text string")
            .select(real_id(), "n_words", "n_removed", "text"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))

"""Line dedup that returns keep bitmaps (operator 10).

Lines that stand in many documents go from every document. The hashes of the
line keys are range-partitioned with a secondary sort by document and
position; every range is streamed once, which gives the first occurrence and
the number of documents of each key without holding a key's rows. The range
key is (hash, document), so a very common line is spread over several
ranges; the counts of its parts are added afterwards. What returns is one
compressed bitmap per document, not text.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` are always kept; rows with the same id and text are one document, rows
with the same id and other texts are several; a null id is an id like others;
an empty table gives an empty result; other columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .storage import identified, read, written

MIN_DOCS = 10
MIN_CHARS = 1


def line_spans(b: X.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every \\n-separated line of a block."""
    end = np.flatnonzero(b.data == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    return start, end, b.doc_of(start)


def stripped(b: X.Block, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lines without ASCII white space at both ends."""
    ink = np.flatnonzero(~X.SPACE[b.data])
    first, last = np.searchsorted(ink, start), np.searchsorted(ink, end) - 1
    some = last >= first
    ink = np.append(ink, 0)
    return np.where(some, ink[np.where(some, first, -1)], start), np.where(some, ink[np.where(some, last, -1)] + 1, start)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, doc, tk, pos) of every line that has a key; ``docs`` as from ``identified``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tk = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for b in X.blocks(batch.column(2)):
                start, end, row = line_spans(b)
                pos = np.arange(len(row)) - np.searchsorted(row, np.arange(b.n))[row]
                s, e = stripped(b, start, end)
                chars = np.concatenate(([0], np.cumsum((b.data & 0xC0) != 0x80, dtype=np.int64)))
                ok = chars[e] - chars[s] >= max(1, min_chars)
                h = X.span_hashes(b.sums(b.lower()), s[ok], e[ok])
                at = b.first + row[ok]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(X.as_i64(h)), pa.array(doc[at]), pa.array(tk[at]), pa.array(pos[ok].astype(np.int32))],
                    names=["h", "doc", "tk", "pos"])

    return docs.select("doc", "tk", "text").mapInArrow(run, "h bigint, doc bigint, tk bigint, pos int")


def _stream_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, doc, tk, pos) -> (h, first doc, first pos, documents) for each run of a hash.

    Only the open run is carried from batch to batch, as five numbers.
    """
    open_run = None                                     # [h, first doc, first pos, documents, last (doc, tk)]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = [np.concatenate(x) for x in zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "first_doc", "first_pos", "n_docs"])

    def closed() -> tuple:
        h, d, p, n, _ = open_run
        return np.array([h]), np.array([d]), np.array([p], np.int32), np.array([n], np.int64)

    for batch in batches:
        if not batch.num_rows:
            continue
        h, doc, tk, pos = (np.asarray(batch.column(i)) for i in range(4))
        new_doc = np.ones(len(h), bool)
        new_doc[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (tk[1:] != tk[:-1])
        begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        n = np.add.reduceat(new_doc.astype(np.int64), begin)
        first_doc, first_pos = doc[begin].copy(), pos[begin].copy()
        done = []
        if open_run is not None:
            if open_run[0] == h[0]:                     # the first run of the batch goes on with the open one
                n[0] += open_run[3] - (open_run[4] == (doc[0], tk[0]))
                first_doc[0], first_pos[0] = open_run[1], open_run[2]
            else:
                done.append(closed())
        if len(begin) > 1:
            done.append((h[begin[:-1]], first_doc[:-1], first_pos[:-1], n[:-1]))
        open_run = [h[-1], first_doc[-1], first_pos[-1], n[-1], (doc[-1], tk[-1])]
        if done:
            yield out(done)
    if open_run is not None:
        yield out([closed()])


def key_runs(keys: DataFrame) -> DataFrame:
    """(h, n_docs, first): the documents of every key and its first place, streamed from sorted ranges."""
    ranged = keys.repartitionByRange("h", "doc", "tk").sortWithinPartitions("h", "doc", "tk", "pos")
    runs = ranged.mapInArrow(_stream_runs, "h bigint, first_doc bigint, first_pos int, n_docs bigint")
    # a document's lines of one key are in one range; a common key's ranges add up
    return runs.groupBy("h").agg(F.sum("n_docs").alias("n_docs"), F.min(F.struct("first_doc", "first_pos")).alias("first"))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dropped positions per document -> compressed bitmap with a set bit for every dropped line."""
    for batch in batches:
        maps, sizes = [], []
        for v in batch.column(2):
            pos = np.asarray(v.values)
            bits = np.zeros(int(pos.max()) + 1, bool)
            bits[pos] = True
            maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            sizes.append(len(pos))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                          pa.array(maps, pa.binary())], names=["doc", "tk", "n_dropped", "drop_map"])


def drop_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, tk, n_dropped, drop_map) of every document that loses a line; ``docs`` as from ``identified``.

    ``collect_set`` holds the dropped lines of one document, as many as its text has.
    """
    keys = written(line_keys(docs, min_chars), "line-keys")
    # written, so that the join gets exchanges of its own, whose skewed partitions Spark can split
    common = written(key_runs(keys).filter(F.col("n_docs") >= min_docs).select("h"), "common-lines")
    dropped = keys.join(common, "h", "left_semi").groupBy("doc", "tk").agg(F.collect_set("pos").alias("pos"))
    return dropped.mapInArrow(_bitmaps, "doc bigint, tk bigint, n_dropped bigint, drop_map binary")


def dropped_lines(drop_map: bytes | None, n: int) -> np.ndarray:
    """The bitmap as booleans for the n lines of a text."""
    out = np.zeros(n, bool)
    if drop_map is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(drop_map), np.uint8))[:n]
        out[: len(bits)] = bits == 1
    return out


def _apply(field: int | None):
    """Rows (key, drop_map, text) -> (key, n_lines, n_dropped, text). ``field``: the text is that field of the key instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                total, gone, kept = [], [], []
                for t, m in zip(part.column(2) if field is None else part.column(0).field(field), part.column(1)):
                    text = t.as_py() or ""
                    lines = text.split("\n")
                    drop = dropped_lines(m.as_py(), len(lines))
                    total.append(len(lines))
                    gone.append(int(drop.sum()))
                    kept.append("\n".join(x for x, d in zip(lines, drop) if not d) if gone[-1] else text)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                                  pa.array(kept, pa.string())], names=["key", "n_lines", "n_dropped", "text"])
    return run


def _applied(docs: DataFrame, key: Column, field: int | None, min_docs: int, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(key, n_lines, n_dropped, text) of every row."""
    name = identified(docs, id_col, text_col, columns=True)
    maps = drop_bitmaps(docs.select(*name), min_docs, min_chars)
    src = docs.select(key.alias("key"), *(name if field is None else name[:2]))
    schema = T.StructType([src.schema["key"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                           T.StructField("text", T.StringType())])
    rows = src.join(maps, ["doc", "tk"], "left").select("key", "drop_map", *(["text"] if field is None else []))
    return rows.mapInArrow(_apply(field), schema)


def deduped(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row with the text that is left."""
    return _applied(docs, F.col(id_col), None, min_docs, min_chars, id_col, text_col).withColumnRenamed("key", "doc_id")


def cleaned(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with all its columns and the text that is left (a null text becomes the empty one)."""
    out = _applied(docs, F.struct("*"), docs.columns.index(text_col), min_docs, min_chars, id_col, text_col)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("key")[c].alias(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))

"""Count-min sketch over window anchors, and the range-sorted grouping of places by hash.

The *anchor* of a window is the least hash among the grams inside it, so equal
windows have equal anchors. The sketch counts the places of anchors; a
window's estimate is that of its anchor, which is never below the number of
windows with its content. Every place where a gram equals the least hash of a
window around it is counted, so windows that overlap their own copy (periodic
texts) are seen too.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .storage import written

BITS = 27               # cells of a row: 2**BITS; merged, one bit a cell: 16 MB a row
DEPTH = 2
SEGMENT = 16            # a sketch travels in segments of 2**SEGMENT cells
FLUSH = 1 << 21         # anchors a task holds before it sends its sketch


def sliding(op, a: np.ndarray, w: int) -> np.ndarray:
    """op over every w neighbours of a (minimum or maximum): len(a) - w + 1 values."""
    n = len(a) - w + 1
    if n <= 0:
        return a[:0]
    step = 1
    while 2 * step <= w:
        a = op(a[:-step], a[step:])
        step *= 2
    return op(a[:n], a[w - step: w - step + n]) if step < w else a[:n]


def anchored(grams: np.ndarray, w: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least gram of every window, places of anchors). Window i spans grams i .. i + w - 1; ``valid``: whole windows."""
    least = sliding(np.minimum, grams, w)
    masked = np.where(valid, least, X.U(0))
    pad = np.zeros(w - 1, X.U)
    most = sliding(np.maximum, np.concatenate((pad, masked, pad)), w)      # over the windows around each gram
    return least, np.flatnonzero(most == grams)


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of every hash in a row of the sketch."""
    return X.mix64(h + X.U((0x632BE59BD9B4E019 * (row + 1)) & (2**64 - 1))) >> X.U(64 - bits)


def _sent(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """A partition's sketch, sparse: for every segment the low bits of its cells, each twice if counted twice or more."""
    seg, low = [], []
    for row in range(DEPTH):
        c = np.sort(cells(hashes, row, bits))
        keep = np.ones(len(c), bool)
        keep[2:] = (c[2:] != c[1:-1]) | (c[1:-1] != c[:-2])               # counts over two say no more than two
        c = c[keep]
        s = (c >> X.U(SEGMENT)).astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        lows = (c & X.U((1 << SEGMENT) - 1)).astype("<u2")
        for i, j in zip(at, np.append(at[1:], len(c))):
            seg.append((row << 40) + int(s[i]))
            low.append(lows[i:j].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(seg, pa.int64()), pa.array(low, pa.binary())], names=["segment", "cells"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches sorted by segment -> for every segment a bitmap of the cells whose sum is two or more."""
    at, count = None, None

    def closed() -> pa.RecordBatch:
        bitmap = zlib.compress(np.packbits(count >= 2).tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([bitmap], pa.binary())],
                                          names=["segment", "bitmap"])

    for batch in batches:
        for s, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if s != at:
                if at is not None and (count >= 2).any():
                    yield closed()
                at, count = s, np.zeros(1 << SEGMENT, np.uint8)
            low = np.frombuffer(blob.as_buffer(), "<u2")
            once = np.ones(len(low), bool)
            once[1:] = low[1:] != low[:-1]
            count[low[once]] += 1
            count[low[~once]] += 1
            np.minimum(count, 2, out=count)
    if at is not None and (count >= 2).any():
        yield closed()


def repeated_cells(docs: DataFrame, anchors_of: Callable[[X.Block], np.ndarray], bits: int = BITS,
                   blocks: Callable[[pa.Array], Iterator[X.Block]] = X.blocks) -> Broadcast:
    """The merged sketch of the anchors of all texts, as a broadcast of one bit a cell (two or more).

    ``docs`` has a column ``text``; ``blocks`` cuts a column of texts, ``anchors_of`` gives a block's anchor hashes.
    The broadcast has DEPTH * 2**bits bits, whatever the input: 32 MB as set. More anchors than cells make the
    estimates higher and the second pass longer; they lose nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for b in blocks(batch.column(0)):
                held.append(anchors_of(b))
                n += len(held[-1])
                if n >= FLUSH:
                    yield _sent(np.concatenate(held), bits)
                    held, n = [], 0
        if n:
            yield _sent(np.concatenate(held), bits)

    merged = (docs.select("text").mapInArrow(run, "segment bigint, cells binary")
              .repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(_merged, "segment bigint, bitmap binary"))
    size = 1 << (SEGMENT - 3)
    flat = np.zeros((DEPTH, (1 << bits) // 8), np.uint8)
    for r in merged.toLocalIterator():                       # at most DEPTH * 2**(bits - SEGMENT) rows of 8 KB
        s = r.segment & ((1 << 40) - 1)
        flat[r.segment >> 40, s * size:(s + 1) * size] = np.frombuffer(zlib.decompress(r.bitmap), np.uint8)
    return docs.sparkSession.sparkContext.broadcast(flat)


def estimated_repeated(flat: np.ndarray, h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """True where the sketch's estimate, the least over its rows, is two or more."""
    out = np.ones(len(h), bool)
    for row in range(DEPTH):
        c = cells(h, row, bits)
        out &= (flat[row][c >> X.U(3)] >> (X.U(7) - (c & X.U(7))).astype(np.uint8)) & 1 == 1
    return out


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, doc, tk, pos) -> every row that is not the first of its hash in this range.

    ``edge`` rows say how the range begins and ends (the first row of its first and of its last run), so that a run over
    several ranges keeps one first row in all; only they keep their hash. Only one row is carried from batch to batch.
    """
    names = ["h1", "h2", "doc", "tk", "pos"]
    last = tail = None

    def out(cols: list[np.ndarray], edge: bool) -> pa.RecordBatch:
        n = len(cols[0])
        hashes = [pa.array(c) if edge else pa.nulls(n, pa.int64()) for c in cols[:2]]
        return pa.RecordBatch.from_arrays([*hashes, *(pa.array(c) for c in cols[2:]), pa.array(np.full(n, edge))],
                                          names=[*names, "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(i)) for i in range(5)]
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        same = np.zeros(len(new), bool)                 # a place that was just seen
        same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in cols])
        if last is None:
            yield out([c[:1] for c in cols], True)
        else:
            new[0] = (cols[0][0], cols[1][0]) != last[:2]
            same[0] = tuple(c[0] for c in cols) == last
        if new.any():
            i = np.flatnonzero(new)[-1]
            tail = [c[i:i + 1].copy() for c in cols]
        last = tuple(c[-1] for c in cols)
        yield out([c[~new & ~same] for c in cols], False)
    if tail is not None:
        yield out(tail, True)


def later_places(places: DataFrame) -> DataFrame:
    """(doc, tk, pos) of every place whose hash (h1, h2) also stands at an earlier one, by (doc, tk, pos).

    The places are range-partitioned by hash and place, so a hash with very many places is spread over ranges; no
    group is held or joined. The ranges' edges, two rows each, are settled by a small join. Equal rows are one place.
    The rows are written once: each reading of the exchange would have its own coalesced ranges, and edges of its own.
    """
    key = ["h1", "h2", "doc", "tk", "pos"]
    rows = written(places.repartitionByRange(*key).sortWithinPartitions(*key)
                   .mapInArrow(_later, "h1 bigint, h2 bigint, doc bigint, tk bigint, pos int, edge boolean"), "later")
    edges = rows.filter("edge").drop("edge")
    first = edges.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tk", "pos")).alias("first"))
    edge = edges.join(first, ["h1", "h2"]).filter(F.struct("doc", "tk", "pos") != F.col("first"))
    return rows.filter("NOT edge").select("doc", "tk", "pos").unionByName(edge.select("doc", "tk", "pos"))

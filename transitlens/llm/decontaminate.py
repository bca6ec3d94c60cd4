"""Benchmark decontamination by the q-gram lemma (operator 3).

A passage of m characters that occurs with at most e edits shares at least
``m + 1 - q * (e + 1)`` of its q-grams with the place where it stands, all on
diagonals that differ by at most 2 e. So: count shared q-grams of document
and item in overlapping diagonal bands, keep the bands that reach the bound,
and verify those regions by a banded alignment.

Searched are the windows of ``WINDOW`` characters at every offset of every item (whole
items, if shorter), so parts of an item are found too, wherever they begin. The windows
of a band that reach the bound are aligned together.
Texts and items are compared lower-cased with white space as single spaces;
characters are UTF-16 units.

The items are taken in blocks of bounded size; every block's index is
broadcast and meets all documents. More items make more blocks, not larger ones.

Defined cases: null or empty texts and items match nothing; items under
``MIN_ITEM`` characters are searched verbatim, without edits, by the hashes of their length;
where the edit share of a short window would void the bound, the budget is the
largest that keeps it; rows that repeat an id give one row per item; null ids
are kept; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .storage import read

Q = 8
WINDOW = 100
EDITS = 0.10            # edit budget as a share of a window's characters
MIN_ITEM = 24
ITEM_BLOCK = 1 << 20    # characters of items in a block
SLOTS = 20              # bits of the hash table in front of the index
WINDOWS = 256           # windows that are aligned together
PART = 1 << 17          # characters of documents that are searched together (their arrays fit a CPU's cache)

SCHEMA = "doc_id bigint, item_id bigint, distance int, shared_grams int, window_start int, found_at int"


def normal(text: str | None) -> np.ndarray:
    return np.frombuffer(" ".join((text or "").lower().split()).encode("utf-16-le", "surrogatepass"), "<u2")


def _values() -> np.ndarray:
    return X.mix64(np.arange(1, 65537, dtype=np.uint64))


def grams(units: np.ndarray, q: int, values: np.ndarray) -> np.ndarray:
    n = len(units) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = X.prefix_sums(values[units])
    return (sums[q:] - sums[:-q]) * X._powers(X._MULT, n)[1]


def budget(m: int, q: int, edits: float) -> tuple[int, int]:
    """(edits, shared q-grams that the lemma asks for) of a window of m characters."""
    e = min(int(edits * m), (m + 1) // q - 1)
    while e > 0 and m + 1 - q * (e + 1) < 1:
        e -= 1
    return e, max(1, m + 1 - q * (e + 1))


def windows_of(m: int, window: int) -> list[int]:
    """Starts of an item's windows."""
    return list(range(max(0, m - window) + 1))


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int, window: int, edits: float):
        self.q, self.window, self.edits = q, window, edits
        short = [x for x in items if len(x[1]) < max(MIN_ITEM, q)]
        items = [x for x in items if len(x[1]) >= max(MIN_ITEM, q)]
        self.ids = [i for i, _ in items + short]
        self.units = [u for _, u in items + short]
        values = _values()
        #: length -> hashes of the short items of that length, in order, and their numbers
        self.short: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for m in sorted({len(u) for _, u in short}):
            at: dict[int, list[int]] = {}
            for i in range(len(items), len(self.units)):
                if len(self.units[i]) == m:
                    at.setdefault(int(grams(self.units[i], m, values)[0]), []).append(i)
            self.short[m] = np.array(sorted(at), np.uint64), [at[h] for h in sorted(at)]
        self.t = np.empty(0, np.int64)
        if not items:
            return
        per = [grams(u, q, values) for _, u in items]
        g = np.concatenate(per)
        item = np.repeat(np.arange(len(per), dtype=np.int32), [len(x) for x in per])
        off = np.concatenate([np.arange(len(x), dtype=np.int32) for x in per])
        order = np.argsort(g, kind="stable")
        self.item, self.off = item[order], off[order]
        self.grams, first = np.unique(g[order], return_index=True)
        self.first = np.append(first, len(g))
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[self.grams >> np.uint64(64 - SLOTS)] = True
        bounds = [budget(min(len(u), window), q, edits) for _, u in items]
        self.e = max(e for e, _ in bounds)
        self.t = np.array([t for _, t in bounds])
        self.span = np.array([min(len(u), window) - q for _, u in items])

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Places whose gram is in the index and that lie dense enough for some window."""
        t, span = int(self.t.min()), self.window + 2 * self.e
        p = self._dense(np.flatnonzero(self.slots[g >> np.uint64(64 - SLOTS)]), t, span)
        at = np.minimum(np.searchsorted(self.grams, g[p]), len(self.grams) - 1)
        return self._dense(p[self.grams[at] == g[p]], t, span)

    @staticmethod
    def _dense(p: np.ndarray, t: int, span: int) -> np.ndarray:
        """The places that are among t places within span."""
        if len(p) < t:
            return p[:0]
        near = np.flatnonzero(p[t - 1:] - p[: len(p) - t + 1] <= span)
        return p[X.covered(len(p), near, t)]


def banded(pattern: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int]:
    """(least edits, end) of the pattern against a part of the region, over the diagonals 0 .. len(region) - len(pattern).

    Ends early, with most + 1, when the budget is used up.
    """
    k = np.arange(max(1, len(region) - len(pattern) + 1) + most)
    padded = np.concatenate((region.astype(np.int32), np.full(len(pattern) + len(k), -1, np.int32)))
    row = np.zeros(len(k), np.int64)                     # the pattern may begin on any diagonal
    for i, c in enumerate(pattern):
        up = np.append(row[1:], most + 1) + 1            # a character of the pattern is missing in the region
        row = np.minimum(row + (padded[i + k] != c), up)
        row = np.minimum.accumulate(row - k) + k         # a character of the region is extra
        if row.min() > most:
            return most + 1, 0
    j = int(row.argmin())
    return int(row[j]), len(pattern) + j


def aligned(item: np.ndarray, starts: np.ndarray, m: int, text: np.ndarray, base: int, diagonals: int, most: int) -> tuple[int, int, int]:
    """(least edits, start, end in the text) of an item's windows of m characters against the text, over the diagonals
    base .. base + diagonals - 1; the first start of the least, (most + 1, 0, 0) if none is within ``most``.

    A look whether a window stands in the text unchanged, then ``banded`` for WINDOWS windows at a time. Outside the
    text nothing equals the pattern, so parts that the text cuts off cost their length.
    """
    lo = max(0, base + int(starts[0]))
    hi = min(len(text), base + diagonals + int(starts[-1]) + m)
    whole = text[lo:hi].tobytes() if hi > lo else b""
    for s in starts.tolist():
        part = item[s:s + m].tobytes()
        at = whole.find(part)
        while at >= 0 and at % 2:
            at = whole.find(part, at + 1)
        if at >= 0:
            return 0, s, lo + at // 2 + m
    best = most + 1, 0, 0
    k = np.arange(diagonals, dtype=np.int16)
    for n in range(0, len(starts), WINDOWS):
        s = starts[n:n + WINDOWS]
        first, last = base + int(s[0]), base + int(s[-1]) + m + diagonals
        part = np.full(last - first, -1, np.int32)
        a, b = max(first, 0), min(last, len(text))
        if b > a:
            part[a - first:b - first] = text[a:b]
        view = np.lib.stride_tricks.sliding_window_view(part, diagonals)
        row, s0 = np.zeros((len(s), diagonals), np.int16), s[0]
        for i in range(m):
            up = np.full_like(row, most + 2)             # a character of the pattern is missing in the text
            up[:, :-1] = row[:, 1:] + 1
            row += view[s - s0 + i] != item[s + i][:, None]
            np.minimum(row, up, out=row)
            row = np.minimum.accumulate(row - k, axis=1) + k      # a character of the text is extra
            if i % 8 == 7:
                alive = row.min(axis=1) <= min(most, best[0] - 1)
                s, row = s[alive], row[alive]
                if not len(s):
                    break
        if len(s):
            least = row.min(axis=1)
            j = int(least.argmin())
            if least[j] < best[0]:
                end = base + int(s[j]) + m + int(row[j].argmin())
                best = int(least[j]), int(s[j]), min(max(end, 0), len(text))
    return best


def verbatim(ix: Index, units: list[np.ndarray], joined: np.ndarray, start: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """What ``search`` gives for the short items: the first place where a document holds one unchanged."""
    for m, (hashes, items) in ix.short.items():
        g = grams(joined, m, values)
        at = np.minimum(np.searchsorted(hashes, g), len(hashes) - 1)
        p = np.flatnonzero(hashes[at] == g)
        doc = np.searchsorted(start, p, "right") - 1
        _, first = np.unique(doc * len(hashes) + at[p], return_index=True)
        for place, d in zip(p[first].tolist(), doc[first].tolist()):
            lo = place - int(start[d])
            for i in items[at[place]]:
                if np.array_equal(units[d][lo:lo + m], ix.units[i]):
                    yield d, i, 0, max(0, m + 1 - ix.q), 0, lo + m


def search(ix: Index, units: list[np.ndarray], values: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(document, item, distance, shared grams, window start, place) of every document and item that match."""
    size = np.array([len(u) for u in units], np.int64)
    start = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(units), 10, np.uint16)     # no item has a line feed
    for s, u in zip(start, units):
        joined[s:s + len(u)] = u
    yield from verbatim(ix, units, joined, start, values)
    if not len(ix.t):
        return
    g = grams(joined, ix.q, values)
    p = ix.hits(g)
    if not len(p):
        return
    at = np.searchsorted(ix.grams, g[p])
    n = ix.first[at + 1] - ix.first[at]
    post = np.arange(n.sum()) + np.repeat(ix.first[at] - (np.cumsum(n) - n), n)
    place, item, off = np.repeat(p, n), ix.item[post], ix.off[post].astype(np.int64)
    doc = np.searchsorted(start, place, "right") - 1
    width = 2 * ix.e + 1
    shift = 1 << 21
    diag = place - start[doc] - off + shift
    # bands of two widths, one width apart: diagonals within one width are together in one of them
    band = np.concatenate((diag // width, diag // width - 1))
    doc, item, off = np.tile(doc, 2), np.tile(item, 2).astype(np.int64), np.tile(off, 2)
    order = np.lexsort((off, band, item, doc))
    doc, item, band, off = doc[order], item[order], band[order], off[order]
    cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1]), [True])))
    # bands with as many grams as the bound within the span of a window
    last = np.arange(len(off)) + ix.t[item] - 1
    ok = last < len(off)
    near = np.minimum(last, len(off) - 1)
    group = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    ok &= (group[near] == group) & (off[near] - off <= ix.span[item])
    enough = np.unique(group[ok])
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for a, b in zip(cut[enough], cut[enough + 1]):
        d, i = int(doc[a]), int(item[a])
        if best.get((d, i), (1,))[0] == 0:
            continue
        o = np.unique(off[a:b])
        item_units, base = ix.units[i], int(band[a]) * width - shift
        m = min(len(item_units), ix.window)
        e, t = budget(m, ix.q, ix.edits)
        starts = np.array(windows_of(len(item_units), ix.window))
        shared = np.searchsorted(o, starts + m - ix.q, "right") - np.searchsorted(o, starts)
        starts, shared = starts[shared >= t], shared[shared >= t]
        if not len(starts):
            continue
        distance, s, end = aligned(item_units, starts, m, units[d], base - e, 2 * width + 2 * e, e)
        if distance <= e and (distance, s) < best.get((d, i), (e + 1, 0))[:2]:
            best[d, i] = (distance, s, int(shared[np.searchsorted(starts, s)]), end)
    for (d, i), (distance, s, shared, end) in best.items():
        yield d, i, distance, shared, s, end


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end row, normal texts) of some rows at a time."""
    lo = 0
    while lo < len(texts):
        units, size, hi = [], 0, lo
        while hi < len(texts) and size < PART:
            units.append(normal(texts[hi].as_py()))
            size += len(units[-1])
            hi += 1
        yield lo, hi, units
        lo = hi


def _block_leaks(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, values = shared.value, _values()
        for batch in batches:
            for lo, _, units in _parts(batch.column(1)):
                rows = [(batch.column(0)[lo + d].as_py(), ix.ids[i], *rest) for d, i, *rest in search(ix, units, values)]
                if rows:
                    types = [pa.int64()] * 2 + [pa.int32()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                     names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.mapInArrow(run, SCHEMA)


def _without(docs: DataFrame, field: int, index: Index) -> DataFrame:
    """The rows (key) that hold no item of the index; the text is a field of the key."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, values = shared.value, _values()
        for batch in batches:
            for lo, hi, units in _parts(batch.column(0).field(field)):
                hit = {d for d, *_ in search(ix, units, values)}
                yield batch.take(pa.array([r for r in range(lo, hi) if r - lo not in hit], pa.int64()))

    return docs.mapInArrow(run, docs.schema)


def _indexes(benchmark: DataFrame, q: int, window: int, edits: float, item_block: int, item_col: str, item_text_col: str) -> Iterator[Index]:
    """Indexes over blocks of items; the items come to the driver one partition at a time, and one block is held."""
    block, size = [], 0
    for r in benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).toLocalIterator():
        u = normal(r.t)
        if not len(u):
            continue
        block.append((r.i, u))
        size += len(u)
        if size >= item_block:
            yield Index(block, q, window, edits)
            block, size = [], 0
    if block:
        yield Index(block, q, window, edits)


def cleaned(docs: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: float = EDITS,
            item_block: int = ITEM_BLOCK, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows that hold no window of an item, with all their columns; nothing is shuffled."""
    rows = docs.select(F.struct("*").alias("key"))
    for index in _indexes(benchmark, q, window, edits, item_block, item_col, item_text_col):
        rows = _without(rows, docs.columns.index(text_col), index)
    return rows.select("key.*")


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: float = EDITS,
          item_block: int = ITEM_BLOCK, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, shared_grams, window_start, found_at): documents that hold a window of an item.

    One row per document and item, with the closest window. ``found_at`` is where the found passage ends in the normal form of the text.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = [_block_leaks(src, ix) for ix in _indexes(benchmark, q, window, edits, item_block, item_col, item_text_col)]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy("doc_id", "item_id").agg(
        F.min(F.struct("distance", "window_start", "shared_grams", "found_at")).alias("best")).select(
        "doc_id", "item_id", "best.distance", "best.shared_grams", "best.window_start", "best.found_at")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))

"""Substring dedup over bytes by merged Burrows-Wheeler transforms (operator 2).

Every byte that a string of ``LENGTH`` bytes covers goes, if that string also
starts earlier. The steps:

1. Anchors. The anchor of a window (a string of LENGTH bytes) is the leftmost
   place of the least hash among its grams of ``GRAM`` bytes; equal windows
   have it at the same place. A count-min sketch over the anchors (``sketch``)
   leaves the windows that may be repeated; consecutive ones with one anchor form a segment
   (under 2 * LENGTH bytes). A text that stands once never moves.
2. Segments are range-partitioned by anchor, content and place and streamed: a segment equal to
   an earlier one is repeated as a whole. The first ones go on where an anchor has several contents.
3. Segments with one anchor meet in one task. A batch of them is cut in shards; every shard's
   suffixes are sorted and give its Burrows-Wheeler transform. The transforms are merged by
   iterative interleave refinement: the interleave for contexts of k bytes gives that for k + 2
   through a stable distribution by the two symbols before, and the round in which two neighbours part
   gives their common prefix. No suffix is sorted again. After LENGTH rounds the blocks that
   are still together are the repeated intervals; all their places but the first are covered.
4. An anchor with more than ``MOST`` different segments is not held by one task: its windows are
   grouped exactly by hash over ranges instead (``sketch.later_places``).

Matches never cross documents. Defined cases: null and empty texts have no
bytes; texts shorter than LENGTH lose nothing; rows with the same id and text
are one document, with the same answer; a null id comes first, rows that share an id with
other texts are ordered by a text fingerprint; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sketch as S
from . import text as X
from .storage import identified, read, real_id, written

LENGTH = 100
GRAM = 32
MOST = 20_000           # different segments of one anchor in a task
BATCH = 1 << 18         # bytes of segments that are merged at a time, but whole anchors
SHARD = 1 << 16         # bytes of segments in a shard
BLOCK = 1 << 18
PIECE = 1 << 22         # longer texts are cut, with LENGTH - 1 bytes in common
PLACE = 23              # bits of a place in a block


def pieces(column: pa.Array, length: int) -> Iterator[tuple[X.Block, np.ndarray, np.ndarray]]:
    """(block, row of each text, its first byte in the row): whole texts, or long ones in overlapping pieces."""
    texts, rows, bases, size = [], [], [], 0
    for i, v in enumerate(column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())):
        t = v.as_py() or b""
        for base in range(0, max(1, len(t) - length + 1), PIECE - length + 1):
            part = t[base:base + PIECE]
            if texts and size + len(part) > BLOCK:
                yield X.Block(texts, 0), np.array(rows), np.array(bases)
                texts, rows, bases, size = [], [], [], 0
            texts.append(part)
            rows.append(i)
            bases.append(base)
            size += len(part) + 1
    if texts:
        yield X.Block(texts, 0), np.array(rows), np.array(bases)


def runs(b: X.Block, length: int, gram: int):
    """(sums, gram hashes, first window, end window, anchor) of every run of whole windows with one anchor."""
    sums = b.sums()
    n = len(b.data) - length + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return sums, none, none, none, none
    g = (sums[gram:] - sums[:-gram]) * X._powers(X._MULT, len(sums) - gram)[1]
    low = X.U((1 << PLACE) - 1)
    least = S.sliding(np.minimum, (g & ~low) | np.arange(len(g), dtype=X.U), length - gram + 1)
    anchor = (least & low).astype(np.int64)
    whole = np.ones(n + 1, bool)
    for s, e in zip(b.start.tolist(), b.end.tolist()):
        whole[max(s, e - length + 1):e + 1] = False
    whole = whole[:n]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]))))
    end = np.append(first[1:], n)
    ok = whole[first]
    return sums, g, first[ok], end[ok], anchor[first[ok]]


def segments(docs: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """(h, c, doc, tk, pos, seg): the segments of windows whose anchor is estimated repeated."""

    def anchors_of(b: X.Block) -> np.ndarray:
        _, g, _, _, a = runs(b, length, gram)
        return g[np.unique(a)] if len(a) else np.empty(0, X.U)

    flags = S.repeated_cells(docs, anchors_of, bits, lambda column: (b for b, _, _ in pieces(column, length)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = flags.value
        for batch in batches:
            doc, tk = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for b, row, base in pieces(batch.column(2), length):
                sums, g, first, end, a = runs(b, length, gram)
                if not len(a):
                    continue
                hit = S.estimated_repeated(flat, g[a], bits)
                first, end, a = first[hit], end[hit] + length - 1, a[hit]
                size = end - first
                ends = np.cumsum(size)
                data = b.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]
                at = b.doc_of(first)
                seg = pa.BinaryArray.from_buffers(pa.binary(), len(size), [
                    None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(X.as_i64(X.mix64(g[a]))), pa.array(X.as_i64(X.span_hashes(sums, first, end))), pa.array(doc[row[at]]),
                     pa.array(tk[row[at]]), pa.array((first - b.start[at] + base[at]).astype(np.int64)), seg],
                    names=["h", "c", "doc", "tk", "pos", "seg"])

    return docs.select("doc", "tk", "text").mapInArrow(run, "h bigint, c bigint, doc bigint, tk bigint, pos bigint, seg binary")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (h, c, doc, tk, pos) -> the later places of equal segments (``seg`` null), and the first
    ones of anchors with several contents.

    An anchor's leading segment waits (one row) until a second content of the anchor comes. The range's first
    and last anchors may go on in other ranges, so theirs are passed on in any case.
    """
    names = ["h", "doc", "tk", "pos", "size", "seg"]
    last = held = None

    def out(batch: pa.RecordBatch, size: np.ndarray, rows: np.ndarray, keep: bool) -> pa.RecordBatch:
        part = batch.take(pa.array(rows))
        seg = part.column(5) if keep else pa.nulls(len(rows), pa.binary())
        return pa.RecordBatch.from_arrays([part.column(i) for i in (0, 2, 3, 4)] + [pa.array(size[rows]), seg], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        seg = batch.column(5)
        size = np.diff(np.frombuffer(seg.buffers()[1], np.int32)[seg.offset:seg.offset + len(seg) + 1])
        cols = [np.asarray(batch.column(i)) for i in range(5)]
        differs = [np.concatenate(([last is None or c[0] != v], c[1:] != c[:-1])) for c, v in zip(cols, last or cols)]
        new_anchor = differs[0]
        new = new_anchor | differs[1]
        same_place = ~(new | differs[2] | differs[3] | differs[4])
        yield out(batch, size, np.flatnonzero(~new & ~same_place), False)
        first = np.flatnonzero(new)
        if len(first):
            lead = new_anchor[first]
            if held is not None and not lead[0]:
                yield held
            held = None
            send = ~lead | np.append(~lead[1:], False)
            send[0] |= last is None
            yield out(batch, size, first[send], True)
            if not send[-1]:
                held = out(batch, size, first[-1:], True)
        last = [c[-1] for c in cols]
    if held is not None:
        yield held


def suffix_order(sym: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The suffixes of a shard in order, by prefix doubling. ``sym`` is 0 where a segment ends, ``end`` that place for
    every symbol; equal suffixes keep the order of their segments."""
    n = len(sym)
    at, bits = np.arange(n), max(1, (n - 1).bit_length())
    rank, k, count = np.zeros(n, np.int64), 4, -1
    for j in range(k):                                   # the first four symbols as one number
        rank = rank * 256 + sym[np.minimum(at + j, end)]
    _, rank = np.unique(rank, return_inverse=True)
    while True:
        key = rank * (int(rank.max()) + 1) + rank[np.minimum(at + k, end)]
        order = np.argsort((key << bits) | at) if key.max() < 1 << (62 - bits) else np.argsort(key, kind="stable")
        s = key[order]
        level = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        if level[-1] == count:
            return order
        count = level[-1]
        rank[order] = level
        k *= 2


def transform(sym: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The shard's Burrows-Wheeler transform: the symbol before every suffix (0 before a segment's first)."""
    return np.where(order > 0, sym[order - 1], 0).astype(np.uint8)


NONE = np.uint16(65535)      # no symbols before: sorts behind all


def before(bwt: np.ndarray) -> np.ndarray:
    """Where a shard's order has the suffix that begins one symbol earlier (its LF mapping); of use where there is one."""
    out = np.empty(len(bwt), np.int32)
    out[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)
    return out


def merged(bwts: list[np.ndarray], strings: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(the interleave of the shards, block of equal ``length``-prefixes): the merged order by interleave refinement.

    The interleave names suffixes by their places in the shards' orders, one shard after the other. A round takes it
    from contexts of k symbols to k + 2: the two symbols before every suffix (from the transforms), in the interleave's
    order, are distributed stably, and each suffix gives way to the one that begins two symbols earlier; suffixes of
    fewer than two symbols enter in a fixed order. Blocks part where the symbols or the block of the context
    differ, so a boundary that appears in a round is a common prefix of its k or k + 1. An odd ``length`` begins with a round of one
    symbol. Ends early when a round parts nothing.
    """
    base = np.concatenate(([0], np.cumsum([len(b) for b in bwts])))[:-1]
    one = np.concatenate(bwts).astype(np.uint16)
    lf = np.concatenate([before(b) + np.int32(o) for b, o in zip(bwts, base)])
    ends = np.concatenate([np.arange(o, o + n, dtype=np.int32) for o, n in zip(base, strings)])    # suffixes without a symbol sort first
    two = one[lf] * np.uint16(256) + one
    steps = [(np.where(one == 0, NONE, one * np.uint16(256)), lf, ends, np.zeros(len(ends), np.uint16))] if length % 2 else []
    later = (np.where((one == 0) | (one[lf] == 0), NONE, two), lf[lf], np.concatenate((ends, lf[ends])),
             np.concatenate((np.zeros(len(ends), np.uint16), one[ends] * np.uint16(256))))
    steps += [later] * (length // 2)
    n = len(one)
    where, block, count = np.arange(n, dtype=np.int32), np.zeros(n, np.int32), 1
    for keys, back, short, short_keys in steps:
        key = np.concatenate((short_keys, keys[where]))
        order = np.argsort(key, kind="stable")[:n]
        part = key[order]
        old = np.concatenate((np.zeros(len(short), np.int32), block))[order]
        where = np.concatenate((short, back[where]))[order]
        block = np.empty(n, np.int32)
        block[0] = 0
        np.cumsum((part[1:] != part[:-1]) | (old[1:] != old[:-1]), out=block[1:])
        if block[-1] + 1 == count:
            break
        count = int(block[-1]) + 1
    return where, block


def covered_windows(segs: list[bytes], place: np.ndarray, length: int, shard_bytes: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of every window whose content also stands at an earlier place; ``place``: of each segment, and
    places within it follow by one a byte."""
    present = np.unique(np.frombuffer(b"".join(segs), np.uint8))
    code = np.zeros(256, np.uint8)
    code[present] = np.arange(1, len(present) + 1)      # texts are UTF-8, which leaves byte values over
    size = np.fromiter(map(len, segs), np.int64, len(segs))
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), max(shard_bytes, size.sum() // 200 + 1)), "right")
    cuts = np.unique(np.append(cuts, len(segs)))
    bwts, suffixes, strings, base = [], [], [], 0
    for lo, hi in zip(np.append(0, cuts[:-1]) if cuts[0] else cuts[:-1], cuts if cuts[0] else cuts[1:]):
        block = X.Block(segs[lo:hi], 0)
        sym = code[block.data]
        sym[block.end] = 0
        order = suffix_order(sym, np.repeat(block.end, block.size + 1))
        bwts.append(transform(sym, order))
        suffixes.append(order + base)
        strings.append(hi - lo)
        base += len(sym)
    where, block = merged(bwts, strings, length)
    sa = np.concatenate(suffixes)[where]
    start = np.cumsum(size + 1) - size - 1
    seg = np.searchsorted(start, sa, "right") - 1
    off = sa - start[seg]
    whole = size[seg] - off >= length
    seg, off, block = seg[whole], off[whole], block[whole]
    if not len(seg):
        return seg, off
    where = place[seg] + off
    lead = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    later = where > np.repeat(np.minimum.reduceat(where, lead), np.diff(np.append(lead, len(where))))
    return seg[later], off[later]


def _spans(doc: np.ndarray, tk: np.ndarray, pos: np.ndarray, seg: np.ndarray, off: np.ndarray, length: int) -> pa.RecordBatch:
    """Covered windows -> (doc, tk, start, end), consecutive ones as one span."""
    order = np.lexsort((off, seg))
    seg, off = seg[order], off[order]
    lead = np.flatnonzero(np.concatenate(([True], (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)))[:len(seg)])
    tail = np.append(lead[1:], len(seg)) - 1 if len(lead) else lead
    s = seg[lead]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[s]), pa.array(tk[s]), pa.array(pos[s] + off[lead]), pa.array(pos[s] + off[tail] + length)],
        names=["doc", "tk", "start", "end"])


def _merge_batches(length: int):
    """Segments sorted by anchor -> spans of covered windows; whole anchors at a time, BATCH bytes or one anchor's more."""

    def work(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        doc, tk, pos = (rows.column(c).to_numpy() for c in ("doc", "tk", "pos"))
        # places as numbers: documents by rank, bytes within
        order = np.lexsort((tk, doc))
        rank = np.empty(len(doc), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum((doc[order][1:] != doc[order][:-1]) | (tk[order][1:] != tk[order][:-1]))))
        seg, off = covered_windows(rows.column("seg").to_pylist(), (rank << 40) + pos, length)
        return _spans(doc, tk, pos, seg, off, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            lo = 0
            h = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.concatenate(([last is not None and h[:1] != last], h[1:] != h[:-1]), axis=None)) if len(h) else []
            for cut in cuts:                             # places where another anchor begins
                part = batch.slice(lo, cut - lo)
                if cut > lo:
                    held.append(part)
                    size += int(np.asarray(part.column(4)).sum())
                lo = cut
                if size >= BATCH:
                    yield work(held)
                    held, size = [], 0
            if batch.num_rows > lo:
                held.append(batch.slice(lo))
                size += int(np.asarray(held[-1].column(4)).sum())
            last = h[-1] if len(h) else last
        if held:
            yield work(held)

    return run


def _windows(length: int):
    """Segments -> (h1, h2, doc, tk, pos) of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, tk, pos = (np.asarray(batch.column(i)) for i in range(4))
            for b in X.blocks(batch.column(5), BLOCK):
                n = b.size - length + 1
                row = np.repeat(np.arange(b.n), n)
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = b.start[row] + off
                c = X.span_hashes(b.sums(), s, s + length)
                at = b.first + row
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at]), pa.array(X.as_i64(c)), pa.array(doc[at]), pa.array(tk[at]), pa.array((pos[at] + off).astype(np.int32))],
                    names=["h1", "h2", "doc", "tk", "pos"])

    return run


def covered_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = S.BITS, most: int = MOST) -> DataFrame:
    """(doc, tk, start, end): the byte spans that go; they may overlap. ``docs`` as from ``identified``."""
    gram = min(gram, length)
    place = ["h", "c", "doc", "tk", "pos"]
    found = written(segments(docs, length, gram, bits).repartitionByRange(*place).sortWithinPartitions(*place)
                    .mapInArrow(_streamed, "h bigint, doc bigint, tk bigint, pos bigint, size int, seg binary"), "segments")
    whole = found.filter("seg IS NULL").select("doc", "tk", F.col("pos").alias("start"), (F.col("pos") + F.col("size")).alias("end"))
    several = found.filter("seg IS NOT NULL")
    counts = several.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = written(counts, "anchors")
    alike = several.join(counts.filter(F.col("n") <= most).select("h"), "h", "left_semi").select("h", "doc", "tk", "pos", "size", "seg")
    # an anchor's segments, at most ``most``, in one task; a fixed number of tasks, since their work is not their bytes
    tasks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = (alike.repartition(tasks, "h").sortWithinPartitions("h")
             .mapInArrow(_merge_batches(length), "doc bigint, tk bigint, start bigint, end bigint"))
    hot = several.join(counts.filter(F.col("n") > most).select("h"), "h", "left_semi").select("h", "doc", "tk", "pos", "size", "seg")
    later = S.later_places(hot.mapInArrow(_windows(length), "h1 bigint, h2 bigint, doc bigint, tk bigint, pos int"))
    return whole.unionByName(spans).unionByName(
        later.select("doc", "tk", F.col("pos").cast("long").alias("start"), (F.col("pos") + length).cast("long").alias("end")))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            total, gone, spans, kept = [], [], [], []
            for t, m in zip(part.column(1), part.column(2)):
                raw = (t.as_py() or "").encode()
                total.append(len(raw))
                if m.is_valid and len(m.values):
                    d = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(d, np.asarray(m.values.field("start")), 1)
                    np.add.at(d, np.asarray(m.values.field("end")), -1)
                    drop = np.cumsum(d[:-1]) > 0
                    gone.append(int(drop.sum()))
                    spans.append(int(np.count_nonzero(drop[1:] & ~drop[:-1]) + drop[0]))
                    raw = np.frombuffer(raw, np.uint8)[~drop].tobytes()
                else:
                    gone.append(0)
                    spans.append(0)
                kept.append(raw)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in (total, gone, spans)), pa.array(kept, pa.binary())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def deduped(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = S.BITS, most: int = MOST,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every row with the bytes that are left.

    The spans of one document are collected, at most as many as its text has bytes.
    """
    src = identified(docs, id_col, text_col)
    spans = covered_spans(src, length, gram, bits, most).groupBy("doc", "tk").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    return (src.join(spans, ["doc", "tk"], "left").select("doc", "text", "spans")
            .mapInArrow(_apply, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
            .select(real_id(), "n_bytes", "n_removed", "n_spans", "kept"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

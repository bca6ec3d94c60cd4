"""Byte-level BPE encoding and decoding with DuckDB inside the partitions (operator 6).

Encoding: a text is split by the tokenizer's pattern. The distinct words of a
batch become rows (word, position, token), one per byte; a recursive query
joins neighbours with the merge table and contracts each word's leftmost pair
of minimum rank until no pair is left. Where there are more than a few words over SHORT bytes, they contract more in
one step, with the same result: the places of the word's minimum rank
(overlaps from the left, which is the same order, up to the first whose new token can meet
a lower rank) and every pair that is *sure*. A pair (l, r) of rank k is sure if nothing of a lower or equal rank can
take l or r away before its turn, or meet the new token:

* its neighbours y and z may grow, but y only to tokens that end with y, z to
  tokens that begin with z; the pair table holds the least rank of all such
  (Y, l) and (r, Z), ``lo`` and ``hi``, and both must be over k;
* the new token's pairs with such Y and Z must rank over k.

So the order in which the pairs are contracted makes no difference, and a word
takes a few steps in place of one for each token it loses. Words over LONG bytes do the same
in a keyed recursion, which keeps one state instead of all steps. Decoding: each id takes its place in the
vocabulary's list, and an aggregation in the order of the ids puts a text's bytes together.

The ranks file is read once on the driver; the pair table is broadcast and is
bounded by the vocabulary, not by the data.

Defined cases: a null or empty text has no tokens and decodes to an empty
text; very long texts are split in pieces at a place where no word ends
otherwise; repeated rows are encoded one by one; ids may be null; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import per_process, read

SHORT = 20              # bytes; longer words contract all sure pairs in a step
LONG = 256              # bytes; longer words take the keyed recursion
BYTES_AT_ONCE = 300_000     # of the words in one recursion
FEW = 1_000_000             # squares of the bytes of words over SHORT that are not worth a recursion of their own
STATE_AT_ONCE = 16_000_000  # squares of the words' bytes in one recursion that keeps all its steps
NONE = 2**31 - 1        # the rank of a pair that is no token
IDS_AT_ONCE = 1 << 20
PIECE = 1 << 21         # code points
MEMORY = "500MB"        # of a DuckDB connection
KNOWN_WORDS = 100_000   # distinct words a worker remembers from task to task, the most used ones; twice as many within some texts
NARROW = 0x3000         # code points; texts below it are split by the standard library's expressions

ENCODE = """
WITH RECURSIVE t(w, pos, tok, step) AS (
  SELECT w, pos, tok, 0 FROM init
  UNION ALL (
    WITH pair AS (
      SELECT a.w, a.pos, merges.tok FROM t a JOIN t b ON b.w = a.w AND b.pos = a.pos + 1
      JOIN merges ON merges.l = a.tok AND merges.r = b.tok),
    least AS (SELECT w, arg_min(pos, tok::BIGINT * 4294967296 + pos) AS pos, min(tok) AS tok FROM pair GROUP BY w)
    SELECT t.w, CASE WHEN t.pos > least.pos THEN t.pos - 1 ELSE t.pos END,
           CASE WHEN t.pos = least.pos THEN least.tok ELSE t.tok END, t.step + 1
    FROM t JOIN least USING (w) WHERE t.pos <> least.pos + 1))
SELECT w, tok FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY w, pos
"""

# A token's position is its first byte, so its right neighbour stands at pos + len.
CONTRACTED = f"""
    pair AS (
      SELECT a.w, a.pos, b.pos AS nxt, b.len AS more, pairs.tok, lo, hi
      FROM now a JOIN now b ON b.pos = a.pos + a.len AND b.w = a.w JOIN pairs ON pairs.l = a.tok AND pairs.r = b.tok),
    best AS (SELECT w, min(tok) AS tok FROM pair WHERE tok < {NONE} GROUP BY w),
    least AS (SELECT w, pos, nxt, tok, more FROM pair JOIN best USING (w, tok)),
    link AS (SELECT *, CASE WHEN lag(nxt) OVER (ORDER BY pos) = pos THEN 0 ELSE 1 END AS head FROM least),
    run AS (SELECT *, sum(head) OVER (ORDER BY pos) AS r FROM link),
    late AS (
      SELECT x.pos FROM pair x JOIN now y ON y.pos + y.len = x.pos AND y.w = x.w JOIN on_left o ON o.l = y.tok AND o.r = x.tok
      UNION ALL
      SELECT x.pos FROM pair x JOIN now z ON z.pos = x.nxt + x.more AND z.w = x.w JOIN on_right o ON o.l = x.tok AND o.r = z.tok),
    other AS (SELECT *, CASE WHEN pos IN (SELECT pos FROM late) THEN 1 ELSE 0 END AS ends FROM (
      SELECT *, row_number() OVER (PARTITION BY r ORDER BY pos) AS i FROM run) WHERE i % 2 = 1),
    taken AS (SELECT * FROM (SELECT *, sum(ends) OVER (PARTITION BY w ORDER BY pos) - ends AS ended FROM other) WHERE ended = 0),
    sure AS (
      SELECT x.w, x.pos, x.nxt, x.tok, x.more FROM pair x LEFT JOIN pair y ON y.nxt = x.pos LEFT JOIN pair z ON z.pos = x.nxt
      WHERE x.tok < {NONE} AND x.tok < coalesce(y.lo, {NONE}) AND x.tok < coalesce(z.hi, {NONE})
        AND x.pos NOT IN (SELECT pos FROM late)
      UNION SELECT w, pos, nxt, tok, more FROM taken)"""

ENCODE_SURE = f"""
WITH RECURSIVE t(w, pos, tok, len, step) AS (
  SELECT w, pos, tok, 1, 0 FROM init
  UNION ALL (
    WITH now AS (FROM t), {CONTRACTED}
    SELECT t.w, t.pos, coalesce(s.tok, t.tok), t.len + coalesce(s.more, 0), t.step + 1
    FROM t LEFT JOIN sure s ON s.pos = t.pos WHERE t.w IN (SELECT w FROM sure) AND t.pos NOT IN (SELECT nxt FROM sure)))
SELECT w, tok FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY w, pos
"""

# -1 marks a token that was taken in.
ENCODE_KEYED = f"""
WITH RECURSIVE t(pos, w, tok, len) USING KEY (pos) AS (
  SELECT pos, w, tok, 1 FROM init
  UNION (
    WITH now AS (SELECT s.pos, s.w, s.tok, s.len FROM recurring.t s WHERE s.tok >= 0 AND s.w IN (SELECT w FROM t)), {CONTRACTED}
    SELECT pos, w, tok, nxt - pos + more FROM sure UNION ALL SELECT nxt, w, -1, 0 FROM sure))
SELECT w, tok FROM t WHERE tok >= 0 ORDER BY w, pos
"""

# A list is aggregated in its own order; nulls are left out.
DECODE = """
SELECT doc, coalesce(list_aggregate(list_select((SELECT bytes FROM vocab), places), 'string_agg', ''), '') AS text FROM ids
"""


def vocabulary(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a ranks file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_table(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, tok, lo, hi), NONE where there is no such rank.

    tok: the token of both; lo: the least of all tokens of (some token that ends with l, r); hi: of (l, some token that
    begins with r).
    """
    tok, lo, hi = {}, {}, {}
    for t, k in ranks.items():
        for i in range(1, len(t)):
            left, right = t[:i], t[i:]
            if left not in ranks or right not in ranks:
                continue
            l, r = ranks[left], ranks[right]
            tok[l, r] = k
            for y in (ranks[left[j:]] for j in range(len(left)) if left[j:] in ranks):
                lo[y, r] = min(k, lo.get((y, r), NONE))
            for z in (ranks[right[:j]] for j in range(1, len(right) + 1) if right[:j] in ranks):
                hi[l, z] = min(k, hi.get((l, z), NONE))
    keys = sorted(lo.keys() | hi.keys())
    return pa.table({n: pa.array(c, pa.int32()) for n, c in (
        ("l", [k[0] for k in keys]), ("r", [k[1] for k in keys]),
        *((n, [d.get(k, NONE) for k in keys]) for n, d in (("tok", tok), ("lo", lo), ("hi", hi))))})


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in pieces that end before a single space between two other characters; words never cross that place."""
    at = 0
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) - 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _connect(tables: dict[str, pa.Table]):
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
    con.execute("SET temp_directory = ''")
    for name, rows in tables.items():
        _load(con, name, rows)
    return con


def _load(con, name: str, rows: pa.Table) -> None:
    con.register("given", rows)
    con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
    con.unregister("given")


class _Numbers(dict):
    """Words and their numbers; a new word gets the next one when it is looked up."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Words:
    """Words and their ids: those of word i are ``ids[lo[i]:lo[i] + n[i]]``."""

    def __init__(self):
        self.index = _Numbers()
        self.lo, self.n, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.int32)

    def numbers(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """The words' numbers, and the words among them that were not known, in the order of their numbers."""
        first = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new = list(islice(reversed(self.index), len(self.index) - first))[::-1]
        self.lo, self.n, self.used = (np.concatenate((x, np.zeros(len(new), np.int64))) for x in (self.lo, self.n, self.used))
        self.used += np.bincount(at, minlength=len(self.index))
        return at, new

    def add(self, numbers: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """``ids``: those of all the words with these numbers, in turn; ``n``: how many each has."""
        self.lo[numbers] = len(self.ids) + np.cumsum(n) - n
        self.n[numbers] = n
        self.ids = np.concatenate((self.ids, ids))

    def shorten(self) -> None:
        """Forgets all but the KNOWN_WORDS words used most, of late rather than before, once there are twice as many."""
        if len(self.index) > 2 * KNOWN_WORDS:
            kept = np.sort(np.argsort(-self.used, kind="stable")[:KNOWN_WORDS])
            words = list(self.index)
            self.index = _Numbers((words[i], k) for k, i in enumerate(kept.tolist()))
            self.ids, self.n, self.used = self.ids_of(kept), self.n[kept], self.used[kept] // 2
            self.lo = np.cumsum(self.n) - self.n

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        lo, n = self.lo[numbers], self.n[numbers]
        return self.ids[np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)]


#: The pattern of most byte-level vocabularies; {s}, {l} and {n} stand for white space, letters and numbers.
_ITS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BY_RANGES = "'s|'t|'re|'ve|'m|'ll|'d| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+"


def _class(member: Callable[[str], object], below: int) -> str:
    """The code points whose character is a member, as ranges of a character class."""
    found = np.array([c for c in range(below) if member(chr(c))])
    cuts = np.flatnonzero(np.diff(found) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(found[[0, *(cuts + 1)]], found[[*cuts, -1]]))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """text -> words. The standard library's expressions are faster, but know no classes: texts of ASCII and those below
    NARROW have theirs as ranges, which the pattern's own classes give."""
    import regex

    find = regex.compile(pattern).findall
    if pattern != _ITS_PATTERN:
        return find
    classes = {k: regex.compile(c).match for k, c in (("s", r"\s"), ("l", r"\p{L}"), ("n", r"\p{N}"))}
    ascii_, narrow = (re.compile(_BY_RANGES.format(**{k: _class(m, below) for k, m in classes.items()})).findall for below in (128, NARROW))
    wide = re.compile(f"[\\U{NARROW:08x}-\\U0010ffff]").search
    return lambda text: (ascii_ if text.isascii() else find if wide(text) else narrow)(text)


class Encoder:
    """Words to ids in one task, through DuckDB."""

    def __init__(self, pairs: pa.Table, byte_ids: np.ndarray, pattern: str, ranks_path: str):
        self.find = per_process(("bpe split", pattern), lambda: splitter(pattern))
        self.con = _connect({"merges": pairs.filter(pc.less(pairs["tok"], NONE)).select(["l", "r", "tok"])})
        self.pairs, self.byte_ids = pairs, byte_ids
        self.words = per_process(("bpe words", ranks_path, pattern), Words)

    def close(self) -> None:
        self.con.close()

    def _run(self, words: list[bytes], sql: str) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per word, tokens)."""
        if sql is not ENCODE and self.pairs is not None:
            for name, of in (("pairs", pc.scalar(True)), ("on_left", pc.field("lo") < pc.field("r")), ("on_right", pc.field("hi") < pc.field("l"))):
                _load(self.con, name, self.pairs.filter(of))
            self.pairs = None
        n = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        init = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), n),
                         "pos": np.arange(len(data), dtype=np.int32),
                         "tok": self.byte_ids[data]})
        self.con.register("init", init)
        got = self.con.execute(sql).fetchnumpy()
        self.con.unregister("init")
        return np.bincount(got["w"], minlength=len(words)), np.asarray(got["tok"], np.int32)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, ids of all words in turn); words that are not known yet are encoded."""
        self.words.shorten()
        at, new = self.words.numbers(words)
        try:
            self._learn(len(self.words.index) - len(new), new)
        except BaseException:
            self.words.__init__()       # numbers without ids would be taken for known words
            raise
        return self.words.n[at], self.words.ids_of(at)

    def _learn(self, first: int, new: list[str]) -> None:
        """Encodes the words that have the numbers from ``first`` on."""
        raw = [w.encode() for w in new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        long = size > LONG
        short = (size <= SHORT) | ~long & bool((size[(size > SHORT) & ~long] ** 2).sum() < FEW)
        for sql, of in ((ENCODE, short), (ENCODE_SURE, ~short & ~long), (ENCODE_KEYED, long)):
            part = np.flatnonzero(of)
            cost = size[part] / BYTES_AT_ONCE
            if sql is ENCODE_SURE:
                cost = np.maximum(cost, size[part] ** 2 / STATE_AT_ONCE)
            cuts = np.flatnonzero(np.diff(np.cumsum(cost) // 1)) + 1
            for some in np.split(part, cuts):
                if len(some):
                    self.words.add(first + some, *self._run([raw[i] for i in some], sql))


def _ids(enc: Encoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, ids), some texts at a time: their words, then their ids."""
    lo = 0
    while lo < batch.num_rows:
        words, ends, size, hi = [], [0], 0, lo
        while hi < batch.num_rows and size < PIECE:
            text = batch.column(1)[hi].as_py() or ""
            for p in pieces(text):
                words += enc.find(p)
            ends.append(len(words))
            size += len(text)
            hi += 1
        n, ids = enc.ids(words)
        ends = np.concatenate(([0], np.cumsum(n)))[ends].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
            names=["doc_id", "ids"])
        lo = hi


def _bytes(con, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) -> (doc_id, ids, bytes): what the ids stand for, from the ids alone."""
    lists = batch.column(1)
    n = np.asarray(lists.value_lengths().fill_null(0))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(n[lo:]), IDS_AT_ONCE, "right")))
        part, m = lists.slice(lo, hi - lo), n[lo:hi]
        tok = part.flatten()
        known = pc.fill_null(pc.and_(pc.greater_equal(tok, 0), pc.less(tok, NONE)), False)
        places = pc.if_else(known, pc.add(tok, 1), NONE)        # a list's places count from 1; those past its end are null
        ends = np.concatenate(([0], np.cumsum(m))).astype(np.int32)
        con.register("ids", pa.table({"doc": np.arange(hi - lo, dtype=np.int32), "places": pa.ListArray.from_arrays(pa.array(ends), places)}))
        found = con.sql(DECODE).to_arrow_table()
        con.unregister("ids")
        texts = [b""] * (hi - lo)
        for d, t in zip(found["doc"].to_numpy(), found["text"]):
            texts[d] = t.as_py().encode("latin-1")
        yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), part, pa.array(texts, pa.binary())],
                                         names=["doc_id", "ids", "bytes"])
        lo = hi


def _vocabulary_table(ranks: dict[bytes, int]) -> pa.Table:
    """(bytes): one row with the list of all tokens by rank, null where there is none. A byte is a character of one byte's
    value, so string aggregation keeps bytes that are no whole character."""
    by_rank = [None] * (max(ranks.values()) + 1)
    for t, k in ranks.items():
        by_rank[k] = t.decode("latin-1")
    return pa.table({"bytes": pa.array([by_rank], pa.list_(pa.string()))})


def _encoding(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, decode: bool) -> DataFrame:
    ranks = vocabulary(ranks_path)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(
        ((pair_table(ranks), byte_ids, pattern, ranks_path), _vocabulary_table(ranks) if decode else None))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, vocab = shared.value
        enc, con = Encoder(*tables), _connect({"vocab": vocab}) if decode else None
        try:
            for batch in batches:
                for part in _ids(enc, batch):
                    if decode:
                        yield from _bytes(con, part)
                    else:
                        yield part
        finally:
            enc.close()
            if con is not None:
                con.close()

    return src.mapInArrow(run, "doc_id bigint, ids array<int>" + (", bytes binary" if decode else ""))


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every text, in one pass without a shuffle."""
    return _encoding(docs, ranks_path, pattern, id_col, text_col, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, bytes): ``decoded(encoded(..))`` in one pass; the bytes come from the ids alone."""
    return _encoding(docs, ranks_path, pattern, id_col, text_col, True)


def decoded(rows: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, bytes) for rows (doc_id, ids): the bytes that the ids stand for, from the ids alone."""
    shared = rows.sparkSession.sparkContext.broadcast(_vocabulary_table(vocabulary(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect({"vocab": shared.value})
        try:
            for batch in batches:
                yield from _bytes(con, batch)
        finally:
            con.close()

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, bytes binary")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))

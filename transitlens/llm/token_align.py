"""Cross-tokenizer alignment: every distinct text is tokenised by two tokenizers and aligned once.

Documents are shuffled by their full text and become one row per distinct
text with its number of copies (counted map-side first, so a text that a third
of the rows share crosses the shuffle once per task). Each distinct text is
encoded by both tokenizers and aligned on byte offsets: where tokens of both
end, a group ends, and the two tokens that end there are *linked*. The counts of
linked id pairs over the corpus weigh each text by its copies. A text's
measures against these counts then go back to all its documents by digest.

Two tokens that end at the same byte agree from the end backwards, so one is a
suffix of the other. The two vocabularies therefore fix all pairs that can
ever be linked (``Pairs``, some hundred thousand), whatever the corpus is: the
counts have that proven size, are numbered by it, and may be broadcast.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads
space + text; B is a sentencepiece model, which adds the space itself. Special
tokens are never added, and their strings inside texts are plain text.

Defined results: a null or empty text, and one whose tokens of A or B do not spell
space + text byte for byte (a normaliser changed it), has no tokens: zeros and
an empty ``groups_sha256``. Texts of more than ``PIECE_CHARS`` are encoded in pieces,
cut where neither tokenizer has a token across (one space between an ASCII letter or digit and an ASCII
letter); what has no such place stays whole. Rows that repeat an id or a text each get their
measures; an empty table gives no rows. Columns beside id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import NO_ID, per_process, read, real_id, written

PIECE_CHARS = 1 << 19
BATCH_CHARS = 1 << 18
CUT = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z])")
# Latin, Greek, Cyrillic, punctuation, kana, common ideographs, Hangul: assigned long before either library's tables.
PLAIN = re.compile("[\\x00-\u024f\u0391-\u03a1\u03a3-\u03ff\u0400-\u0482\u048a-\u0523\u2010-\u2027\u2030-\u205e\u20ac"
                   "\u3001-\u3003\u3008-\u3011\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e]*")


def byte_chars() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, as the
    published scheme has it: printable Latin-1 stands for itself, the others count up from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of every id.

    A byte-level BPE file without a normaliser is the same encoding as its
    vocabulary read as ranks, once a text is split into words. tiktoken does that at a
    quarter of the cost, so it encodes texts of ``PLAIN`` characters, whose classes
    (letter, number, space) all Unicode versions share; the file's own library encodes all others.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a_path = a_path
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        names = {i: t for t, i in spec["model"]["vocab"].items()} | added
        chars = byte_chars()
        self.a_bytes = [added[i].encode() if i in added else bytes(chars[c] for c in names[i]) for i in range(len(names))]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        if not (self.a_len.all() and self.b_len.all()):
            raise ValueError("a vocabulary has an entry without bytes")
        first = spec["pre_tokenizer"] or {}
        plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first["add_prefix_space"]
        self.ranks = None
        if plain and spec["normalizer"] is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"):
            import tiktoken
            self.ranks = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                           mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if i not in added})

    @functools.cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # one core a task
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(self.a_path)
        a.encode_special_tokens = True
        return a

    @staticmethod
    def _piece(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if self.ranks is not None and PLAIN.fullmatch(text):
            return self.ranks.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both for space + text."""
        a, b = [], []
        for piece in cut(" " + text):
            a += self.encode_a(piece)
            b += self.b.encode(piece[1:])
        return a, b


def cut(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces that begin with a space, each cut at the first safe place after ``most`` characters."""
    at = 0
    while len(text) - at > most:
        place = CUT.search(text, at + most)
        if place is None:
            break
        yield text[at:place.start()]
        at = place.start()
    yield text[at:]


class Pairs:
    """All (a, b) ids of which one's bytes end with the other's, numbered in order."""

    def __init__(self, t: Tokenizers):
        self.n_b = len(t.b_bytes)
        by_a, by_b = defaultdict(list), defaultdict(list)
        for table, entries in ((by_a, t.a_bytes), (by_b, t.b_bytes)):
            for i, x in enumerate(entries):
                table[x].append(i)
        keys = {a * self.n_b + b for a, x in enumerate(t.a_bytes) for n in range(len(x)) for b in by_b.get(x[n:], ())}
        keys |= {a * self.n_b + b for b, x in enumerate(t.b_bytes) for n in range(1, len(x)) for a in by_a.get(x[n:], ())}
        self.keys = np.array(sorted(keys), np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of a * n_b + b."""
        return np.searchsorted(self.keys, keys)

    def __len__(self) -> int:
        return len(self.keys)


def loaded(a_path: str, b_path: str) -> tuple[Tokenizers, Pairs, list[str]]:
    """Kept by every worker: tokenizers, pairs, and the texts of ids with what may follow them in a group."""
    def make():
        t = Tokenizers(a_path, b_path)
        shown = [f"{i}{end}" for n, ends in ((len(t.a_bytes), ",|"), (len(t.b_bytes), ",;")) for end in ends for i in range(n)]
        return t, Pairs(t), shown

    return per_process(("aligned tokenizers", a_path, b_path), make)


ALIGNED = "digest binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pair array<int>, times array<int>"


def aligned_text(t: Tokenizers, pairs: Pairs, shown: list[str], text: str, a: list[int], b: list[int]) -> tuple | None:
    """(n_a, n_b, n_groups, groups_sha256, pairs, times) of one text; None where the tokens do not spell it."""
    want = (" " + text).encode()
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    a_end, b_end = np.cumsum(t.a_len[a]), np.cumsum(t.b_len[b])
    if not len(a) or not len(b) or not a_end[-1] == b_end[-1] == len(want):
        return None
    if any(b"".join([table[i] for i in ids.tolist()]) != want for table, ids in ((t.a_bytes, a), (t.b_bytes, b))):
        return None
    _, last_a, last_b = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
    n_a = len(t.a_bytes)
    codes, groups = [], []
    for ids, last, first, size, turn in ((a, last_a, 0, n_a, 0), (b, last_b, 2 * n_a, len(t.b_bytes), 1)):
        ends = np.zeros(len(ids), np.int64)
        ends[last] = 1
        codes.append(ids + first + size * ends)              # the texts of ``shown``: the last of a group has another sign
        groups.append(2 * (np.cumsum(ends) - ends) + turn)
    order = np.argsort(np.concatenate(groups), kind="stable")
    text = "".join([shown[i] for i in np.concatenate(codes)[order].tolist()])[:-1]
    pair, times = np.unique(a[last_a] * pairs.n_b + b[last_b], return_counts=True)
    return (len(a), len(b), len(last_a), hashlib.sha256(text.encode()).hexdigest(),
            pairs.number(pair).astype(np.int32), times.astype(np.int32))


def align(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, pairs, shown = loaded(*paths)
        for batch in batches:
            for part in bounded(batch, "text"):
                texts = part["text"].to_pylist()
                found = [aligned_text(t, pairs, shown, *x) for x in ((x, *t.encode(x)) for x in texts)]
                keep = [i for i, x in enumerate(found) if x is not None]
                if not keep:
                    continue
                n_a, n_b, n_groups, sha, pair, times = zip(*[found[i] for i in keep])
                rows = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [rows["digest"], rows["copies"], *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)], pa.array(sha),
                     *[pa.array(x, pa.list_(pa.int32())) for x in (pair, times)]],
                    ["digest", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pair", "times"])
    return run


def bounded(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_CHARS`` bytes of text, so that a task's memory does not follow its rows."""
    block = np.cumsum(pc.binary_length(batch[column]).to_numpy().astype(np.int64)) // BATCH_CHARS
    edge = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else []
    for a, b in zip(edge, [*edge[1:], len(block)]):
        yield batch.slice(a, b - a)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, the row of every value) of a list column."""
    size = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(size)), size)


def counted(n: int):
    """Task function: links per pair number, each text weighed by its copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            pair, row = flat(batch["pair"])
            np.add.at(total, pair, flat(batch["times"])[0] * batch["copies"].to_numpy()[row])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "links"])
    return run


def measured(counts, best):
    """Task function: n_best and count_sum of every text. ``counts``, ``best``: broadcast arrays by pair number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, row = flat(batch["pair"])
            times = flat(batch["times"])[0]
            sums = []
            for x in (times * best.value[pair], times * counts.value[pair]):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, x)
                sums.append(pa.array(total))
            names = ["digest", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], *sums], [*names, "n_best", "count_sum"])
    return run


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Alignment:
    """The aligned distinct texts of a corpus (written), and the counts of all linked pairs."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, text_col: str = "text"):
        self.spark, self.text_col = docs.sparkSession, text_col
        text = F.col(text_col).alias("text")
        distinct = docs.select(text).where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        self.texts = written(distinct.select(digest(F.col("text")).alias("digest"), "text", "copies")
                             .mapInArrow(align((a_path, b_path)), ALIGNED), "aligned-texts")
        tokenizers, self.pairs, _ = loaded(a_path, b_path)
        parts = self.texts.select("copies", "pair", "times").mapInArrow(counted(len(self.pairs)), "pair int, links long")
        found = parts.groupBy("pair").agg(F.sum("links").alias("links")).toArrow()        # at most len(self.pairs) rows
        self.counts = np.zeros(len(self.pairs), np.int64)
        self.counts[found["pair"].to_numpy()] = found["links"].to_numpy()
        b = self.pairs.keys % self.pairs.n_b
        most = np.zeros(self.pairs.n_b, np.int64)
        np.maximum.at(most, b, self.counts)
        self.best = (self.counts > 0) & (self.counts == most[b])

    def lexicon(self) -> DataFrame:
        """(a_id, b_id, links, best) of every pair that is linked somewhere."""
        at = np.flatnonzero(self.counts)
        table = pa.table({"a_id": self.pairs.keys[at] // self.pairs.n_b, "b_id": self.pairs.keys[at] % self.pairs.n_b,
                          "links": self.counts[at], "best": self.best[at]})
        return self.spark.createDataFrame(table)

    def measures(self, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
        sc = self.spark.sparkContext
        run = measured(sc.broadcast(self.counts), sc.broadcast(self.best))
        texts = self.texts.drop("copies").mapInArrow(
            run, "digest binary, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long")
        rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), digest(F.col(self.text_col)).alias("digest"))
        numbers = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")}
        # no bytes are between two cuts, so one token of each ends there: as many links as groups
        return rows.join(texts, "digest", "left").withColumns(numbers).select(
            real_id(), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return Alignment(docs, *paths).measures(docs)

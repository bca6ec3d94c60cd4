"""Vectorised text helpers for Python tasks: Arrow batches -> byte blocks -> word, line and window hashes.

A *block* is the texts of some rows, joined by ``\\n`` into one byte array of
bounded size (a single longer text makes a block of its own), so a task's
memory does not depend on how many or how long the rows of a batch are.
Hashes are 64-bit: a polynomial over random byte values, taken from prefix
sums, then mixed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U = np.uint64
_MULT = 0x9E3779B97F4A7C15          # odd, so it has an inverse mod 2**64
_WMULT = 0xD6E8FEB86659FD93
_cache: dict = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection on 64-bit integers."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """mult**i and its inverse, for i < n (grown on demand, kept per process)."""
    have = _cache.get(mult)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for m in (mult, pow(mult, -1, 1 << 64)):
            a = np.full(size, U(m))
            a[0] = 1
            both.append(np.cumprod(a, dtype=U))
        have = _cache[mult] = tuple(both)
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, mult: int = _MULT) -> np.ndarray:
    """S with S[j] - S[i] = sum of values[i:j] * mult**position (mod 2**64)."""
    out = np.empty(len(values) + 1, U)
    out[0] = 0
    np.cumsum(values * _powers(mult, len(values))[0], dtype=U, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, mult: int = _MULT) -> np.ndarray:
    """Mixed hashes of the spans [start, end); equal content gives equal hashes wherever it stands."""
    inv = _powers(mult, len(sums))[1]
    raw = (sums[end] - sums[start]) * inv[start]
    return mix64(raw + (end - start).astype(U) * U(0xC2B2AE3D27D4EB4F))


def byte_values() -> np.ndarray:
    """A fixed pseudo-random 64-bit value for each byte."""
    if "bytes" not in _cache:
        _cache["bytes"] = mix64(np.arange(1, 257, dtype=U) * U(_WMULT))
    return _cache["bytes"]


def table(chars: bytes) -> np.ndarray:
    """Lookup table: True at the given bytes."""
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


SPACE = table(b" \t\n\x0b\x0c\r")


class Block:
    """Texts of rows ``first`` .. ``first + n`` of a batch as one byte array.

    ``data``: the bytes, each text followed by one ``\\n``; ``start`` / ``end``:
    every text's place in it.
    """

    def __init__(self, texts: list[bytes], first: int):
        self.texts, self.first, self.n = texts, first, len(texts)
        self.size = np.fromiter(map(len, texts), np.int64, self.n)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.end = np.cumsum(self.size + 1) - 1
        self.start = self.end - self.size

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, pos, "right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over every text (separators excluded)."""
        s = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return s[self.end] - s[self.start]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, row) of every run of bytes other than ASCII white space."""
        ink = np.concatenate(([False], ~SPACE[self.data]))
        edge = np.flatnonzero(ink[1:] != ink[:-1])     # the data ends with \n, so runs are closed
        start, end = edge[0::2], edge[1::2]
        return start, end, self.doc_of(start)

    def lower(self) -> np.ndarray:
        """The bytes with A-Z lower-cased."""
        d = self.data
        return np.where((d >= 65) & (d <= 90), d + np.uint8(32), d)

    def sums(self, data: np.ndarray | None = None) -> np.ndarray:
        return prefix_sums(byte_values()[self.data if data is None else data])


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks over a string column; null is the empty text."""
    texts: list[bytes] = []
    size = first = 0
    raw = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    for i, v in enumerate(raw):
        b = v.as_py() or b""
        if texts and size + len(b) > most:
            yield Block(texts, first)
            texts, size, first = [], 0, i
        texts.append(b)
        size += len(b) + 1
    if texts:
        yield Block(texts, first)


def window_hashes(word_hash: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of k consecutive words of one row."""
    if len(word_hash) < k:
        return np.empty(0, np.int64), np.empty(0, U)
    sums = prefix_sums(word_hash, _WMULT)
    at = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1:])
    return at, span_hashes(sums, at, at + k, _WMULT)


def repeated(keys: np.ndarray) -> np.ndarray:
    """True at every key that occurs more than once."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.empty(len(s), bool)
    out[order] = same[1:] | same[:-1]
    return out


def covered(n: int, at: np.ndarray, k: int) -> np.ndarray:
    """True at the places 0..n-1 that some span [at, at + k) covers."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, at, 1)
    np.add.at(d, at + k, -1)
    return np.cumsum(d[:-1]) > 0


def in_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that are equal only for equal keys of one row."""
    return mix64(keys + mix64(row.astype(U) + U(1)))


def as_i64(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def sha256(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()

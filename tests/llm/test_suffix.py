import random

import numpy as np
import pytest

from brute import SF, sha, window_dedup
from transitlens.llm import suffix_dedup as D
from transitlens.llm.storage import read


def expected(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    first, seen = {}, {}
    for i, b in sorted(set(raw), key=lambda x: (x[0] is not None, x[0])):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], (i, p))
    out = []
    for i, b in raw:
        drop = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] != (i, p):
                drop[p:p + length] = True
        spans = int((np.diff(np.concatenate(([0], drop.astype(int)))) == 1).sum())
        out.append((i, len(b), int(drop.sum()), spans, bytes(x for x, d in zip(b, drop) if not d)))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[4])


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in D.op2_suffix_dedup(spark, SF).collect())
    assert got == sorted((i, n, g, s, sha(k)) for i, n, g, s, k in expected(rows, 100))
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("length,gram,bits,most,seed", [(12, 4, 16, 1000, 1), (9, 9, 16, 3, 2), (20, 5, 18, 2, 3)])
def test_random_rows(spark, docs, monkeypatch, length, gram, bits, most, seed):
    rng = random.Random(seed)
    bit = [("".join(rng.choice("abé") for _ in range(30))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([rng.choice(bit), rng.choice(bit)[:17], rng.choice("abc") * rng.randint(1, 9)])
                        for _ in range(rng.randint(0, 7)))) for i in range(70)]
    rows += [(100, "a" * 300), (101, None), (102, ""), (103, "ab" * 60), rows[5], rows[5], (None, rows[7][1]), (104, "x" * (length - 1))]
    for name, value in (("BATCH", 300), ("SHARD", 90), ("BLOCK", 500), ("PIECE", 60)):
        monkeypatch.setattr(D, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = [tuple(r) for r in D.deduped(docs(rows), length, gram, bits, most).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = [(*r[:4], bytes(r[4])) for r in got]
    assert sorted(got, key=key) == sorted(expected(rows, length), key=key)
    assert sum(r[2] for r in got) > 1000


def test_merge_equals_sorting_all_suffixes():
    rng = random.Random(4)
    segs = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60))) for _ in range(200)] + [b"abcabcabcabc" * 4] * 3
    order = [rng.randrange(10**6) * 1000 for _ in segs]
    for shard in (50, 500, 10**6):
        seg, off = D.covered_windows(segs, np.array(order), 12, shard)
        first = {}
        for s, o in zip(segs, order):
            for p in range(len(s) - 11):
                first[s[p:p + 12]] = min(first.get(s[p:p + 12], 1 << 60), o + p)
        want = {(i, p) for i, s in enumerate(segs) for p in range(len(s) - 11) if first[s[p:p + 12]] < order[i] + p}
        assert set(zip(seg.tolist(), off.tolist())) == want and len(want) > 50


def test_empty(spark, docs):
    assert D.deduped(docs([])).count() == 0

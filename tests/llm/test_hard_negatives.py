"""Hard negatives against plain Python over all pairs; the bounds against exact scores."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from transitlens.llm import hard_negatives as H

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("rank", T.StringType()),
                        T.StructField("tie", T.StringType())])


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], l, "x", "y", None) for i, v, l in rows], VECTORS)
    return make


def brute(rows, every=50, positives=5, negatives=3):
    taken = {}
    for i, v, l in rows:
        if i is None or l is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        taken[(i, l, c)] = None
    taken = list(taken)
    out = []
    for a in taken:
        if a[0] % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in taken if b is not a))
        good = [(-s, i) for s, i, l in scored if l == a[1]][:positives]
        for p, pid in good:
            bad = [(-s, i) for s, i, l in scored if l != a[1] and 50 * p <= -100 * s <= 95 * p][:negatives]
            out += [(a[0], pid, k + 1, i, p, n) for k, (n, i) in enumerate(bad)]
    return sorted(out)


def result(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def data(n, dim=8, seed=0, labels=3, centres=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    if centres:
        x = r.normal(size=(centres, dim))[np.arange(n) % centres] * 4 + x * 0.2
    return [(i, [float(np.float32(y)) for y in v], int(r.integers(labels))) for i, v in enumerate(x)]


@pytest.mark.parametrize("rows", [data(400), data(300, dim=3, seed=1, centres=6), data(120, dim=1, seed=2)], ids=["any", "groups", "one"])
def test_equals_all_pairs(vectors, rows):
    assert result(H.mined(H.valid(vectors(rows)), every=10)) == brute(rows, every=10)


def test_rows_that_take_no_part_and_ties(vectors):
    nan, inf = float("nan"), float("inf")
    rows = data(60, dim=4, seed=3) + [(100, None, 1), (150, [1.0, nan, 0, 0], 1), (200, [1.0, inf, 0, 0], 1), (250, [1.0, None, 0, 0], 0),
                                      (300, [1.0, 1, 1, 1], None), (None, [1.0, 1, 1, 1], 1), (350, [0.0] * 4, 0), (400, [-1.0, -2, 1, 3], 2)]
    rows += [(500 + i, [1.0, 2, 3, 4], 1) for i in range(30)] + [(600 + i, [0.7, 1.4, 2.1, 2.8], 2) for i in range(30)] + [(500, [1.0, 2, 3, 4], 1)] * 3
    found = result(H.mined(H.valid(vectors(rows))))
    assert found == brute(rows)
    assert [r[3] for r in found if r[0] == 500 and r[1] == 501] == [600, 601, 602]       # ties by the smaller id


def test_repeated_ids_are_rows_of_their_own(vectors):
    rows = data(40, dim=4, seed=5) + [(0, [3.0, 1, 0, 2], 0), (0, [3.0, 1, 0, 1], 0), (50, [2.0, 1, 0, 1], 1)]
    assert result(H.mined(H.valid(vectors(rows)))) == brute(rows)


def test_lengths_differ_and_numbers_are_huge(vectors):
    rows = [(0, [1.0, 2.0, 3.0], 0), (1, [1.0], 0), (2, [2.0, 1.0], 1), (3, [], 1), (50, [1e6, 1e6], 0), (51, [3e6, 2e6], 0), (52, [1e6, 1.1e6], 1), (53, [2e6, 1.5e6], 1),
            (100, [3e9, 3e9], 2), (101, [2.9e9, 3e9], 2), (102, [1.5e9, 1.4e9], 3)]
    found = result(H.mined(H.valid(vectors(rows))))
    small = [r for r in found if r[4] < 1 << 62]
    assert small == [r for r in brute(rows) if r[4] < 1 << 62] and small
    assert result(H.mined(H.valid(vectors([(0, [1e38] * 2, 0), (1, [1e38] * 2, 0)])))) == []


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 0)], [(0, [1.0], 0), (1, [1.0], 1)]], ids=["none", "alone", "no positive"])
def test_few_rows(vectors, rows):
    assert result(H.mined(H.valid(vectors(rows)))) == []


def group_of(rows, directions=None):
    comps = np.floor(256 * np.array([v for _, v, _ in rows]))
    d = H.fitted(comps) if directions is None else directions
    angle = H.angles(comps, d)
    near = angle.argmin(1)
    order = np.lexsort((angle[np.arange(len(near)), near], near))
    t = pa.table({"vec_id": pa.array([rows[i][0] for i in order]), "label": pa.array([rows[i][2] for i in order]), "tie": pa.array([0] * len(order)),
                  "comps": pa.array([comps[i].astype(np.int64).tolist() for i in order]), "norm": H.norms(comps)[order],
                  "angles": pa.array([angle[i].tolist() for i in order]), "near": near[order]})
    return t, H.Group(t)


@pytest.mark.parametrize("centres", [0, 5])
def test_every_score_lies_in_its_bounds(centres):
    t, group = group_of(data(2000, dim=6, seed=7, centres=centres) + [(9999, [0.0] * 6, 0)])
    q = H.anchor_rows(t.slice(0, 300))
    low, high = group.bounds(q["angle"], q["norm"])
    exact = H.scores(q["comps"], group.comps)
    for i, (a, b) in enumerate(zip(group.start, group.end)):
        assert (exact[:, a:b] >= low[:, i:i + 1]).all() and (exact[:, a:b] <= high[:, i:i + 1]).all()


def test_grouped_vectors_skip_most_windows():
    rows = data(20_000, dim=16, seed=8, labels=4, centres=16)
    t, group = group_of(rows)
    q = H.anchor_rows(t.slice(0, 64))
    group.best(q, np.full((64, 1), -H.TOP - 1), np.full((64, 1), H.TOP), 5, True)
    assert group.scored < 0.35 * group.seen


def test_the_directions_change_the_work_only():
    rows = data(3000, dim=6, seed=9, centres=4)
    out = []
    for d in (None, np.eye(6), np.zeros((1, 6))):
        t, group = group_of(rows, d)
        q = H.anchor_rows(t)
        i, w, r, s = group.best(q, np.full((3000, 1), -H.TOP - 1), np.full((3000, 1), H.TOP), 5, True)
        out.append(sorted(zip(q["vec_id"][i].tolist(), group.id[r].tolist(), s.tolist())))
    assert out[0] == out[1] == out[2]

import random

import numpy as np
import pytest

from brute import SF, WORD, lower
from transitlens.llm import minhash as M
from transitlens.llm.components import components
from transitlens.llm.storage import LEAST_ID, read


def shingles(t, k):
    w = WORD.findall(lower(t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, percent):
    rows = list(dict.fromkeys((i, t or "") for i, t in rows))
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                key = lambda x: (rows[x][0] is not None, rows[x][0])
                root[max(a, b, key=key)] = min(a, b, key=key)
    return {(i, t): (len(s), rows[find(n)][0]) for n, ((i, t), s) in enumerate(zip(rows, sets))}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    want = {i: x for (i, _), x in brute(rows, 3, 85).items()}
    got = M.op4_minhash_near_dedup(spark, SF).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({x[1] for x in want.values()}) < len(rows)


def test_groups_of_variants_and_odd_rows(spark, docs):
    """A base and variants whose similarity to each other is near the threshold, a shared passage, short and empty rows."""
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    base = [word() for _ in range(120)]
    rows = [(10, " ".join(base))]
    for i in range(40):
        v = list(base)
        for _ in range(rng.randint(1, 5)):
            v[rng.randrange(len(v))] = word()
        rows.append((11 + i, " ".join(v)))
    passage = [word() for _ in range(60)]
    rows += [(100 + i, " ".join(passage + [word() for _ in range(50)])) for i in range(30)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "One"), (204, "one"), (205, "one two"), (206, "ONE Two"),
             (207, "a a a a"), (208, "a a a a a a"), rows[3], rows[3], (300, rows[5][1]), (None, rows[7][1])]
    want = brute(rows, 3, 85)
    got = M.near_duplicates(docs(rows), 3, 85).collect()
    assert len(got) == len(rows)
    ids = {}
    for r in got:
        ids.setdefault(r.doc if r.doc >= LEAST_ID else None, []).append((r.n_shingles, r.root.doc if r.root.doc >= LEAST_ID else None))
    for (i, _), x in want.items():
        assert x in ids[i], i
    assert len({r.root for r in got if r.doc in range(100, 130)}) == 30


def test_empty_and_no_links(spark, docs):
    assert M.near_duplicates(docs([])).count() == 0
    assert M.near_duplicates(docs([(1, "a b c d e f"), (2, None)])).count() == 2


def test_signatures_are_shifts_of_one_permutation():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = np.concatenate((a[:3000], rng.integers(0, 2**63, 1000).astype(np.uint64)))
    sig = M.signatures(np.concatenate((a, b)), np.array([0, 4000]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 3000 / 5000) < 0.05
    x = np.arange(1 << 20, dtype=np.uint32)
    assert len(np.unique(M.pi(x.copy(), np.empty_like(x)))) == len(x) and len(np.unique(M.sigma(x))) == len(x)


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_chains(spark, n):
    rng = random.Random(n)
    ids = list(range(n * 2))
    rng.shuffle(ids)
    chains = [ids[:n], ids[n:]]
    edges = [(a, b) for c in chains for a, b in zip(c, c[1:])] + [(1, 1)]
    got = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {x: min(c) for c in chains for x in c if x != min(c)}

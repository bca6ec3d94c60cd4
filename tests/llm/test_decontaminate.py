import random

import numpy as np

from brute import SF
from transitlens.llm import decontaminate as D
from transitlens.llm.storage import read


def edit_within(p, t):
    """Least edits of p against any part of t (plain dynamic programming)."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i] + [0] * len(t)
        for j, x in enumerate(t, 1):
            new[j] = min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def norm(t):
    return " ".join((t or "").lower().split())


def brute(docs, items, window=D.WINDOW, edits=D.EDITS):
    out = {}
    for d, t in docs:
        for i, x in items:
            x, n = norm(x), norm(t)
            if len(x) < D.MIN_ITEM:
                continue
            m = min(len(x), window)
            e = D.budget(m, D.Q, edits)[0]
            best = min(edit_within(x[s:s + m], n) for s in D.windows_of(len(x), window))
            if best <= e:
                out[d, i] = best
    return out


def edited(rng, t, n):
    t = list(t)
    for _ in range(n):
        i = rng.randrange(len(t))
        t[i:i + 1] = rng.choice([[], [rng.choice("xyzé")], [t[i], rng.choice("xyz")]])
    return "".join(t)


def test_edited_passages_equal_brute_force(spark, docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(1, text(30)), (2, text(16)), (3, text(8)), (4, "short one"), (5, None), (6, ""), (7, "É" + text(20))]
    rows = [(None, None), (0, ""), (1, text(60))]
    for n in range(24):
        src = items[rng.choice([0, 1, 2, 6])][1]
        lo = rng.choice([0, 0, 30])
        rows.append((10 + n, text(20) + "\n " + edited(rng, src[lo:].upper(), rng.randint(0, 14)) + "  " + text(15)))
    rows.append(rows[5])
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    want = brute([r for r in rows], items)
    for block in (D.ITEM_BLOCK, 60):
        got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(docs(rows), bench, item_block=block).collect()}
        assert got == want
    assert 5 < len(want) < 24
    assert D.leaks(docs([]), bench).count() == 0 and D.leaks(docs(rows), bench.limit(0)).count() == 0


def test_query_finds_every_whole_item(spark):
    docs = [(r.doc_id, norm(r.text)) for r in read(spark, SF, "documents").collect()]
    items = [(r.item_id, norm(r.text)) for r in read(spark, SF, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in D.op3_benchmark_decontamination(spark, SF).collect()}
    whole = {(d, i) for d, t in docs for i, x in items if x in t}
    assert whole and whole <= {k for k, v in got.items() if v == 0}
    for (d, i), v in got.items():
        x = dict(items)[i]
        assert min(edit_within(x[s:s + D.WINDOW], dict(docs)[d]) for s in D.windows_of(len(x), D.WINDOW)) == v


def test_lemma_bound():
    for m in range(D.MIN_ITEM, 200):
        e, t = D.budget(m, D.Q, D.EDITS)
        assert t >= 1 and (e == 0 or t == m + 1 - D.Q * (e + 1))
    a = np.frombuffer("kitten".encode("utf-16-le"), "<u2")
    b = np.frombuffer("xxsittingxx".encode("utf-16-le"), "<u2")
    assert D.banded(a, b, 3)[0] == 2


def test_passages_at_every_offset_and_short_items(spark, docs):
    """Unchanged and edited passages from any place of an item, also cut by the text's ends, against brute force over every offset."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("aeiourstln ") for _ in range(n))
    item = norm(text(300))
    items = [(1, item), (2, "Xy  z"), (3, "q"), (4, "xy z"), (5, "short one, of 23 charac"), (6, " ")]
    rows = [(s, norm(text(40)) + item[s:s + rng.choice([100, 104, 120])] + norm(text(40))) for s in range(0, 200, 13)]
    rows += [(300 + s, norm(text(50)) + edited(rng, item[s:s + 110], 6) + norm(text(50))) for s in range(3, 180, 29)]
    rows += [(600, item[44:140] + text(60)), (601, text(60) + item[44:140]), (602, text(30) + "XY\n z"), (603, "a q"),
             (604, "a short one, of 23 character"), (605, "a short one, of 24 character"), (606, "x"), (607, "y" + item[12:103])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = {}
    for d, t in rows:
        n = norm(t)
        best = min(edit_within(item[s:s + 100], n) for s in range(0, len(item) - 99, 1)) if len(n) > 80 else 99
        want |= {(d, 1): best} if best <= 10 else {}
        want |= {(d, i): 0 for i, x in items[1:5] if norm(x) in n}
    for block in (D.ITEM_BLOCK, 3):
        got = {(r.doc_id, r.item_id): r for r in D.leaks(docs(rows), bench, item_block=block).collect()}
        assert {k: r.distance for k, r in got.items()} == want
    assert all(want[s, 1] == 0 for s in range(0, 200, 13)) and {(600, 1), (601, 1), (602, 2), (602, 4), (603, 3), (604, 5)} <= set(want)
    x = dict(rows)
    for (d, i), r in got.items():
        part = norm(dict(items)[i])[r.window_start:r.window_start + 100]
        assert edit_within(part, norm(x[d])[max(0, r.found_at - 110):r.found_at]) == r.distance
    kept = {r.doc_id for r in D.cleaned(docs(rows), bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}

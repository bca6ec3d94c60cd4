"""The whole pipeline against brute force, stage by stage."""

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from brute import SF, line_dedup, quality
from test_decontaminate import norm
from test_minhash import brute as near
from transitlens.llm import bpe
from transitlens.llm import decontaminate as D
from transitlens.llm.storage import read


def distance(p, t):
    """Least edits of p against any part of t, a row of the table at a time."""
    t = np.frombuffer(t.encode("utf-16-le"), "<u2").astype(int)
    row, at = np.zeros(len(t) + 1, int), np.arange(len(t) + 1)
    for i, c in enumerate(np.frombuffer(p.encode("utf-16-le"), "<u2").astype(int), 1):
        new = np.concatenate(([i], np.minimum(row[:-1] + (t != c), row[1:] + 1)))
        row = np.minimum.accumulate(new - at) + at
    return row.min()


PART = 5


def close_windows(text, places, x, m, e):
    """(window start, text start, text end) that may hold a window of x with at most e edits.

    A window has m // PART disjoint parts, and an edit spoils one of them at most; the others stand in the text, on
    diagonals at most e apart. So some band of 2 * e + 1 diagonals, half overlapping, has m // PART - e of them.
    """
    need, step = m // PART - e, e + 1
    if need < 1:
        return [(s, 0, len(text)) for s in D.windows_of(len(x), D.WINDOW)]
    hits = np.zeros(((len(text) + len(x)) // step + 2, len(x) + PART), bool)
    for p in range(len(x) - PART + 1):
        band = (places.get(x[p:p + PART], np.empty(0, int)) - p + len(x)) // step
        hits[band, p] = hits[band + 1, p] = True           # band b has the diagonals of b - 1 and b
    n = m // PART
    total = sum(hits[:, PART * i:hits.shape[1] - PART * (n - 1 - i)].astype(np.int16) for i in range(n))
    b, s = np.nonzero(total[:, :len(x) - m + 1] >= need)
    low = (b - 1) * step - len(x) + s - e
    return list(zip(s.tolist(), np.maximum(0, low).tolist(), (low + 2 * step + 2 * e + m).tolist()))


def leaked(text, items):
    """Some window of an item is within its edits of a part of the text."""
    text = norm(text)
    at = {}
    for i in range(len(text) - PART + 1):
        at.setdefault(text[i:i + PART], []).append(i)
    places = {k: np.array(v) for k, v in at.items()}
    for x in items:
        m = min(len(x), D.WINDOW)
        e = D.budget(m, D.Q, D.EDITS)[0]
        if any(distance(x[s:s + m], text[a:b]) <= e for s, a, b in close_windows(text, places, x, m, e)):
            return True
    return False


def test_the_bound_of_the_brute_force_loses_nothing():
    """On short texts the table over everything gives the same answer."""
    import random
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    seen = set()
    for _ in range(60):
        x = norm(word(130))
        part = list(x[rng.randrange(20):][:rng.choice([95, 100, 110])])
        for _ in range(rng.randint(0, 14)):
            part[rng.randrange(len(part))] = rng.choice(["", "x", "yz"])
        text = norm(word(40) + "".join(part) + word(40))
        e = D.budget(100, D.Q, D.EDITS)[0]
        want = any(distance(x[s:s + 100], text) <= e for s in range(len(x) - 99))
        assert leaked(text, [x]) == want
        seen.add(want)
    assert seen == {True, False}


def test_every_stage_equals_brute_force(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}

    def step(i, df):
        out = C.STAGES[i][1](spark, df, SF)
        assert out.columns == columns
        return out, {r.doc_id: r.text for r in out.collect()}

    df, got = step(0, docs)
    assert set(got) <= {i for i, t in rows.items() if not quality(t)[5]} and all(got[i] == rows[i] for i in got)
    rows = got
    df, got = step(1, df)
    rows = {i: t for i, _, _, t in line_dedup(list(rows.items()))}
    assert got == rows and {r.doc_id: r.n_chars for r in df.collect()} == {i: len(t) for i, t in rows.items()}
    df, got = step(2, df)
    groups = near(list(rows.items()), 5, 80)
    assert got == {i: t for i, t in rows.items() if groups[i, t][1] == i} and len(got) < len(rows)
    rows = got
    df, got = step(3, df)
    items = [norm(r.text) for r in read(spark, SF, "benchmark").collect()]
    assert got == {i: t for i, t in rows.items() if not leaked(t, items)} and len(got) < len(rows)
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(C.RANKS), special_tokens={})
    want = {i: (e.encode_ordinary(t), t) for i, t in got.items()}
    assert {r.doc_id: (list(r.ids), r.text) for r in C.run(spark, SF).collect()} == want


def test_odd_documents(spark):
    """Nulls, empty texts, equal rows, shared ids and an empty table go through every stage."""
    text = "this is a clean text that has more than ten words in it, as it should have to stay here"
    rows = [(None, None, None, None, None), (1, text, "en", "s", 3), (1, text, "en", "s", 3), (1, "another " + text, "en", "t", 3),
            (None, "a null id with " + text + " and some more words at its end", None, None, None), (4, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame, n in ((df, None), (df.limit(0), 0)):
        for _, stage in C.STAGES:
            frame = stage(spark, frame, SF)
        out = frame.collect()
        assert len(out) == n if n is not None else len(out) >= 2 and {r.doc_id for r in out} == {None, 1}


def test_texts_without_ids_stay_apart(spark):
    """Texts with one 32-bit hash, and many rows without an id: none takes another's place."""
    from test_fingerprint import COLLIDING
    rows = [(None, t, "en", "s", len(t)) for pair in COLLIDING for t in pair]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in C.STAGES[1:3]:
        df = stage(spark, df, SF)
    assert sorted(r.text for r in df.collect()) == sorted(r[1] for r in rows)

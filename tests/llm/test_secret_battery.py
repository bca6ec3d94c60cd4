"""The battery and its error control against plain Python and planted tokens."""
import argparse  # noqa: F401  (its names and others' are the identifiers below)
import asyncio  # noqa: F401
import logging.handlers  # noqa: F401
import math
import os
import random
import re
import string
import sys
from collections import Counter

import pytest
from pydoc_data.topics import topics

from transitlens.llm import secrets as S
from transitlens.llm.storage import identified

LOW, UP, DIG = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALPHABETS = {"lower": LOW, "upper": UP, "mixed": UP + LOW, "base32": UP + "234567", "base36": DIG + LOW, "HEX": DIG + "ABCDEF",
             "base62": DIG + UP + LOW, "base64": DIG + UP + LOW + "+/", "url64": DIG + UP + LOW + "-_"}
LENGTHS = (16, 20, 24, 32, 40, 64)


def ordinary_tokens(rng):
    """Identifiers and paths of the standard library, slugs of words."""
    names = sorted({n for m in list(sys.modules.values()) if getattr(m, "__name__", "").split(".")[0] in sys.stdlib_module_names
                    for n in dir(m) if len(n) >= 16 and re.fullmatch("[A-Za-z0-9_]+", n)})
    root = os.path.dirname(os.__file__)
    paths = sorted({os.path.relpath(os.path.join(d, f), root).split(".")[0] for d, _, fs in os.walk(root) if "site-packages" not in d
                    for f in fs if f.endswith(".py")})
    paths = [p for p in paths if re.fullmatch("[A-Za-z0-9_/+-]{16,}", p)]
    words = [w for w in topics["assignment"].lower().split() if w.isalpha() and len(w) > 2]
    slugs = ["-".join(rng.sample(words, 5)) for _ in range(150)]
    return rng.sample(names, 300) + rng.sample(paths, 300) + [s for s in slugs if len(s) >= 16]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    keys = [(e, n, "".join(rng.choice(a) for _ in range(n))) for e, a in ALPHABETS.items() for n in LENGTHS for _ in range(20)]
    rows = list(enumerate(topics.values()))
    told = {}
    for kind, n, token in keys + [("plain", 0, t) for t in ordinary_tokens(rng)]:
        told[len(rows)] = (kind, n, token)
        rows.append((len(rows), f"see {token} there"))
    return told, spark.createDataFrame(rows, "doc_id long, text string")


def test_keys_of_all_encodings_and_lengths_are_found_and_ordinary_tokens_are_not(planted):
    told, docs = planted
    out = {r.doc: r.s for r in S.scan(docs).select("doc", S.listed(S.F.col("spans")).alias("s")).collect()}
    hits, total = Counter(), Counter()
    for doc, (kind, n, token) in told.items():
        for group in {kind, (kind != "plain", n)}:
            total[group] += 1
            hits[group] += f"random:4:{4 + len(token)}" in out[doc]
    for group in total:
        if group not in ("plain", (False, 0)):
            assert hits[group] >= 0.95 * total[group], (group, hits[group], total[group])
    found = sum(hits[e] for e in ALPHABETS)
    assert hits["plain"] <= S.ALPHA * (found + hits["plain"])


def normal_tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def battery(token):
    a = next(letters for p, letters in S.ENCODINGS if re.search(p, token))
    n, k, counts = len(token), len(a), Counter(token)
    at = [a.index(c) for c in token]
    if n < 2 * k:
        pairs, mean = sum(c * (c - 1) // 2 for c in counts.values()), n * (n - 1) / (2 * k)
        p1 = 1 - math.fsum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(pairs))
    else:
        chi = sum((counts[c] - n / k) ** 2 / (n / k) for c in a)
        v = 2 / (9 * (k - 1))
        p1 = normal_tail(((chi / (k - 1)) ** (1 / 3) - (1 - v)) / math.sqrt(v))
    upper = [i >= (k + 1) // 2 for i in at]
    q = sum(i >= (k + 1) // 2 for i in range(k)) / k
    q = 2 * q * (1 - q)
    changes = sum(x != y for x, y in zip(upper, upper[1:]))
    p2 = normal_tail(abs(changes - (n - 1) * q) / math.sqrt((n - 1) * q * (1 - q)))
    mid = (k - 1) / 2
    p3 = normal_tail(abs(sum((x - mid) * (y - mid) for x, y in zip(at, at[1:]))) / ((k * k - 1) / 12) / math.sqrt(n - 1))
    return min(1.0, 3 * min(p1, 2 * p2, 2 * p3))


def plain_model(texts):
    count = Counter()
    for t in texts:
        count.update(w for w in re.split("[^a-z0]+", re.sub("[1-9]", "0", "".join(c.lower() for c in t))) if 1 <= len(w) <= 15)
    symbols = "#0" + LOW
    pair = Counter()
    for w, n in count.items():
        for x, y in zip("#" + w, w + "#"):
            pair[x + y] += n
    chance = {x + y: (pair[x + y] + 0.5) / (sum(pair[x + z] for z in symbols) + 0.5 * 28) for x in symbols for y in symbols}

    def score(word, letters):
        return sum(math.log(chance[x + y]) - math.log({"#": 0.2, "0": 10 / letters}.get(y, 1 / letters)) for x, y in zip(word, word[1:]))
    each = [(n, len(w) + 1, score(f"#{w}#", 26)) for w, n in count.items() if len(w) >= 4]
    length = sum(n * k for n, k, _ in each)
    mean = sum(n * s for n, _, s in each) / length
    return score, mean, sum(n * (s - mean * k) ** 2 for n, k, s in each) / length


def test_p_values_and_cuts_equal_plain_python(planted):
    told, docs = planted
    src = identified(docs)
    tokens = S.matches(src).filter(f"kind = {len(S.BASE)}")
    model = S.ordinary(S.words(src))
    rows = S.with_p_values(tokens, model).collect()
    score, mean, variance = plain_model([r.text for r in src.select("text").collect()])
    assert (model[1], model[2]) == pytest.approx((mean, variance), rel=1e-9)
    classes = {}
    for r in rows:
        bare = r.match.rstrip("=")
        p_random = battery(bare)
        assert r.p_random == pytest.approx(p_random, abs=1e-6), bare
        word = "#" + re.sub("^#|#$", "", re.sub("[^a-z0]+", "#", re.sub("[1-9]", "0", re.sub("(?<=[a-z])(?=[A-Z])", "#", bare).lower()))) + "#"
        letters = 10 if bare.isdigit() else 16 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", bare) else 36 if re.search("[0-9]", bare) else 26
        steps = len(word) - 1
        p = normal_tail(-(score(word, letters) - steps * mean) / math.sqrt(steps * variance)) if p_random > S.LEVEL else 1.0
        assert r.p == pytest.approx(p, abs=1e-6), bare
        assert r.length_class == math.floor(2 * math.log2(len(r.match)))
        classes.setdefault(r.length_class, []).append(r.p)
    got = {r.length_class: r.cut for r in S.not_ordinary(S.with_p_values(tokens, model)).collect()}
    for c, ps in classes.items():
        cells = sorted(min(S.CELLS, math.floor(-100 * math.log10(max(p, 1e-17)))) for p in ps)[::-1]
        least = [cell for i, cell in enumerate(cells, 1) if 10 ** (-cell / 100) <= S.ALPHA * sum(x >= cell for x in cells) / len(cells)]
        assert got.get(c) == (min(least) if least else None)


def test_tables_without_words_and_odd_tokens(docs):
    rows = [(1, "+" * 40), (2, "_" * 16 + "=="), (3, "0" * 5000), (4, "aB" * 2000), (5, None), (6, "é" * 30), (7, "-/" * 30_000)]
    got = S.scan(docs(rows)).select("doc", "spans").collect()
    assert sorted(r.doc for r in got) == [1, 2, 3, 4, 5, 6, 7]
    assert all(len([s for s in r.spans if s["kind"] == len(S.BASE)]) == 0 for r in got if r.doc != 2)
    assert S.scan(docs([(None, "")])).count() == 1

"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def sha(b):
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    cov = set()
    for i, x in enumerate(wins):
        if n[x] > 1:
            cov.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(cov),
            len(w) < 10 or 100 * len(cov) > 20 * len(w))


def line_dedup(rows, min_docs=10, min_chars=1):
    rows = [(i, t or "") for i, t in rows]
    key = lambda x: lower(x.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    where = defaultdict(set)
    for i, t in set(rows):
        for x in t.split("\n"):
            if len(key(x)) >= max(1, min_chars):
                where[key(x)].add((i, t))
    out = []
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def window_dedup(rows, k=20):
    """Rows (id, words): True for every removed word."""
    first = {}
    for i, w in sorted(set((i, tuple(w)) for i, w in rows), key=lambda x: (x[0] is not None, x[0])):
        for p in range(len(w) - k + 1):
            first.setdefault(w[p:p + k], (i, p))
    out = []
    for i, w in rows:
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] != (i, p):
                gone[p:p + k] = [True] * k
        out.append((i, gone))
    return out

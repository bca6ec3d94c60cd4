"""Secret scan with a randomness test battery, in DataFrame operations only (operator 1).

Base rules: assignments of passwords and keys, access key ids, long hex
digests. The method adds tokens that look random. Every run of 16 or more
characters of ``[A-Za-z0-9+/_-]`` (with up to two ``=`` behind it) is tested; no pattern decides beforehand.
Each token's encoding is inferred (the least alphabet that holds it), and three tests ask
whether its symbols are drawn evenly and independently from it:

* chi-squared of the symbol counts against the uniform alphabet; where cells expect under two symbols, its exact
  equivalent, the number of equal pairs, against the Poisson law that it then follows,
* the number of runs of symbols in the alphabet's lower and upper half,
* the lag-one serial correlation of the symbols' ranks.

A token's ``p_random`` is three times the least of the three, at most one. At or under
``LEVEL`` it is not a random draw and is not reported.

The errors that matter are ordinary words, names and paths reported as secrets. So what is controlled is their
share: the null hypothesis is *ordinary text of this table*. Its letters follow a chain of neighbouring symbols that is counted
over the words of all documents (words are shorter than tokens, so tokens do not train it). A token's score is its
log likelihood under that chain against even draws from its alphabet; a joint of two words (a sign, or a capital after a small letter) is a
symbol of its own. ``p`` is the normal tail of the score, with mean and variance a symbol taken from the table's words of
four or more letters, word by word, since a rare word is rare in all its letters; it is one where the battery fails.
The Benjamini-Hochberg rule at level ``ALPHA`` within each length class
(longer tokens reject more easily) then gives the tokens to report: at most a share ALPHA of them is expected to be ordinary.

The rule's threshold comes from a histogram of p-values per class (at most
``CELLS`` cells each), every p rounded up to its cell's edge, which is
conservative; so no class is sorted in one task.

Spans are counted in code points, ends exclusive. Defined cases: null and empty texts have no spans; rows
with the same id and text give the same answer once per row; ids may be null; an empty table
gives an empty result; a table without words has an even chain; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import free, identified, read, real_id, written

#: kind -> (pattern, group whose length counts, least length); the listed order breaks ties of spans.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
LEAST = 16
RANDOM = (r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST, 0, LEAST)
KINDS = [*BASE, "random"]
ALPHA = 0.05            # greatest expected share of ordinary tokens among those reported
LEVEL = 0.01            # share of random tokens that the battery may reject
CELLS = 1600            # of 1/100 in -log10 p

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (pattern of the whole token, alphabet in order of value)
ENCODINGS = [
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("", _UPPER + _LOWER + _DIGITS + "+/-_"),
]
#: Symbols of the chain: a joint of words, any digit, the letters. JOINT: a joint's chance in an even draw.
CHAIN = "#0" + _LOWER
JOINT = 0.2


def matches(docs: DataFrame) -> DataFrame:
    """(doc, tk, kind, start, end, match) of every match of every kind, from (doc, tk, text).

    Spark gives matches but not their places: a text split at a pattern and its matches alternate, so places are
    running sums of their lengths. Only texts with a match are split, and only the pieces' lengths are moved.
    """
    found = []
    for k, kind in enumerate(KINDS):
        pattern, group, least = BASE.get(kind, RANDOM)
        p = F.lit(pattern)
        gap = F.transform(F.split("text", pattern, -1), lambda s: F.length(s))
        pair = F.zip_with(F.regexp_extract_all("text", p, F.lit(0)), F.regexp_extract_all("text", p, F.lit(group)),
                          lambda m, g: F.struct(m.alias("match"), (F.length(g) >= least).alias("ok")))
        rows = F.transform(F.zip_with(gap, pair, lambda n, m: F.struct(n.alias("gap"), m.alias("m"))), lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["m"]["match"].alias("match"), x["m"]["ok"].alias("ok")))
        found.append(F.when(F.col("text").rlike(pattern), F.filter(rows, lambda x: x["match"].isNotNull())))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,match:string,ok:boolean>>")
    each = (docs.select("doc", "tk", F.concat(*[F.coalesce(f, empty) for f in found]).alias("all"))
            .filter(F.size("all") > 0).select("doc", "tk", F.inline("all")))
    text = W.partitionBy("doc", "tk", "kind").orderBy("i")
    # a row that repeats another (same id, same text) repeats its matches
    once = each.withColumn("again", F.coalesce(F.lag("i").over(text) == F.col("i"), F.lit(False)))
    step = F.when(F.col("again"), 0).otherwise(F.col("gap") + F.length("match"))
    return (once.withColumn("end", F.sum(step).over(text.rowsBetween(W.unboundedPreceding, 0)))
            .filter("NOT again AND ok")
            .select("doc", "tk", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match"))


def _tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Zelen and Severo's polynomial)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, q).otherwise(1 - q)


def _poisson_tail(count: Column, mean: Column) -> Column:
    """P(X >= count) for a mean of at most some hundreds, term by term; 0 far outside."""
    none = F.struct(F.exp(-mean).alias("term"), F.lit(0.0).alias("sum"))
    add = lambda a, i: F.struct((a["term"] * mean / (i + 1)).alias("term"), (a["sum"] + a["term"]).alias("sum"))
    below = F.aggregate(F.sequence(F.lit(0), F.greatest(count.cast("int") - 1, F.lit(0))), none, add, lambda a: a["sum"])
    return (F.when(count < 1, F.lit(1.0)).when(count > mean + 40 * F.sqrt(mean + 1), F.lit(0.0))
            .otherwise(F.greatest(1 - below, F.lit(0.0))))


def _battery(tokens: DataFrame) -> DataFrame:
    """Adds ``p_random``, ``bare`` and ``length_class`` (factors of the square root of two) to rows with ``match``.

    One battery serves all encodings: the token's alphabet is a column.
    """
    alphabet = None
    for pattern, letters in ENCODINGS:
        test = F.col("bare").rlike(pattern)
        alphabet = F.when(test, letters) if alphabet is None else alphabet.when(test, letters)
    rows = tokens.withColumn("bare", F.regexp_replace("match", "=+$", "")).withColumn("alphabet", alphabet)
    rows = rows.withColumns({"n": F.length("bare").cast("double"), "k": F.length("alphabet").cast("double"),
                             "symbols": F.split("bare", ""),
                             "half": F.expr("translate(bare, alphabet, concat(repeat('0', (length(alphabet) + 1) div 2), repeat('1', length(alphabet) div 2)))")})
    n, k = F.col("n"), F.col("k")
    # counts of the symbols, squared and summed; changes between the halves; products of neighbouring ranks
    same = F.aggregate(F.array_distinct("symbols"), F.lit(0.0),
                       lambda a, c: a + F.pow(n - F.length(F.replace("bare", c, F.lit(""))), F.lit(2.0)))
    pairs = lambda s: (F.length("half") - F.length(F.replace("half", F.lit(s), F.lit("")))) / 2
    rows = rows.withColumns({"same": same, "changes": pairs("01") + pairs("10"),
                             "ranks": F.transform("symbols", lambda c: F.instr("alphabet", c) - 1 - (k - 1) / 2)})
    half = F.floor((k + 1) / 2)
    rows = rows.withColumns({"df": k - 1, "chi": F.greatest(k / n * F.col("same") - n, F.lit(0.0)), "share": 2 * half * (k - half) / (k * k),
                             "product": F.aggregate(_neighbours("ranks", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)})
    df, share = F.col("df"), F.col("share")
    # chi-squared in Wilson and Hilferty's normal form; a binomial of n - 1 trials; the correlation's normal form
    rows = rows.withColumns({
        "z1": (F.pow(F.col("chi") / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)),
        "z2": F.abs((F.col("changes") - (n - 1) * share) / F.sqrt((n - 1) * share * (1 - share))),
        "z3": F.abs(F.col("product") / ((k * k - 1) / 12) / F.sqrt(n - 1))})
    rows = rows.withColumns({f"p{i}": _tail(F.col(f"z{i}")) for i in (1, 2, 3)})
    few = _poisson_tail((F.col("same") - n) / 2, n * (n - 1) / (2 * k))
    even = F.when(n < 2 * k, few).otherwise(F.col("p1"))
    p = F.least(F.lit(1.0), 3 * F.least(even, 2 * F.col("p2"), 2 * F.col("p3")))
    return rows.select(*tokens.columns, "bare", p.alias("p_random"),
                       F.floor(2 * F.log2(F.length("match").cast("double"))).cast("int").alias("length_class"))


def _neighbours(name: str, f) -> Column:
    """f of each two neighbours of an array column."""
    size = F.greatest(F.size(name) - 1, F.lit(0))
    return F.zip_with(F.slice(name, F.lit(1), size), F.slice(name, F.lit(2), size), f)


def _chained(text: Column) -> Column:
    """A token or word in the symbols of the chain, a joint at either end."""
    parts = F.regexp_replace(text, "(?<=[a-z])(?=[A-Z])", "#")
    plain = F.regexp_replace(F.translate(F.lower(parts), "123456789", "0" * 9), "[^a-z0]+", "#")
    return F.concat(F.lit("#"), F.regexp_replace(plain, "^#|#$", ""), F.lit("#"))


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts in the symbols of the chain. A word is a run of letters and digits shorter than a token."""
    each = docs.select(F.explode(F.split(F.translate(F.lower("text"), "123456789", "0" * 9), "[^a-z0]+")).alias("w"))
    return (each.filter(F.length("w").between(1, LEAST - 1)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
            .select(F.concat(F.lit("#"), "w", F.lit("#")).alias("word"), "n"))


def _score(word: str, chain: list[float], letters: Column) -> Column:
    """(steps, score): the log likelihood of a column of chain symbols against even draws of ``letters`` symbols."""
    table = F.split(F.lit(",".join(map(repr, chain))), ",").cast("array<double>")
    even = F.log(letters)
    step = lambda a, b: F.get(table, (a * len(CHAIN) + b).cast("int")) + (
        F.when(b == 0, -log(JOINT)).when(b == 1, even - log(10)).otherwise(even))
    at = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(CHAIN), c) - 1)
    return F.aggregate(F.zip_with(F.slice(at, F.lit(1), F.length(word) - 1), F.slice(at, F.lit(2), F.length(word) - 1), step),
                       F.lit(0.0), lambda a, b: a + b)


def ordinary(counted: DataFrame) -> tuple[list[float], float, float]:
    """(log chances of the chain, mean, variance) of a step, from (word, n).

    What comes to the driver is one row for each two symbols of the chain, then one row.
    """
    at = F.transform(F.split("word", ""), lambda c: F.instr(F.lit(CHAIN), c) - 1)
    each = counted.select(at.alias("at"), "n").select(F.explode(_neighbours("at", lambda a, b: a * len(CHAIN) + b)).alias("step"), "n")
    size = len(CHAIN)
    count = [0.5] * (size * size)
    for r in each.groupBy("step").agg(F.sum("n").alias("n")).collect():
        count[r.step] += r.n
    total = [sum(count[a * size:(a + 1) * size]) for a in range(size)]
    chain = [log(c / total[i // size]) for i, c in enumerate(count)]
    long = (counted.filter(F.length("word") >= 6)        # four symbols and two joints
            .select("n", (F.length("word") - 1).cast("double").alias("steps"), _score("word", chain, F.lit(26.0)).alias("score")))
    sums = long.agg(*[F.sum(F.col("n") * F.col(a) * F.col(b)).alias(a + b) for a, b in
                      (("score", "score"), ("score", "steps"), ("steps", "steps"))],
                    F.sum(F.col("n") * F.col("score")).alias("s"), F.sum(F.col("n") * F.col("steps")).alias("l")).first()
    if not sums.l:
        return chain, 0.0, 1.0
    mean = sums.s / sums.l
    around = sums.scorescore - 2 * mean * sums.scoresteps + mean * mean * sums.stepssteps
    return chain, mean, max(around / sums.l, 1e-6)


def with_p_values(tokens: DataFrame, model: tuple[list[float], float, float]) -> DataFrame:
    """Adds ``p_random``, ``p`` and ``length_class`` to rows with ``match``; ``model`` is that of ``ordinary``."""
    chain, mean, variance = model
    letters = (F.when(F.col("bare").rlike("^[0-9]+$"), 10.0).when(F.col("bare").rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16.0)
               .when(F.col("bare").rlike("[0-9]"), 36.0).otherwise(26.0))
    rows = _battery(tokens).withColumn("word", _chained(F.col("bare")))
    steps = (F.length("word") - 1).cast("double")
    z = (_score("word", chain, letters) - steps * mean) / F.sqrt(steps * variance)
    return rows.select(*tokens.columns, "p_random", F.when(F.col("p_random") > LEVEL, _tail(-z)).otherwise(F.lit(1.0)).alias("p"), "length_class")


def not_ordinary(tokens: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(length_class, cut): p-values up to the cut are no ordinary text, by Benjamini-Hochberg within each class."""
    counts = tokens.groupBy("length_class", _cell().alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    by = W.partitionBy("length_class")                   # at most CELLS rows each
    edge = F.pow(F.lit(10.0), -F.col("cell") / 100)      # the greatest p of the cell
    return (counts.withColumn("below", F.sum("n").over(by.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, 0)))
            .withColumn("m", F.sum("n").over(by)).filter(edge <= alpha * F.col("below") / F.col("m"))
            .groupBy("length_class").agg(F.min("cell").alias("cut")))


def _cell() -> Column:
    return F.least(F.lit(CELLS), F.floor(-100 * F.log10(F.greatest("p", F.lit(1e-17))))).cast("int")


def scan(docs: DataFrame, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, spans): for every row the array of spans (start, kind, end), by start and kind; ``kind`` counts in KINDS."""
    src = identified(docs, id_col, text_col)
    found = written(matches(src), "matches")
    base, tokens = found.filter(F.col("kind") < len(BASE)), found.filter(F.col("kind") == len(BASE))
    counted = written(words(src), "words")
    model = ordinary(counted)
    free(counted)
    tokens = written(with_p_values(tokens, model), "tokens")
    cut = F.broadcast(not_ordinary(tokens, alpha))       # one row per length class, of which there are under 64
    random = tokens.join(cut, "length_class").filter(_cell() >= F.col("cut"))
    span = F.struct("start", "kind", "end")
    spans = (base.select("doc", "tk", "start", "kind", "end").unionByName(random.select("doc", "tk", "start", "kind", "end"))
             .groupBy("doc", "tk").agg(F.sort_array(F.collect_list(span)).alias("spans")))
    inside = lambda s: F.exists("spans", lambda b: (b["kind"] < len(BASE)) & (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    spans = spans.withColumn("spans", F.filter("spans", lambda s: (s["kind"] < len(BASE)) | ~inside(s)))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return (src.select("doc", "tk").join(spans, ["doc", "tk"], "left")
            .select("doc", F.coalesce(F.col("spans").cast("array<struct<start:bigint,kind:int,end:bigint>>"), none).alias("spans")))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return out.select(real_id(), *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                      F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

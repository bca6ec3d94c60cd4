import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import SF, WORD, sha, window_dedup
from transitlens.llm import sketch as S
from transitlens.llm import text as X
from transitlens.llm import window_dedup as W
from transitlens.llm.storage import read


def expected(rows, k):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    return [(i, len(w), sum(g), " ".join(x for x, d in zip(w, g) if not d))
            for (i, w), (_, g) in zip(words, window_dedup(words, k))]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in W.op9_substring_dedup(spark, SF).collect())
    assert got == sorted((i, n, g, sha(t)) for i, n, g, t in expected(rows, 20))
    assert sum(g for _, _, g, _ in got) > 0


@pytest.mark.parametrize("k,gram,bits,seed", [(4, 2, 16, 1), (3, 8, 16, 2), (6, 3, 18, 3)])
def test_random_rows(spark, docs, k, gram, bits, seed):
    """Few words: periodic texts, overlaps within a document, a sketch that is nearly full."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, "a " * 500), (101, None), (102, ""), (103, "a " * 30), rows[5], (None, "b a b a b a a a a a")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = [tuple(r) for r in W.deduped(docs(rows), k, gram, bits).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(got, key=key) == sorted(expected(rows, k), key=key)


def test_empty_and_long(spark, docs):
    assert W.deduped(docs([])).count() == 0
    rng = random.Random(5)
    long = " ".join(str(rng.random()) for _ in range(60_000))
    rows = [(1, long), (2, "x " * 19), (3, long[:5000] + " " + long[-7000:])]
    assert sorted(tuple(r) for r in W.deduped(docs(rows)).collect()) == sorted(expected(rows, 20))


@pytest.mark.parametrize("n,other,k", [(20_000, 10_000, 37), (50_000, 20_000, 11), (20_000, 1_000, 1)])
def test_runs_over_several_ranges_under_a_union(spark, n, other, k):
    """Runs that cross ranges keep one first place in all, whatever else shares the plan's partitions."""
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    old = {c: spark.conf.get(c) for c in conf}
    place = [F.col("id").alias("doc"), F.lit(1).cast("long").alias("tk"), F.lit(0).alias("pos")]
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        places = spark.range(n, numPartitions=6).select((F.col("id") % k).alias("h1"), F.lit(5).cast("long").alias("h2"), *place)
        more = (spark.range(n, n + other, numPartitions=8).withColumn("k", F.col("id") % 977)
                .repartition("k").sortWithinPartitions("k").select(*place))
        for rows, want in ((S.later_places(places), range(k, n)), (more.unionByName(S.later_places(places)), range(k, n + other))):
            assert {r.doc for r in rows.collect()} == set(want)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    h = X.mix64(rng.integers(0, 5000, 20_000).astype(np.uint64))
    flat = np.zeros((S.DEPTH, (1 << 16) // 8), np.uint8)
    for part in S._merged(iter(sorted_batches([S._sent(h[:9000], 16), S._sent(h[9000:], 16)]))):
        for s, bm in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            flat[s >> 40] = np.frombuffer(S.zlib.decompress(bm), np.uint8)
    values, n = np.unique(h, return_counts=True)
    assert S.estimated_repeated(flat, values[n > 1], 16).all()


def sorted_batches(batches):
    import pyarrow as pa
    return [b for b in pa.Table.from_batches(batches).sort_by("segment").to_batches()]

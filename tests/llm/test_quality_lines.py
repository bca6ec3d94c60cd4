import random

import pytest

from brute import SF, line_dedup, quality, sha
from transitlens.llm import line_dedup as LD
from transitlens.llm import quality as Q
from transitlens.llm import text as X

ODD = [(1, None), (2, ""), (3, "   \n\t\n"), (None, "A b\nA b\nA b"), (5, "a b c d e " * 12), (6, "é # $ <x> ñ\x0bü\x85z"),
       (7, "\n\n\n"), (5, "a b c d e " * 12), (8, "w" * 200_000 + " x\n" + "q " * 5000), (9, "one two three four five six seven eight nine ten")]


def test_measures_equal_brute_force(spark, docs):
    got = {(r.key, r.n_words, r.word_chars): r for r in Q.judged(docs(ODD)).collect()}
    assert Q.judged(docs(ODD)).count() == len(ODD)
    for i, t in ODD:
        want = quality(t)
        r = got[(i, want[0], want[1])]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want


def test_query_equals_brute_force(spark):
    from transitlens.llm.storage import read
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    got = Q.op5_quality_rules(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == quality(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_ablations_count_from_bits(spark, docs):
    led = Q.ledger(docs([(1, "a b"), (2, "a b c d e " * 30), (3, "## ** $$ %% && || << >> ## **"), (4, None)]))
    rows = {(r.policy, r.rule): r for r in Q.ablations(led).collect()}
    assert rows["v1", "few_words"].n_failed == 2 and rows["v1", "few_words"].n_only == 2
    assert rows["v1", "repeated_words"].n_only == 1 and rows["v1", "few_words"].n_rejected == 3
    assert rows["v2", "symbols"].n_failed == 1 and rows["v2", "symbols"].n_rejected == 4


def test_rows_that_stay_keep_their_columns(spark, docs):
    rows = ODD + [(50, "a clean text of more than ten words stands here and stays as it is\n\nx")]
    df = docs(rows)
    kept = Q.accepted(df)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, t in rows if not quality(t)[5]} - {8}
    lines = LD.cleaned(df)
    assert lines.columns == df.columns and lines.count() == len(rows)


def test_empty_tables(spark, docs):
    assert Q.judged(docs([])).count() == 0 and LD.deduped(docs([])).count() == 0


def test_line_dedup_odd_rows(spark, docs):
    rows = ODD + [(100 + i, f"Common Line \nown {i}\n  common line\n\nx") for i in range(12)] + [(100, "Common Line \nown 0\n  common line\n\nx")]
    got = sorted((r.doc_id is not None, r.doc_id, r.n_lines, r.n_dropped, r.text) for r in LD.deduped(docs(rows)).collect())
    assert got == sorted((i is not None, i, a, b, t) for i, a, b, t in line_dedup(rows))


@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 4), (10, 1)])
def test_line_dedup_random(spark, docs, min_docs, min_chars):
    rng = random.Random(min_docs)
    rows = [(i % 37, "\n".join(rng.choice(["aa", " AA", "b", "ccccc", "", "d" * rng.randint(1, 3), str(rng.random())])
                               for _ in range(rng.randint(0, 9)))) for i in range(90)]
    got = sorted(tuple(r) for r in LD.deduped(docs(rows), min_docs, min_chars).collect())
    assert got == sorted(line_dedup(rows, min_docs, min_chars))


def test_line_query_equals_brute_force(spark):
    from transitlens.llm.storage import read
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in LD.op10_line_dedup(spark, SF).collect())
    assert got == sorted((i, a, b, sha(t)) for i, a, b, t in line_dedup(rows))


def test_runs_over_batches(spark, docs):
    """A key's run that goes over Arrow batches and ranges is counted whole."""
    from transitlens.llm.storage import identified
    rows = [(i, "same\nsame\nother") for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        runs = {r.n_docs for r in LD.key_runs(LD.line_keys(identified(docs(rows)))).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert runs == {300}


def test_long_texts_get_blocks_of_their_own():
    import pyarrow as pa
    sizes = [b.n for b in X.blocks(pa.array(["a" * 10, None, "b" * 100, "c"]), 20)]
    assert sum(sizes) == 4 and len(sizes) >= 3

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from brute import SF, sha
from transitlens.llm import bpe as B
from transitlens.llm.storage import read

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.vocabulary(PATH), special_tokens={})


def test_query_equals_the_library(spark, tokenizer):
    got = {r.doc_id: r for r in B.op6_byte_bpe(spark, SF).collect()}
    rows = read(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = tokenizer.encode_ordinary(r.text)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(r.text))


def test_odd_texts(spark, docs, tokenizer):
    rng = random.Random(1)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(3000))
    texts = [None, "", " ", "\n\n  x", "a" * 20_000, letters, "日本語の長い文章" * 40, "\x1c\x85\xa0　 ᠎​", "don't WE'LL 12345 --==",
             "😀👩‍👩‍👧 é é", "<|endoftext|>", "".join(map(chr, range(1, 3000)))]
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts)] + [(1, "")]
    got = B.decoded(B.encoded(docs(rows), PATH, P.PATTERN), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        want = texts[4 if r.doc_id is None else r.doc_id] or ""
        assert list(r.ids) == tokenizer.encode_ordinary(want)
        assert bytes(r.bytes) == want.encode()
    assert sorted(map(repr, B.round_trip(docs(rows), PATH, P.PATTERN).collect())) == sorted(map(repr, got))
    assert B.encoded(docs([]), PATH, P.PATTERN).count() == 0


def test_pieces_cut_between_words(tokenizer):
    rng = random.Random(2)
    text = "".join(rng.choice(["a", " ", "  ", "bc", "\n", " 1", "."]) for _ in range(2000))
    parts = list(B.pieces(text, 50))
    assert "".join(parts) == text and len(parts) > 10
    assert [i for p in parts for i in tokenizer.encode_ordinary(p)] == tokenizer.encode_ordinary(text)
    assert list(B.pieces("x" * 200, 50)) == ["x" * 200]


def test_unicode_classes_of_the_pattern(tokenizer):
    import regex
    find = regex.compile(P.PATTERN).findall
    for lo in range(1, 0x3100, 0x100):
        text = "".join(f"a{chr(c)}a {chr(c)} " for c in range(lo, lo + 0x100))
        split = [w for w in find(text)]
        assert [i for w in split for i in tokenizer.encode_ordinary(w)] == tokenizer.encode_ordinary(text)


def contracted(word, ranks):
    """Plain Python: the leftmost pair of minimum rank, until there is none."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_every_recursion_contracts_in_the_order_of_ranks(seed):
    """Vocabularies in any order, so that a token may rank before its own parts."""
    rng = random.Random(seed)
    own = {bytes([b]) for b in range(256)}
    tokens = {bytes(rng.choice(b"abcd"[:2 + seed % 3]) for _ in range(rng.randint(2, 6))) for _ in range(120)}
    more = rng.sample(sorted(tokens), len(tokens))
    ranks = {t: i for i, t in enumerate(sorted(own) + more)}
    enc = B.Encoder(B.pair_table(ranks), np.array([ranks[bytes([b])] for b in range(256)], np.int32), P.PATTERN, f"random {seed}")
    words = [bytes(rng.choice(b"abcd"[:2 + seed % 3]) for _ in range(rng.randint(1, 90))) for _ in range(300)] + [b"a" * 77, b"z", b"zz"]
    want = [contracted(w, ranks) for w in words]
    for sql in (B.ENCODE, B.ENCODE_SURE, B.ENCODE_KEYED):
        n, ids = enc._run(words, sql)
        assert n.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
    enc.close()


def test_texts_without_spaces(spark, docs, tokenizer):
    """Words on both sides of every limit of size, of three scripts."""
    rng = random.Random(3)
    alphabets = ["etaoinshrdlu", "日本語の文章は空白なしで書かれる的一是不了人", "กขคงจชดตทนบปพมยรลวสหอะา"]
    texts = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (6, 7, 8, 20, 21, 40, 85, 86, 256, 257, 1000) * 10]
    got = {r.doc_id: r for r in B.round_trip(docs(list(enumerate(texts))), PATH, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        assert list(got[i].ids) == tokenizer.encode_ordinary(t)
        assert bytes(got[i].bytes) == t.encode()


def test_steps_of_words_without_spaces(tokenizer):
    """Sentences of 100 ideographs lose most of their tokens, in a few steps."""
    rng = random.Random(4)
    ranks = B.vocabulary(PATH)
    enc = B.Encoder(B.pair_table(ranks), np.array([ranks[bytes([b])] for b in range(256)], np.int32), P.PATTERN, PATH)
    words = ["".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(80)).encode() for _ in range(50)]
    steps = B.ENCODE_SURE[:B.ENCODE_SURE.rindex("SELECT w, tok FROM t JOIN")] + "SELECT max(step) AS w, max(step) AS tok FROM t"
    assert enc._run(words, steps)[1][0] <= 12
    enc.close()


def test_words_in_use_are_not_encoded_again(tokenizer, monkeypatch):
    """Many rare words go by; the common ones, none of them among the first, are encoded once."""
    monkeypatch.setattr(B, "KNOWN_WORDS", 30)
    ranks = B.vocabulary(PATH)
    enc = B.Encoder(B.pair_table(ranks), np.array([ranks[bytes([b])] for b in range(256)], np.int32), P.PATTERN, "common words")
    encoded, real = [], enc._run
    monkeypatch.setattr(enc, "_run", lambda words, sql: encoded.extend(words) or real(words, sql))
    common = [f" gewöhnlich{chr(97 + i)}" for i in range(20)]
    for i in range(12):
        words = [f" selten{chr(97 + i)}{chr(97 + k)}" for k in range(26)] + (common * 2 if i else [])
        n, ids = enc.ids(words)
        want = [tokenizer.encode_ordinary(w) for w in words]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(enc.words.index) < 120
    assert [encoded.count(w.encode()) for w in common] == [1] * len(common)
    enc.close()


def test_words_of_a_failed_recursion_are_not_known(tokenizer, monkeypatch):
    ranks = B.vocabulary(PATH)
    enc = B.Encoder(B.pair_table(ranks), np.array([ranks[bytes([b])] for b in range(256)], np.int32), P.PATTERN, "failed")
    with monkeypatch.context() as m:
        m.setattr(enc, "_run", lambda *a: (_ for _ in ()).throw(MemoryError()))
        with pytest.raises(MemoryError):
            enc.ids(["word"])
    assert enc.ids(["word", "word"])[1].tolist() == tokenizer.encode_ordinary("word") * 2
    enc.close()


def test_splitting_is_the_patterns():
    import regex
    find, split = regex.compile(P.PATTERN).findall, B.splitter(P.PATTERN)
    for lo in range(0, 0x3100, 0x80):
        text = "".join(f"a{chr(c)}a {chr(c)} \n{chr(c)}{chr(c)}1" for c in range(lo, lo + 0x80))
        assert split(text) == find(text)


def test_ids_that_are_no_tokens_decode_to_nothing(spark):
    rows = [(1, [0, None, -1, -2, 10**6, 2**31 - 1, -2**31, 1]), (2, []), (3, None), (4, [-5])]
    got = {r.doc_id: bytes(r.bytes) for r in B.decoded(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), PATH).collect()}
    tokens = {k: t for t, k in B.vocabulary(PATH).items()}
    assert got == {1: tokens[0] + tokens[1], 2: b"", 3: b"", 4: b""}

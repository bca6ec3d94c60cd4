"""Cross-tokenizer alignment against plain loops over every document."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brute import SF
from transitlens.llm import token_align as T

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


CHARS = T.byte_chars()


@lru_cache(None)
def bytes_a(a, i):
    return bytes(CHARS[c] for c in a.id_to_token(i))


@lru_cache(None)
def bytes_b(b, i):
    p = b.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()


def brute(rows, libraries):
    a, b = libraries
    links, docs = Counter(), []
    for i, text in rows:
        x, y = [], []
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            want = (" " + text).encode()
            if b"".join(bytes_a(a, t) for t in x) != want or b"".join(bytes_b(b, t) for t in y) != want:
                x, y = [], []
        groups, own, p, q, at_a, at_b = [], [], 0, 0, 0, 0
        ga, gb = [], []
        while p < len(x) or q < len(y):
            if q == len(y) or (p < len(x) and at_a <= at_b):
                at_a += len(bytes_a(a, x[p]))
                ga.append(x[p])
                p += 1
            else:
                at_b += len(bytes_b(b, y[q]))
                gb.append(y[q])
                q += 1
            if at_a == at_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                own.append((ga[-1], gb[-1]))
                ga, gb = [], []
        links.update(own)
        docs.append((i, len(x), len(y), groups, own))
    most = defaultdict(int)
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return sorted(((i, n_a, n_b, len(groups), len(own), sum(links[z] == most[z[1]] for z in own), sum(links[z] for z in own),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for i, n_a, n_b, groups, own in docs), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_byte_characters_are_those_of_the_library():
    from tokenizers.pre_tokenizers import ByteLevel
    assert set(T.byte_chars()) == set(ByteLevel.alphabet())
    assert "".join(T.byte_chars()[c].to_bytes().decode("latin-1") for c in "ĠA") == " A"


ROWS = [(1, "Hello world, hello tokens"), (2, "Hello world, hello tokens"), (3, None), (4, ""), (5, " "), (6, "  two  spaces "), (7, "über 東京 😀"),
        (8, "▁ block"), (9, "<|endoftext|> and <s> </s> <unk> <0x41>"), (None, "Hello world"), (None, "other"), (1, "again"),
        (10, "tab\tand\nline\r\n"), (11, "x" * 3000), (12, "é é"), (13, " hard　space"), (14, "ﬁne"), (15, "\x00\x01"),
        (16, "a b " * 700), (17, "Hello world, hello tokens")]


def test_equals_loops_over_every_document(docs, libraries):
    assert result(T.Alignment(docs(ROWS), *PATHS).measures(docs(ROWS))) == brute(ROWS, libraries)


def test_query_equals_loops(spark, libraries):
    from transitlens.llm.queries import QUERIES
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(QUERIES["op11_tokenizer_alignment"](spark, SF)) == brute(given, libraries)


def test_empty_table(docs):
    assert result(T.Alignment(docs([]), *PATHS).measures(docs([]))) == []


def test_a_text_that_a_third_of_the_rows_share(docs, libraries):
    rows = [(k, "the same words" if k % 3 else f"the number {k}") for k in range(600)]
    assert result(T.Alignment(docs(rows).repartition(5), *PATHS).measures(docs(rows))) == brute(rows, libraries)


def test_pieces_of_a_long_text_give_the_same_ids(spark):
    t = T.loaded(*PATHS)[0]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text][:60]
    whole = " ".join(texts) + " end. (x) 7 y  z"
    pieces = list(T.cut(" " + whole, 500))
    assert len(pieces) > 50 and "".join(pieces) == " " + whole
    a = [i for e in t.a.encode_batch(pieces, add_special_tokens=False) for i in e.ids]
    assert a == t.a.encode(" " + whole, add_special_tokens=False).ids
    assert [i for p in pieces for i in t.b.encode(p[1:])] == t.b.encode(whole)
    assert list(T.cut(" " + "語" * 2000, 500)) == [" " + "語" * 2000]


def test_plain_characters_encode_alike_in_both_libraries():
    t = T.loaded(*PATHS)[0]
    plain = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and T.PLAIN.fullmatch(chr(c))]
    assert len(plain) > 30_000 and not T.PLAIN.fullmatch("\u1680")
    probes = [f"a{c} {c}1{c} {c}{c}x  {c}\n{c}" for c in plain]
    for i in range(0, len(probes), 5000):
        theirs = t.a.encode_batch(probes[i:i + 5000], add_special_tokens=False)
        assert [t.ranks.encode_ordinary(p) for p in probes[i:i + 5000]] == [e.ids for e in theirs]


def test_every_entry_of_the_vocabulary_encodes_alike(spark):
    t = T.loaded(*PATHS)[0]
    words = [x.decode() for x in t.a_bytes if x.isascii()]
    texts = words + [x + y for x, y in zip(words, words[7:])]
    assert [t.ranks.encode_ordinary(x) for x in texts] == [e.ids for e in t.a.encode_batch(texts, add_special_tokens=False)]


def test_lexicon_holds_the_links(docs, libraries):
    rows = [(1, "one two two"), (2, "one two"), (3, "one two")]
    found = T.Alignment(docs(rows), *PATHS).lexicon().collect()
    a, b = libraries
    by_text = {(a.id_to_token(r.a_id), b.id_to_piece(r.b_id)): (r.links, r.best) for r in found}
    assert by_text == {("Ġone", "▁one"): (3, True), ("Ġtwo", "▁two"): (4, True)}

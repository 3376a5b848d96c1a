import hashlib
import random

import pytest

from tracklode.llm import bpe, tokens

public = pytest.importorskip("public_tokenizers")
ODD = ["a", "b", "th", "e", " ", "  ", "\n", "\t", " \n", "'", "'s", "'re", "'ll", "é", "ü", "漢", "😀", "1", "23", "!", "...", "<|endoftext|>", "<|end", "\x1c", "\x85", "　", "X", "the", " the", "$"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.vocabulary(public.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    import tiktoken

    v = bpe.vocabulary(public.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks={t: i for i, t in enumerate(v.tokens)}, special_tokens={})


@pytest.fixture(scope="module")
def other():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_pattern_is_the_published_one():
    assert bpe.PATTERN == public.PATTERN


def test_encoding_is_exact_on_odd_texts(ranks, library):
    for text in odd_texts(1500, 1):
        assert ranks.encode(text) == library.encode_ordinary(text), repr(text)
        assert ranks.decode(ranks.encode(text)) == text.encode()


def test_encoding_agrees_with_the_definition_of_merging(ranks):
    for text in odd_texts(300, 2):
        for piece in ranks.split.findall(text):
            assert ranks.encode_piece(piece.encode()) == ranks.merge(piece.encode())


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000, " " * 3000, "é" * 2000, ".;" * 2000, "\n\n\n x  y "])
def test_long_and_empty_texts(ranks, library, text):
    assert ranks.encode(text) == library.encode_ordinary(text)


def test_every_prefix_count_is_exact(other):
    v = bpe.vocabulary(public.path("byte_bpe_50k.json"))
    for text in odd_texts(600, 3):
        want = [len(other.encode(text[:i], add_special_tokens=False)) for i in range(len(text) + 1)]
        assert v.prefix_counts(text) == want, repr(text)
        assert v.count(text) == want[-1]
        for budget in (0, 1, 3):
            assert v.longest_within(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_memos_may_overflow(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO", 5)
    v = bpe.Vocabulary(*bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")))
    text = "the quick brown fox jumps over the lazy dog, and the other dogs' owners " * 3
    assert v.encode(text) == library.encode_ordinary(text) and v.count(text) == len(library.encode_ordinary(text))


def rows(spark, with_clash=False):
    data = [(1, "one two  three"), (2, None), (3, ""), (None, "x"), (1, "one two  three"), (4, "word " * 1500)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    return df.selectExpr("*", "1 as ids", "'q' as n_tokens", "2 as counts") if with_clash else df


def test_counts_over_a_table(spark, other):
    got = tokens.count_tokens(rows(spark, True), public.path("byte_bpe_50k.json")).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := len(other.encode(r.text or "", add_special_tokens=False)), n > 1024) for r in rows(spark).collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_digests_and_round_trip(spark, library):
    path = public.path("byte_bpe_50k.tiktoken")
    got = tokens.digests(rows(spark, True), path).collect()
    want = []
    for r in rows(spark).collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = tokens.decode(tokens.encode(rows(spark), path), path).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((r.text or "").encode() for r in rows(spark).collect())


def test_truncation_needs_no_encoding(spark, other):
    tables = tokens.prefix_tables(rows(spark), public.path("byte_bpe_50k.json"))
    for r in tokens.truncate(tables, 3).collect():
        counts = [len(other.encode(r.text[:i], add_special_tokens=False)) for i in range(len(r.text) + 1)]
        at = max(i for i, n in enumerate(counts) if n <= 3)
        assert (r.fits, r.fit_tokens) == (r.text[:at], counts[at])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.count_tokens(none, public.path("byte_bpe_50k.json")).count() == 0
    assert tokens.digests(none, public.path("byte_bpe_50k.tiktoken")).count() == 0


def test_neighbours_fit_as_merging_says(ranks):
    rnd = random.Random(5)
    common = [t for text in odd_texts(200, 6) for t in ranks.encode(text)]
    for _ in range(20_000):
        a, b = (rnd.choice(common) if rnd.random() < 0.3 else rnd.randrange(len(ranks.tokens)) if rnd.random() < 0.5 else rnd.randrange(3000) for _ in range(2))
        assert ranks.fits(a, b) == (ranks.merge(ranks.tokens[a] + ranks.tokens[b]) == [a, b]), (ranks.tokens[a], ranks.tokens[b])


@pytest.mark.parametrize("text", [" " * 100_000, "a" + "\n " * 30_000 + "b", "x <|endoftext|>" * 3000, "　" * 20_000 + "z", "y" * 50_000 + "<|endoftext|>" * 20])
def test_prefix_counts_take_linear_time(other, text):
    import time

    v = bpe.vocabulary(public.path("byte_bpe_50k.json"))
    began = time.thread_time()
    counts = v.prefix_counts(text)
    assert time.thread_time() - began < 10 and len(counts) == len(text) + 1
    for n in (1, 2, 17, len(text) // 2, len(text) - 1, len(text)):
        assert counts[n] == len(other.encode(text[:n], add_special_tokens=False))

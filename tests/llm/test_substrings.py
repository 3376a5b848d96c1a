import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tracklode.llm import substrings, windows
from tracklode.llm.common import Scratch

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """Result of each row by brute force; rows of one id and text are one document."""
    docs = sorted({(d if d is not None else -(1 << 63), hashlib.sha256((t or "").encode()).hexdigest(), t or "") for d, t in rows})
    seen, out = {}, {}
    for d, h, t in docs:
        words = WORD.findall(t.encode())
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            else:
                seen[key] = (d, s)
        kept = [w for w, g in zip(words, gone) if not g]
        out[d, h] = (len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return [(d, *out[d if d is not None else -(1 << 63), hashlib.sha256((t or "").encode()).hexdigest()]) for d, t in rows]


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "c"] if seed % 2 else [f"w{i}é" for i in range(200)]
    shared = [rnd.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 3, 19, 20, 21, 60]))]
        if i % 3 == 0:
            cut = rnd.randrange(0, 15)
            words = words[:10] + shared[cut:] + words[10:]
        if i % 10 == 9 and rows:
            words = (rows[-1][1] or "").split(" ")
        rows.append((rnd.randrange(0, 10**6), rnd.choice([" ", "  ", "\n"]).join(words)))
    return [*rows, (None, rows[0][1]), (-5, None), (7, "x"), rows[3], (rows[3][0], " ".join(shared)), (8, "z " * 70)]


@pytest.mark.parametrize("seed,window,most", [(0, 20, 1 << 25), (1, 20, 1 << 25), (2, 6, 0), (3, 6, 1 << 25), (0, 17, 0), (1, 20, 0), (1, 1, 0), (3, 2, 1 << 25), (3, 45, 0), (3, 45, 1 << 25)])
def test_against_brute_force(spark, monkeypatch, seed, window, most):
    monkeypatch.setattr(substrings, "SIEVE_MOST", most)
    monkeypatch.setattr(substrings, "PICKED", most)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "2 as v", "'q' as spans", "3 as h").repartition(3)
    got = substrings.digests(df, Scratch(spark), window).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows, window), key=str)


def words_of(*texts):
    (got,) = windows.sliced(pa.array([t.encode() for t in texts], pa.binary()))
    return got


def test_words_of_a_batch(monkeypatch):
    texts = ["", " a  bb", "a", "\tbb\n", "", "é\x0bü\x0c\r", "x" * 50, "", "a bb a bb"]
    monkeypatch.setattr(windows, "SLICE", 10)
    found, hashes = [], {}
    for w in windows.sliced(pa.array([None, *(t.encode() for t in texts)], pa.binary())[1:]):
        for r in range(len(w.row_end)):
            mine = [w.data[a:b].tobytes() for a, b in zip(w.start[w.row_start[r] : w.row_end[r]], w.end[w.row_start[r] : w.row_end[r]])]
            found.append(mine)
            for family in (0, 1):
                for x, h in zip(mine, w.hashes(family)[w.row_start[r] : w.row_end[r]]):
                    assert hashes.setdefault((family, x), h) == h
    assert found == [WORD.findall(t.encode()) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_range_hashes_tell_equal_ranges(monkeypatch):
    for span in (1, 4, 1 << 18):
        monkeypatch.setattr(windows, "SPAN", span)
        for family in (0, 1):
            h = words_of("a b c a b d").hashes(family)
            at = np.array([0, 3, 1])
            x = windows.ranges(h, at, at + 2, family)
            assert x[0] == x[1] != x[2] and h[0] == h[3] != h[1]
    assert list(windows.sliding_min(np.array([5, 3, 4, 1, 2, 6]), 3)) == [3, 1, 1, 1]


@pytest.mark.parametrize("window", [1, 2, 3, 5, 6, 7, 13, 20, 45, 50])
def test_blocks_hold_each_window_once_around_its_core(window):
    rnd = random.Random(window)
    words = words_of(*(" ".join(rnd.choice("abcd") for _ in range(n)) for n in (0, window - 1, window, 3 * window, 0, 200, 1)))
    lengths = substrings.lengths(window)
    assert lengths[-1] == window and all(b in (2 * a, 2 * a - 1) for a, b in zip(lengths, lengths[1:]))
    levels = substrings.Levels(window)
    valid = [s for s in range(len(words.start)) if s + window <= words.row_end[words.row_of(np.array([s]))[0]]]
    texts = [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)]
    for level, core in enumerate(levels.cores):
        known, place, first, count = levels.parts(words, level, [None] * len(levels.cores))
        assert sorted(s for f, c in zip(first, count) for s in range(f, f + c)) == valid
        of_window = {}
        for h, p, f, c in zip(known[level], place, first, count):
            assert f + c - 1 <= p and p + core <= f + window
            for s in range(f, f + c):
                assert of_window.setdefault(tuple(texts[s : s + window]), (h, p - s)) == (h, p - s)


def test_sieve_holds_what_it_was_given(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-(2**63), 2**63, 3000)
    bits = substrings.sieve(spark.createDataFrame([(int(x),) for x in h], "h long").repartition(5))
    assert bits.nbytes == 1 << 24 and substrings.in_sieve(bits, h.astype(np.uint64)).all() and np.bitwise_count(bits).sum() <= 3000
    assert substrings.in_sieve(bits, rng.integers(0, 2**63, 3000).astype(np.uint64)).mean() < 0.01


def test_cutting_keeps_other_texts_as_they_are(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"first\n{passage}\tend"), (2, f"second \n {passage}  tail\n"), (3, "clean   text\n\n"), (4, None), (None, "nobody"), (2, f"second \n {passage}  tail\n")]
    df = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long").selectExpr("*", "'x' as lang")
    out = substrings.cut(df, Scratch(spark))
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    want = [(1, rows[0][1]), (2, "second \n tail\n"), (2, "second \n tail\n"), (3, rows[2][1]), (4, None), (None, "nobody")]
    assert got == sorted(((d, t, len(t or "")) for d, t in want), key=str)


def test_same_id_with_other_text_is_cut_on_its_own(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    df = spark.createDataFrame([(1, passage), (2, "a b"), (2, f"{passage} tail")], "doc_id long, text string")
    assert sorted(r.text for r in substrings.cut(df, Scratch(spark)).collect()) == sorted([passage, "a b", "tail"])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.digests(none, Scratch(spark)).count() == 0 and substrings.cut(none, Scratch(spark)).count() == 0


def test_shingle_sets_are_those_of_plain_loops(monkeypatch):
    monkeypatch.setattr(windows, "SLICE", 30)
    texts = ["", "One", "one TWO three", "a b c d e f", "A  b\tc D e\nf a b c", "x " * 40, "é Ü é", "", "a b c d e"]
    for size in (1, 3, 5):
        sets = windows.shingle_sets(pa.array([t.encode() for t in texts], pa.binary()), size)
        named = {}
        for t, got in zip(texts, sets):
            words = t.encode().lower().split()
            runs = {b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
            assert len(got) == len(runs) and list(got) == sorted(got)
            named[t] = runs, set(got.tolist())
        for a in texts:
            for b in texts:
                assert len(named[a][0] & named[b][0]) == len(named[a][1] & named[b][1])

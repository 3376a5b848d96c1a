import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tracklode.llm import simhash
from tracklode.llm.common import Scratch, components, forest


def plain_fingerprint(text, size):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(rows, bits, size=3):
    """``rows`` of id and text: the smallest id of each row's component, by comparing all."""
    prints = [plain_fingerprint(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [(d, prints[i], min(low[find(i)], default=None)) for i, (d, _) in enumerate(rows)]


def test_the_hash_is_the_engines_own(spark):
    row = spark.sql("select xxhash64('tâche une b') as h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest("tâche une b".encode(), 42)


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c", "A b c\td\x0be É é" * 5, "x y z " * 30000])
def test_fingerprints(text):
    assert simhash.fingerprint((text or "").encode(), 3) == plain_fingerprint(text, 3)


def test_segments_leave_one_with_at_most_one_bit():
    for bits in range(0, 12):
        cut = simhash.segments(bits)
        assert sum(w for _, w in cut) == 64 and bits // len(cut) <= 1
        rng = np.random.default_rng(bits)
        for _ in range(50):
            x = int(rng.integers(0, 2**63))
            y = x
            for b in rng.choice(64, bits, replace=False):
                y ^= 1 << int(b)
            a, _ = simhash.variants(np.array([x], np.uint64), bits)
            b, _ = simhash.variants(np.array([y], np.uint64), bits)
            assert set(a) & set(b)


def test_near_links_join_what_all_links_join():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 20).astype(np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) for _ in range(80)]))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 2)
    node, root = forest(i, j)
    simhash_links = simhash.near_links(fps, 2)
    assert len(simhash_links[0]) < len(fps)
    assert all(np.bitwise_count(fps[a] ^ fps[b]) <= 2 for a, b in zip(*simhash_links))
    got = dict(zip(*forest(*simhash_links)))
    assert [got.get(n, n) for n in node] == list(root)


def rows(n=250):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 30, 60]))] if i % 4 == 0 or not out else list(out[-1])
        if i % 4 and words:
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append(words)
    made = [(i * 7 % n, " ".join(w)) for i, w in enumerate(out)]
    return [*made, (None, "w1 w2 w3"), (n + 1, None), (n + 2, " "), (made[0]), (n + 3, made[8][1].upper())]


@pytest.mark.parametrize("small,cap,window", [(16, 20_000, 1 << 17), (2, 3, 40)])
def test_components_against_comparing_all(spark, monkeypatch, small, cap, window):
    monkeypatch.setattr(simhash, "SMALL", small)
    monkeypatch.setattr(simhash, "WINDOW", window)
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'a' as fp", "1 as key", "2 as low")
    plain = simhash.link
    monkeypatch.setattr(simhash, "link", lambda p, s, bits: plain(p, s, bits, cap))
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df, Scratch(spark)).collect()), key=str)
    assert got == sorted(plain_components(data, 2), key=str)


def test_contraction_rounds(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1500), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(edges, Scratch(spark), local_edges=20).collect()}
    group = lambda v: got.get(v, v)
    assert len({group(i) for i in range(301)}) == 1 and group(1000) == group(2000) == group(1500) != group(5)


def test_one_document_of_each_group_stays(spark):
    rnd = random.Random(9)
    base = [f"t{rnd.randrange(10**6)}" for _ in range(200)]
    near = list(base)
    near[50] = "changed"
    half = base[:100] + [f"u{rnd.randrange(10**6)}" for _ in range(100)]
    data = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (1, " ".join(half)), (20, None), (21, ""), (22, ""), (None, "some text")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'en' as lang")
    kept = simhash.keep_one(df, Scratch(spark))
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 1, 20, 21, 22, None], key=str)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none, Scratch(spark)).count() == 0 and simhash.keep_one(none, Scratch(spark)).count() == 0


def similarity(a, b, size=5):
    x, y = ({tuple(t.lower().split()[k : k + size]) for k in range(max(1, len(t.split()) - size + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def plain_kept(rows, least=0.8):
    """Ids that stay, by comparing all."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(rows[i][1], rows[j][1]) >= least - 1e-9:
                parent[find(i)] = find(j)
    return sorted({find(i): min(d for k, (d, _) in enumerate(rows) if find(k) == find(i)) for i in range(len(rows))}.values())


def kept(spark, rows):
    return sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark)).collect())


def distinct_print(words):
    return plain_fingerprint(" ".join(sorted(set(words))), 1)


def test_a_pair_counts_whatever_lies_between_its_fingerprints(spark):
    apart = lambda x, y: bin(distinct_print(x) ^ distinct_print(y)).count("1")
    for seed in range(2000):
        rnd = random.Random(seed)
        a = [f"t{rnd.randrange(10**6)}" for _ in range(200)]
        b, c = list(a), list(a)
        for k in (20, 21, 22, 23, 24, 25):
            b[k] = f"u{rnd.randrange(10**6)}"
        c[20:23] = b[20:23]
        rnd.shuffle(c)
        if 0 < apart(a, c) < apart(a, b) <= 7 and 0 < apart(b, c) < apart(a, b):
            break
    else:
        raise AssertionError("no such texts")
    rows = [(k, " ".join(t)) for k, t in enumerate((a, b, c))]
    assert plain_kept(rows) == [0, 2] == kept(spark, rows)


@pytest.mark.parametrize("reach,frequent", [(2, 50), (8, 0)])
def test_keep_one_against_all_pairs(spark, monkeypatch, reach, frequent):
    monkeypatch.setattr(simhash.jaccard, "REACH", reach)
    monkeypatch.setattr(simhash.jaccard, "PICKED", frequent * 1000)
    monkeypatch.setattr(simhash.jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(simhash.jaccard, "WINDOW", 50)
    rnd = random.Random(4)
    common, texts = [f"c{k}" for k in range(40)], []
    for group in range(12):
        base = [f"g{group}x{rnd.randrange(500)}" for _ in range(rnd.choice([4, 30, 60, 120]))] + common * (group % 2)
        for _ in range(12):
            text = list(base)
            for _ in range(rnd.randrange(6)):
                text[rnd.randrange(len(text))] = f"n{rnd.randrange(10**6)}"
            texts.append(" ".join(text[rnd.randrange(3) :]))
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert kept(spark, rows) == plain_kept(rows)


def test_texts_of_one_fingerprint_are_checked(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(reversed(words))), (3, " ".join(words * 2)), (4, " ".join(words).upper()), (5, "\t".join(reversed(words)) + " "), (6, " ".join(sorted(words)))]
    assert len({distinct_print(t.lower().split()) for _, t in rows}) == 1
    assert kept(spark, rows) == plain_kept(rows)


def test_ids_that_repeat_or_lack(spark):
    base = [[f"{c}{k}" for k in range(60)] for c in "abc"]
    near = [[*b[:30], "other", *b[31:]] for b in base]
    rows = [(1, base[0]), (1, base[1]), (2, near[1]), (None, base[2]), (3, near[2]), (4, near[2]), (None, base[2])]
    got = sorted((r.doc_id or 0 for r in simhash.keep_one(spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string"), Scratch(spark)).collect()))
    assert got == [0, 0, 1, 1, 3]


@pytest.mark.parametrize("length", [100, 300])
def test_planted_runs_of_changed_words_are_found(spark, length):
    rnd, rows = random.Random(length), []
    for k in range(20):
        base = [f"t{rnd.randrange(10**6)}" for _ in range(length)]
        near, at = list(base), rnd.randrange(5, length * 8 // 10)
        run = length // 15
        near[at : at + run] = [f"u{rnd.randrange(10**6)}" for _ in range(run)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
    assert plain_kept(rows) == [2 * k for k in range(20)] == kept(spark, rows)


def test_bits_fixed_along_a_path_leave_fewer_each_turn():
    for bits in (0, 1, 2, 3, 7):
        for path in range(len(simhash.segments(bits))):
            left = [64 - bin(simhash.fixed_bits(path, bits, 0)).count("1")]
            for turn in range(1, 5):
                path = path * (bits + 1) + (turn % (bits + 1))
                fixed = simhash.fixed_bits(path, bits, turn)
                left.append(64 - bin(fixed).count("1"))
                parts = simhash.free_segments(fixed, bits)
                assert sum(parts) == ~fixed & (1 << 64) - 1
            assert all(b < a or not a for a, b in zip(left, left[1:]))


def test_a_group_over_the_cap_is_dealt_until_it_fits(spark):
    rng = np.random.default_rng(3)
    base = np.uint64(0x0123456789ABCDEF)
    flips = (np.uint64(1) << rng.integers(0, 20, (400, 3)).astype(np.uint64)).astype(np.uint64)
    fps = np.unique(np.concatenate([base ^ np.bitwise_xor.reduce(flips, axis=1), rng.integers(0, 2**63, 50).astype(np.uint64)]))
    df = spark.createDataFrame([(simhash.signed(int(x)),) for x in fps], "fp long")
    for bits in (1, 2):
        got = simhash.link(df, Scratch(spark), bits, 4).collect()
        a, b = (np.array([r[c] for r in got], np.int64).astype(np.uint64) for c in "ab")
        assert (np.bitwise_count(a ^ b) <= bits).all()
        i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None]) <= bits, 1))
        mine, want = dict(zip(*map(list, forest(a, b)))), dict(zip(*map(list, forest(fps[i], fps[j]))))
        assert mine == want


def planted(n, length=300):
    """Texts and copies with another word, whose fingerprints differ by at most five bits."""
    rnd, rows = random.Random(6), []
    while len(rows) < 2 * n:
        base = [f"t{rnd.randrange(10**6)}" for _ in range(length)]
        pair = " ".join(base), " ".join([*base[:70], "other", *base[71:]])
        if 0 < bin(plain_fingerprint(pair[0], 3) ^ plain_fingerprint(pair[1], 3)).count("1") <= 5:
            rows += [(len(rows) + k, t) for k, t in enumerate(pair)]
    return rows


def test_keep_one_takes_its_candidates_from_fingerprints(spark, monkeypatch):
    plain = simhash.jaccard.candidates
    monkeypatch.setattr(simhash.jaccard, "candidates", lambda rows, *rest: plain(rows, *rest).where("b is null"))
    rows = planted(4)
    assert kept(spark, rows) == plain_kept(rows) == [0, 2, 4, 6]


def test_pairs_that_fingerprints_join_are_not_looked_at_again(spark, monkeypatch):
    looked, plain = [], simhash.jaccard.verified
    monkeypatch.setattr(simhash.jaccard, "verified", lambda pairs, *rest: looked.append(pairs.count()) or plain(pairs, *rest))
    assert kept(spark, planted(1)) == [0] and looked == [1, 0]

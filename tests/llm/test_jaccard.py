"""What is sent for pairs that meet: the components of all similar pairs are held by test_simhash and test_stages."""

import random

from tracklode.llm import jaccard
from tracklode.llm.common import Scratch


def passages(n=60, near=6):
    """Different texts that all share a passage, so that they meet, and some near copies."""
    rnd = random.Random(2)
    words = lambda k: [f"w{rnd.randrange(10**6)}" for _ in range(k)]
    shared = words(120)
    texts = [words(100) + shared + words(100 + k % 7) for k in range(n)]
    for k in range(near):
        copy = list(texts[k])
        copy[5 + k] = "changed"
        texts.append(copy)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def tables(spark, rows):
    scratch = Scratch(spark)
    texts = scratch.write(spark.createDataFrame([(k, t.encode()) for k, t in rows], "node long, text binary"), "words")
    pairs = spark.createDataFrame([(a, b) for a, _ in rows for b, _ in rows if a < b], "a long, b long")
    return scratch, texts, scratch.write(pairs, "pairs"), scratch.write(jaccard.sketches(texts, 5), "sketches")


def links_of(rows, least=0.8, size=5):
    sets = [(k, set(zip(*(t.split()[i:] for i in range(size))))) for k, t in rows]
    return [(a, b) for a, x in sets for b, y in sets if a < b and len(x & y) >= least * len(x | y) - 1e-9]


def test_sketches_leave_few_pairs_open_and_no_similar_one_out(spark):
    rows = passages()
    _, _, pairs, marks = tables(spark, rows)
    got = {(r.a, r.b) for r in jaccard.still_open(pairs, marks, 0.8).collect()}
    assert len(links_of(rows)) == 6 and set(links_of(rows)) <= got and len(got) < 20 < pairs.count() // 50


def test_sketches_that_are_full_leave_no_similar_pair_out(spark):
    words = [f"w{k}" for k in range(300)]
    rows = [(0, " ".join(f"{a} {b}" for a in words for b in words)), (1, " ".join(f"{a} {b}" for a in words for b in words[:290])), (2, " ".join(words)), (3, "w0")]
    assert min(len(rows[k][1].split()) for k in (0, 1)) > 255 * jaccard.BUCKETS
    _, _, pairs, marks = tables(spark, rows)
    assert {(0, 1)} <= {(r.a, r.b) for r in jaccard.still_open(pairs, marks, 0.8).collect()}


def test_parts_hold_no_more_than_there_is_room_for_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PICKED", 0)
    monkeypatch.setattr(jaccard, "ROOM", 1 << 10)
    rows = passages(8, 4)
    scratch, texts, _, marks = tables(spark, rows)
    pairs = scratch.write(spark.createDataFrame([p for k in range(8, 12) for p in ((k - 8, k), (k - 8, 7), (k - 7, k))], "a long, b long"), "pairs")
    sizes, plain = [], jaccard.similar
    monkeypatch.setattr(jaccard, "similar", lambda part, *rest: sizes.append(part.count()) or plain(part, *rest))
    doubled = texts.unionAll(texts.where("node < 3"))
    got = sorted((r.a, r.b) for r in jaccard.verified(pairs, doubled, marks, scratch, 5, 0.8).collect())
    assert got == links_of(rows) and len(sizes) > 1 and sum(sizes) >= 4

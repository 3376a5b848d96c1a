import itertools
import random

import pytest
from pyspark.sql import functions as F

from tracklode.llm import packing
from tracklode.llm.common import Scratch


def padding(lengths, counts, bounds):
    return sum((min(b for b in bounds if b >= x) - x) * c for x, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rnd = random.Random(seed)
    lengths = sorted(rnd.sample(range(0, 60), rnd.randint(1, 9)))
    counts = [rnd.randint(1, 50) for _ in lengths]
    for k in (1, 2, 3, 20):
        got = packing.boundaries(lengths, counts, k)
        assert len(got) <= k and got[-1] == lengths[-1]
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n))
        assert padding(lengths, counts, got) == best


def test_no_lengths():
    assert packing.boundaries([], [], 4) == []


@pytest.mark.parametrize("parts", [50_000, 7])
def test_pack_small_table(spark, parts):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.choice([0, 1, 5, 9, 30, 95])) for i in range(80)] + [(None, "a b c"), (3, None), (5, "a b"), (5, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as length", "1 as bucket", "2 as piece")
    out = packing.pack(df, Scratch(spark), context=40, buckets=3, budget=120, part_rows=parts).collect()
    assert sum(r.length for r in out) == sum(len((t or "").split()) for _, t in rows)
    assert len(out) == sum(max(1, -(-len((t or "").split()) // 40)) for _, t in rows)
    batches = {}
    for r in out:
        assert 0 <= r.length <= r.bucket and r.padding == r.bucket - r.length and r.start == 40 * r.piece
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for (bucket, batch), slots in batches.items():
        room = max(1, 120 // max(bucket, 1))
        last = max(b for k, b in batches if k == bucket)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room and (len(slots) == room or batch == last)


def test_lengths_may_be_given(spark):
    df = spark.createDataFrame([(1, 5), (2, 7)], "doc_id long, n_tokens long")
    out = packing.pack(df, Scratch(spark), length=F.col("n_tokens"), buckets=1).collect()
    assert sorted((r.doc_id, r.length, r.bucket) for r in out) == [(1, 5, 7), (2, 7, 7)]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), Scratch(spark)).count() == 0


def test_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 100_000)], "doc_id long, text string")
    out = packing.pack(df, Scratch(spark)).collect()
    assert len(out) == 49 and sum(r.length for r in out) == 100_000


def test_rows_without_ids(spark):
    df = spark.createDataFrame([(None, "w " * (i % 50)) for i in range(300)], "doc_id long, text string")
    out = packing.pack(df, Scratch(spark), context=40, buckets=2, budget=200, part_rows=10).collect()
    assert sum(r.length for r in out) == sum(i % 50 for i in range(300)) and {r.doc_id for r in out} == {None}
    batches = {}
    for r in out:
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and len(s) <= max(1, 200 // b) for (b, _), s in batches.items())

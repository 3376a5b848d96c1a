import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklode.llm import topk
from tracklode.llm.common import Scratch


def plain(rows, every, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for qi, qv in ok:
            if qi != q:
                continue
            for i, v in ok:
                if i != q and len(v) == len(qv):
                    s = sum(a * b for a, b in zip(qv, v))
                    best[i] = max(best.get(i, s), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n, i, s) for n, (i, s) in enumerate(ranked, 1)]
    return sorted(out)


def rows(n, dim, seed, levels=None):
    rnd = random.Random(seed)
    value = (lambda: rnd.choice(levels)) if levels else (lambda: rnd.uniform(-1, 1))
    return [(i, [value() for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("data", [
    rows(300, 8, 1), rows(200, 5, 2, [0.0, 0.5]), rows(3, 4, 3), rows(60, 1, 4),
    [*rows(120, 6, 5), (None, [0.1] * 6), (130, None), (131, [None] * 6), (132, [float("nan")] * 6), (133, [float("inf")] + [0.0] * 5), (134, [1.0] * 3), (10, [0.9] * 6), (10, [0.9] * 6), (7, [0.8] * 6), (140, [])],
])
@pytest.mark.parametrize("held", [0, 64])
def test_against_all_pairs(spark, monkeypatch, data, held):
    monkeypatch.setattr(topk, "GROUP_ROWS", 50)
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "LEAST_ROWS", 30)
    monkeypatch.setattr(topk, "HELD", held)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as cut", "3 as score").repartition(3)
    got = sorted(map(tuple, topk.search(df, Scratch(spark), every=10).collect()))
    assert got == plain(data, 10, 5)


def test_large_integers_stay_exact(spark):
    big = 2.0**21
    data = [(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, 1.00390625]), (3, [-big, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.search(df, Scratch(spark), every=50).collect()))
    assert got == plain(data, 50, 5)


def length(column):
    return F.sum(F.length(column) / 8).cast("long")


def test_the_cutoff_skips_rows_and_only_misses_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rnd = random.Random(7)
    centres = [[rnd.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    data = [(i, [(c + rnd.gauss(0, 0.2)) / 8 for c in rnd.choice(centres)]) for i in range(3000)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk.phases(df, Scratch(spark), every=100)
    pairs = 30 * 3000
    blocks = got["gathered"].where("bests is not null").count()
    assert got["requests"].count() < blocks / 2  # most pairs of a block and a chunk are skipped
    given = got["entries"].agg(length("at")).first()[0]
    looked, whole = (got["lacking"].where(f"whole = {w}").agg(length("at")).first()[0] or 0 for w in (0, 1))
    assert given < 2 * pairs / 10 and looked + 2 * whole == given and whole > 0
    assert 30 * 5 <= got["scored"].count() < given / 4  # the cutoff is a lower bound, so more than k rows may reach it
    assert sorted(map(tuple, topk.search(df, Scratch(spark), every=100).collect())) == plain(data, 100, 5)


def test_a_vector_that_many_rows_share_is_one_class(spark):
    data = [(i, [0.5, 0.25, -0.5]) for i in range(200)] + [(200 + i, [0.5, 0.25, i / 300]) for i in range(100)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk.phases(df, Scratch(spark))
    assert got["entries"].agg(length("at")).first()[0] < 1000
    assert sorted(map(tuple, topk.search(df, Scratch(spark)).collect())) == plain(data, 50, 5)


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for most in (100, 2**15, 2**25, 2**40):
        a, b = rng.integers(-most, most, (5, 7)), rng.integers(-most // 2**20 - 3, 100, (6, 7))
        assert topk.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]


def test_empty_table(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), Scratch(spark)).count() == 0

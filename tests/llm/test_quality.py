import zlib

import numpy as np

from tracklode.llm import quality


def test_shapes():
    assert quality.shape("Hello!!") == "Aa!!" and quality.shape("ABC12") == "A0" and quality.shape("é***") == "a***"


def test_hinge_fit_separates_and_respects_its_bounds():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 6, replace=False)) + (50 if i % 2 else 0) for i in range(60)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    values = [np.full(6, 6**-0.5) for _ in rows]
    w = quality.fit_hinge(rows, values, y, np.full(60, 10.0), 100, passes=50)
    margin = np.array([w[r] @ v + w[-1] for r, v in zip(rows, values)])
    assert (margin * y > 0).all()
    # the dual optimum is the minimum of the primal: small random moves do not lower it
    loss = lambda u: 0.5 * u @ u + 10 * np.maximum(0, 1 - y * np.array([u[r] @ v + u[-1] for r, v in zip(rows, values)])).sum()
    best = loss(w)
    assert all(loss(w + rng.normal(0, 0.05, len(w))) > best - 0.05 for _ in range(30))


def table(spark, n=400):
    good, bad = "calm words about rivers and hills", "BUY!! NOW!! CHEAP!!"
    rows = [(i, f"{good if i % 3 else bad} w{i % 17}") for i in range(n)]
    docs = spark.createDataFrame([*rows, (n, None), (n + 1, ""), (None, "x"), (0, rows[0][1])], "doc_id long, text string").selectExpr("*", "'z' as y", "1 as quality", "0.5 as score")
    labels = spark.createDataFrame([*((i, int(bool(i % 3)), "a") for i in range(n)), (None, 1, "a"), (5, None, "a"), (7, 1, "a")], "doc_id long, quality int, text string")
    return docs, labels


def test_scores_of_a_small_table(spark):
    docs, labels = table(spark)
    model = quality.train(docs, labels)
    out = quality.score(docs, model).withColumn("held_out", quality.held_out()).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id is not None and r.doc_id < 400:
            assert (r.score >= 0.7) == bool(r.doc_id % 3)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i in range(400) if i % 3}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = table(spark)
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert np.array_equal(a.scaled, b.scaled) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_one_class_or_no_labels(spark):
    docs, labels = table(spark)
    one = quality.score(docs, quality.train(docs, labels.where("quality = 1"))).collect()
    assert all(r.score > 0.99 for r in one)
    none = quality.score(docs, quality.train(docs, labels.where("false"))).collect()
    assert all(abs(r.score - 0.5) < 1e-9 for r in none)
    assert quality.score(docs.where("false"), quality.train(docs.where("false"), labels)).count() == 0


def test_shuffle_join_of_labels_gives_the_same(spark, monkeypatch):
    docs, labels = table(spark)
    a = quality.train(docs, labels)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0)
    assert np.allclose(a.scaled, quality.train(docs, labels).scaled)


def test_held_out_accuracy_on_the_given_tables(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.01"
    out = __spark_entry__.queries()["op2_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() >= 0.95


def plain_buckets(text):
    """Feature buckets by whole numbers, one gram at a time."""
    import xxhash

    wide, mix = 1 << 64, int(quality.MIX)
    words = (text or "").split()
    w = [xxhash.xxh64_intdigest(x.lower(), 1) for x in words]
    s = [xxhash.xxh64_intdigest(quality.shape(x), 2) for x in words]
    codes = [*s, *((a * mix + b) % wide + 5 for a, b in zip(s, s[1:])), *((((a * mix + b) % wide) * mix + c) % wide + 7 for a, b, c in zip(s, s[1:], s[2:]))]
    codes += [*w, *((a * mix + b) % wide + 3 for a, b in zip(w, w[1:]))]
    return sorted({c % wide * mix % wide >> 64 - quality.BITS for c in codes})


def plain_scores(train, texts, cost=1.0, passes=12):
    """Naive Bayes support vectors with dicts: log-count ratios, hinge loss by dual ascent, a logistic curve through margins of three folds."""
    import math

    rows = [(plain_buckets(t), y) for _, t, y in sorted(train)]
    n = {y: {} for y in (0, 1)}
    for b, y in rows:
        for k in b:
            n[y][k] = n[y].get(k, 0) + 1
    total = {y: quality.SIZE + sum(n[y].values()) for y in n}
    ratio = lambda k: math.log((1 + n[1].get(k, 0)) / total[1]) - math.log((1 + n[0].get(k, 0)) / total[0])

    def vector(b):
        length = math.sqrt(sum(ratio(k) ** 2 for k in b))
        return {k: ratio(k) / length for k in b} if length else {}

    def fit(part):
        weights, bias, alpha = {}, 0.0, [0.0] * len(part)
        rng = np.random.default_rng(1)
        for _ in range(passes):
            worst = 0.0
            for i in rng.permutation(len(part)):
                x, y, c = part[i]
                slope = y * (sum(weights.get(k, 0.0) * v for k, v in x.items()) + bias) - 1
                new = min(max(alpha[i] - slope / (sum(v * v for v in x.values()) + 1), 0.0), c)
                step = new - alpha[i]
                alpha[i] = new
                for k, v in x.items():
                    weights[k] = weights.get(k, 0.0) + step * y * v
                bias += step * y
                worst = max(worst, abs(step))
            if worst < 1e-3:
                break
        return lambda x: sum(weights.get(k, 0.0) * v for k, v in x.items()) + bias

    count = {y: sum(z == y for _, z in rows) for y in (0, 1)}
    made = [(vector(b), 2 * y - 1, cost * len(rows) / (2 * count[y])) for b, y in rows]
    margins = [0.0] * len(made)
    for k in range(3):
        f = fit([r for i, r in enumerate(made) if i % 3 != k])
        for i in range(k, len(made), 3):
            margins[i] = f(made[i][0])
    a, b = quality.fit_curve(np.array(margins), np.array([y for _, y, _ in made], float))
    f = fit(made)
    return [1 / (1 + math.exp(-min(max(a * f(vector(plain_buckets(t))) + b, -40), 40))) for t in texts]


def test_scores_equal_those_of_a_plain_model(spark):
    import random

    rnd = random.Random(2)
    good, bad, odd = ["River", "hill", "calm,", "über", "walks", "12", "A-b"], ["BUY!!", "now", "$9", "cheap", "hill", "x" * 30], ["", " ", "é"]
    rows = [(i, " ".join(rnd.choice((good if i % 3 else bad) + odd) for _ in range(rnd.randint(0, 12)))) for i in range(90)]
    docs = spark.createDataFrame([*rows, (500, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(bool(i % 3)) if i % 7 else 0) for i, _ in rows], "doc_id long, quality int")
    train = [(i, t, int(bool(i % 3)) if i % 7 else 0) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    got = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    want = plain_scores(train, [t for _, t in rows] + [None])
    assert np.allclose([got[i] for i, _ in [*rows, (500, None)]], want, atol=1e-9)


def test_the_sample_is_bounded_by_rows_and_by_indicators(spark):
    docs, labels = table(spark)
    whole = quality.train(docs, labels)
    assert np.array_equal(whole.square, quality.train(docs, labels, max_fit_rows=100).square)  # counts cover all rows
    assert not np.array_equal(whole.scaled, quality.train(docs, labels, max_fit_features=1000).scaled)

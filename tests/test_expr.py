from pyspark.sql import functions as F

from tracklode.functions import expr as E


def one(spark, *columns, data=None, schema="x string"):
    df = spark.createDataFrame(data, schema) if data else spark.range(1)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_truth_and_numbers(spark):
    data = [("True",), ("yes ",), ("1",), ("no",), (None,), ("nan",), ("inf",), ("abc",), ("-2.5",)]
    got = one(spark, E.truthy("x"), E.truthy_wide("x"), E.safe_float("x", 0.0), E.text_of("x"), data=data)
    assert [r[0] for r in got] == [True] + [False] * 8
    assert [r[1] for r in got] == [True, True, True] + [False] * 6
    assert [r[2] for r in got] == [0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, -2.5]
    assert [r[3] for r in got][3:6] == ["no", "", ""]


def test_clamp_round_and_either(spark):
    got = one(spark, E.clamp(F.lit(1.7)), E.clamp(F.lit(-1.0)), E.clamp(F.lit(float("nan"))), E.clamp(F.lit(None).cast("double")), E.rounded(F.lit(float("inf"))), E.either(F.lit(""), F.lit(None), F.lit("b")), E.either_number(F.lit(0.0), F.lit(3.0)))
    assert got == [(1.0, 0.0, 1.0, None, None, "b", 3.0)]


def test_sets(spark):
    a, b, none = F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("z")), F.array().cast("array<string>")
    got = one(spark, E.jaccard(a, b), E.jaccard(none, none), E.jaccard(a, none), E.overlaps(a, b), E.items(F.lit("a; b;;c")), E.unique_in_order(F.array(F.lit(" A"), F.lit("b"), F.lit("a"), F.lit(""))))
    assert got[0][1:] == (1.0, 0.0, True, ["a", "b", "c"], ["a", "b"]) and abs(got[0][0] - 1 / 3) < 1e-12


def test_ladders(spark):
    x = F.col("x")
    got = one(spark, E.first_match([(x == "a", F.lit("A")), (x < "c", F.lit("B"))], F.lit("C")), E.reasons((x == "a", "is_a"), (x < "c", "small")), data=[("a",), ("b",), ("z",), (None,)])
    assert got == [("A", "is_a;small"), ("B", "small"), ("C", ""), ("C", "")]


def test_arrays(spark):
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(0.0), F.lit(0.0))
    nan = F.array(F.lit(float("nan")), F.lit(2.0))
    got = one(spark, E.l2(a), E.l2(nan), E.cosine(a, a), E.cosine(a, b), E.average_hash(F.array(F.lit(1.0), F.lit(5.0), F.lit(3.0))), E.hamming(F.lit("1010"), F.lit("1001")))
    assert got == [(5.0, 2.0, 1.0, None, "010", 2)]
    pose = F.array(*(F.lit(float(i)) for i in (9, 9, 9, 1, 0, 0, 0)))
    assert one(spark, E.quaternion_norm(pose), E.array_mean(a)) == [(1.0, 3.5)]


def test_even_indices_round_half_to_even(spark):
    assert one(spark, E.even_indices(F.lit(10), 3), E.even_indices(F.lit(0), 3), E.even_indices(F.lit(2), 5), E.even_indices(F.lit(100), 1)) == [([0, 4, 9], [], [0, 1], [0])]


def test_quantile_bins(spark):
    for n, want in ((1, [0]), (2, [0, 3]), (6, [0, 0, 1, 2, 3, 3])):
        got = one(spark, E.quantile_bin(F.col("r"), F.lit(n), 4), data=[(i,) for i in range(1, n + 1)], schema="r int")
        assert [r[0] for r in got] == want


def test_texts(spark):
    got = one(spark, E.episode_number(F.lit("a/episode12.hdf5")), E.base_name(F.lit("c__job_0001")), E.safe_name(F.lit("a-b+c")), E.relative_path(F.lit("/r/a/b"), "/r"), E.absolute_path("/r", F.lit("a")), E.clock(F.lit(3725)), E.bar(F.lit(1), F.lit(2), 4), E.target_count(F.lit("")))
    assert got == [(12, "c", "a_b_c", "a/b", "/r/a", "01:02:05", "[##--]", 0)]
    split, prompt = E.set_split(F.lit("val_videos_2"))
    assert one(spark, split, prompt) == [("val", "variant_2")]

import pytest
from pyspark.sql import functions as F

from tracklode.operators import manifest as M
from tracklode.operators import retrieval as R
from tracklode.operators import sampling as S
from tracklode.plans import jobs as P


def test_episode_index_and_paths(spark):
    paths = ["/d/val/video/fixed/episode1.mp4", "/d/val/video/zeta/episode1.mp4", "/d/val/hdf5/fixed/episode1.hdf5", "/d/val/video/fixed/episodeX.mp4", "/d/val/video/fixed/myepisode2.mp4", "/d/val/other/episode3.mp4"]
    df = spark.createDataFrame([("val", p) for p in paths], "dataset string, path string")
    got = M.episode_index(df, {"video": "video", "hdf5": "hdf5"}).collect()
    assert [tuple(r) for r in got] == [("val", 1, paths[1], paths[2])]
    parts = spark.createDataFrame([("a/b/episode1.x",), ("episode1.x",)], "p string").select(*M.path_parts("p").values()).collect()
    assert [tuple(r) for r in parts] == [("b", "root/a/b"), (".", "none")]


def test_cross_table(spark):
    s, a, v = (spark.createDataFrame(rows, f"id int, {c} string") for rows, c in (([(1, "s")], "s"), ([(2, "a")], "a"), ([(3, "v")], "v")))
    p = spark.createDataFrame([(1, "variant_1", "X"), (1, "variant_2", "Y"), (9, "variant_1", "Z")], "id int, comparison string, policy string")
    assert sorted(map(tuple, M.cross_table(s, a, v, p, ["id"]).collect())) == [(1, "s", None, None, "X", "Y"), (2, None, "a", None, None, None), (3, None, None, "v", None, None)]


def test_modes_types_and_robots(spark):
    df = spark.createDataFrame([("VERB_CHANGED", "AMBIGUOUS", " UR5-Wsg "), (None, "TARGET_CHANGED", "piper"), ("SAME_ACTION_OK", None, "new ")], "a string, b string, r string")
    got = [tuple(r) for r in df.select(M.inference_mode("a"), M.dpo_type("a", "b"), M.embodiment("r")).collect()]
    assert got == [("action_retrieval_or_robotwin_replan", "hard_negative_prompt_action_mismatch", "ur5-wsg"), ("manual_review_or_text_driven_fallback", "mixed_policy_pair", "piper"), ("action_driven_original_hdf5", "same_action_preference_pair", "new")]


def test_eligibility_and_exports(spark):
    rows = [("v", "piper", "dual_arm_joint14_valid", "True", "False"), ("v", "piper", "dual_arm_joint14_valid", None, "true"), ("", "piper", "dual_arm_joint14_valid", "True", ""), ("v", "franka-panda", "dual_arm_joint14_valid", "True", ""), ("v", "piper", "other", "True", ""), ("v", "piper", "dual_arm_joint14_valid", "False", "true")]
    df = spark.createDataFrame(rows, "video_path string, embodiment string, quality_flags string, accepted_for_sft string, success string")
    assert M.eligible(df, "accepted_for_sft", ["piper", "franka-panda"]).count() == 2
    out = M.export_a2v(spark.createDataFrame([("PASS", 0, "j", None), ("WARN_KEEP", 0, "j", "e"), ("WARN_KEEP", 1, "", "e")], "d string, s int, joint string, ee string"), ["joint", "ee"], "d", "s")
    assert sorted((r.representation, r.action_path) for r in out.collect()) == [("ee", "e"), ("joint", "j")]


def test_validation(spark):
    df = spark.createDataFrame([("PASS", "True", "a"), ("REJECT", "False", "zz")], "s string, f string, p string")
    assert tuple(M.validator_report(df, "s", ["f"]).first()) == (2, 0.5, True, 1)
    assert tuple(M.missing_references(df, ["p"], spark.createDataFrame([("a",), ("a",)], "path string")).first()) == ("p", 2, 1)
    assert sorted(map(tuple, M.coverage(df, "s", {"PASS": 1, "WARN": 2}).collect())) == [("PASS", 1, 1, True), ("WARN", 2, 0, False)]
    assert M.resume(df, df.where("s = 'PASS'"), "p").count() == 1
    cfg = spark.createDataFrame([(0.02, 256, 8, "OIDN"), (0.5, 0, 40, "x"), (-1.0, 512, 1, None)], "height double, spp int, depth int, denoiser string")
    assert [r[0] for r in cfg.select(M.config_faults(cfg, {"height": 0.03})).collect()] == ["", "height;spp;depth;denoiser", "height"]


def test_best_video(spark):
    rows = [("k", True, 20, 10, 10, 5.0, "a"), ("k", True, 20, 10, 10, 6.0, "b"), ("k", True, 11, 99, 99, 9.0, "short"), ("k", False, 50, 99, 99, 9.0, "bad")]
    df = spark.createDataFrame(rows, "key string, readable boolean, frames int, width int, height int, duration double, path string")
    assert M.best_video(df, "key").first().path == "b"


def test_top_k_against_all_pairs(spark):
    import random

    rnd = random.Random(2)
    pick = lambda names, n: rnd.sample(names, rnd.randint(0, n))
    make = lambda i: (i, rnd.choice(["f", "g", None, ""]), pick(["a", "b", "c"], 2), pick(["x", "y"], 1), pick(["t"], 1), pick(["l", "r"], 1))
    form = "family string, verbs array<string>, objects array<string>, targets array<string>, spatial array<string>"
    q = [make(i) for i in range(12)] + [(99, None, [], [], [], [])]
    lib = [(*make(i), rnd.choice([0, 100, 2000, 9000]), rnd.choice([0.0, 0.4, 1.0, 2.0])) for i in range(30)]

    def score(a, b):
        s = 4.0 if a[1] is not None and a[1] == b[1] else 0.0
        s += sum(w for w, x, y in zip((3, 3, 2, 1), a[2:6], b[2:6]) if set(x) & set(y))
        return round(s - b[6] / 500 - max(0, 1 - (b[7] or 1)), 6)

    want = {}
    for a in q:
        ranked = sorted(((score(a, b), b[0]) for b in lib), key=lambda x: (-x[0], x[1]))
        want |= {(a[0], n): (i, s, sum(x > 0 for x, _ in ranked)) for n, (s, i) in enumerate(ranked[:5], 1)}
    got = R.top_k(spark.createDataFrame(q, "query_id int, " + form), spark.createDataFrame(lib, "library_id int, " + form + ", t int, quality double"))
    assert {(r.query_id, r.rank): (r.library_id, r.score, r.candidate_count) for r in got.collect()} == want
    few = R.top_k(spark.createDataFrame(q, "query_id int, " + form), spark.createDataFrame(lib[:2], "library_id int, " + form + ", t int, quality double"))
    assert few.count() == 2 * len(q)
    assert R.candidates(got, spark.createDataFrame([(i, f"p{i}") for i in range(30)], "library_id int, path string"), ["path"]).count() == len(q)


@pytest.mark.parametrize("n", [0, 1, 7, 100])
def test_split_is_exact_and_disjoint(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = S.train_split(df, "k").groupBy("split").count().collect()
    assert sum(r["count"] for r in got) == n and sum(r["count"] for r in got if r.split == "train") == int(n * 0.9)


def test_samples(spark):
    df = spark.createDataFrame([(i, "ab"[i % 5 == 0], i % 3) for i in range(60)], "k int, g string, h int")
    assert S.simple_sample(df, "k", 10).count() == 10 and S.simple_sample(df, "k", 99).count() == 60 and S.simple_sample(df, "k", 0).count() == 0
    assert S.ratio_sample(df, "g", "k", 0.01).count() == 2
    strat = S.stratified_sample(df, ["g"], "k", 20).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in strat} == {"a": 10, "b": 10}
    assert S.stratified_sample(df, ["g"], "k", 99).count() == 60
    made = S.composed_sample(df, "k", 10, 5, 20, "h")
    assert made.count() == made.select("k").distinct().count() == 20 and made.where("sample_group = 'hard'").agg(F.min("h")).first()[0] == 2
    assert S.filtered_or_all(df, F.col("k") < 5).count() == 5 and S.filtered_or_all(df, F.col("k") < 0).count() == 60
    lab = spark.createDataFrame([(0, "PASS"), (1, ""), (2, "PASS"), (3, None)], "i int, l string")
    assert [S.next_unlabelled(lab, "i", "l", a).first().next for a in (0, 1, 3)] == [1, 3, 1]
    assert S.next_unlabelled(lab.where("i = 0"), "i", "l", 0).first().next == 0


def test_quotas(spark):
    df = spark.createDataFrame([(45,), (5,), (1,)], "q int")
    split = lambda m, h: [(r.q, r.profile, r["count"]) for r in P.config_counts(df, "q", m, h).orderBy(F.desc("q"), "profile_order").collect()]
    clean, mild, hard = P.PROFILES
    assert split(False, False) == [(45, clean, 45), (5, clean, 5), (1, clean, 1)]
    assert split(True, True)[:3] == [(45, clean, round(45 * 0.7)), (45, mild, 9), (45, hard, 45 - round(45 * 0.7) - 9)]
    assert split(False, True)[:2] == [(45, clean, round(40.5)), (45, hard, 5)]
    assert split(True, False)[2:4] == [(5, clean, 4), (5, mild, 1)]


def test_jobs_hold_one_robot_each(spark):
    counts = P.config_counts(spark.createDataFrame([("fam", 230)], "family string, quota int"), "quota")
    planned = P.slots(counts, ["family", "profile_order"], P.embodiment_weights("aloha-agilex", "piper"))
    jobs = P.jobs(planned, "family", target=5, gpus=2).orderBy("job_id").collect()
    assert sum(j.target_success for j in jobs) == 230 and max(j.target_success for j in jobs) == 5
    assert sum(j.target_success for j in jobs if j.embodiment == "piper") == 10 and [j.job_id for j in jobs][:2] == ["job_00000", "job_00001"]
    assert jobs[0].task_config == "wa_clean_fixed__aloha_agilex__job_00000" and {j.gpu_id for j in jobs} == {0, 1}


def test_progress(spark):
    plan = spark.createDataFrame([("a", 5, "x"), ("b", 2, "x"), ("c", None, "y"), ("d", 3, "y")], "job string, t int, cfg string")
    done = spark.createDataFrame([("a", 9), ("b", 1)], "job string, done long")
    got = {r.cfg: tuple(r)[1:] for r in P.progress(plan, done, "job", "t", ["cfg"]).collect()}
    assert got[None] == (4, 10, 6, 2, 1, 1, 0.6) and got["x"] == (2, 7, 6, 1, 1, 0, 0.857143)
    reports = spark.createDataFrame([('{"probe_pass": false}',), ('{"probe_pass": true}',), ("?",)], "j string")
    assert P.probe_passed(reports, "j").first().passed and not P.probe_passed(reports.limit(0), "j").first().passed


def test_ranks_over_ranges(spark):
    import random

    rnd = random.Random(3)
    values = [rnd.choice([None, 0.0, 5.0, -1e9, 1e9, rnd.random()]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    order = sorted(range(200), key=lambda i: (values[i] is not None, values[i] or 0.0, i))
    place = {i: n for n, i in enumerate(order, 1)}
    got = {r.k: r for r in S.with_bins(S.percent_ranks(df, "v", "p"), "v", "k", 4, "b").collect()}
    for i, v in enumerate(values):
        tied = [place[j] for j, w in enumerate(values) if w == v]
        assert got[i].p == pytest.approx(sum(tied) / len(tied) / 200) and got[i].b == max(-(-(place[i] - 1) * 4 // 199), 1) - 1
    same = spark.createDataFrame([(1, 2.0), (2, 2.0)], "k int, v double")
    assert sorted(r.p for r in S.percent_ranks(same, "v", "p").collect()) == [0.75, 0.75]

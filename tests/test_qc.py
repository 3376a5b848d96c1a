import pytest
from pyspark.sql import functions as F

from tracklode.functions import text as X
from tracklode.operators import aggregates as A
from tracklode.operators import qc as Q

CLIP = dict(frames=40, read_fails=0, bad_ratio=0.0, width=640, height=480, fps=24.0, action_ok=True, has_nan=False, has_inf=False, background_flicker=False, color_shift=False, rgb_step=0.0, luma_step=0.0, bg_luma=0.0, bg_color=0.0, fg_step=0.0, contact_score=0.0,
            motion_ratio=0.0, contact_visible=1.0, robot_visible=1.0, blockiness=0.0, sharpness=99.0, dpo_score=0.0)
RULES = [
    ({}, "pass", "ok"), ({"read_fails": 11}, "reject", "many_sample_frames_failed"), ({"read_fails": 10}, "pass", "ok"), ({"bad_ratio": 0.31}, "reject", "black_or_bad_frames"), ({"bad_ratio": 0.3}, "warn", "bad_or_black_frames"), ({"width": 320}, "reject", "resolution_invalid"), ({"width": 0}, "pass", "ok"),
    ({"fps": 30.0}, "reject", "fps_invalid"), ({"action_ok": False, "has_nan": True, "has_inf": True}, "reject", "invalid_action_shape_or_values;action_nan;action_inf"), ({"background_flicker": True}, "warn", "background_flicker_candidate"), ({"color_shift": True}, "warn", "true_color_shift_candidate"),
    ({"rgb_step": 36.0}, "pass", "content_motion_not_flicker"), ({"luma_step": 19.0, "fg_step": 0.05}, "pass", "content_motion_not_flicker;foreground_entry_caused_global_shift"), ({"rgb_step": 36.0, "bg_luma": 6.0}, "pass", "ok"),
    ({"contact_score": 0.75, "dpo_score": 0.75}, "warn", "possible_object_motion_without_contact"), ({"contact_score": 0.85, "dpo_score": 0.85}, "dpo_loser_candidate", "possible_object_motion_without_contact"), ({"motion_ratio": 0.13, "contact_visible": 0.1}, "warn", "contact_visibility_borderline"),
    ({"motion_ratio": 0.09, "robot_visible": 0.05}, "warn", "robot_visibility_borderline"), ({"blockiness": 46.0, "sharpness": 24.0}, "warn", "severe_compression_artifacts"),
]


def test_rule_ladder(spark):
    df = spark.createDataFrame([{"i": i, **CLIP, **change} for i, (change, _, _) in enumerate(RULES)])
    got = {r.i: (r.qc_status, r.qc_reason) for r in Q.rule_check(df).collect()}
    assert [got[i] for i in range(len(RULES))] == [(s, r) for _, s, r in RULES]


BASE = dict(qc_status="pass", vlm_decision="PASS", vlm_confidence=0.9, vlm_evidence="fine", hard_fail_reason="", qc_reason="ok", video_readable="true", deterministic_hard_fail="False")
ALL2 = {f"score_{s}": 2 for s in X.SCORES}
MERGES = [
    ({}, "PASS", "vlm_pass_no_hard_fail", False), ({"vlm_confidence": 0.1}, "PASS", "vlm_pass_no_hard_fail", False), ({"deterministic_hard_fail": "True"}, "REJECT", "deterministic_hard_fail", False), ({"video_readable": "False"}, "REJECT", "deterministic_hard_fail", False), ({"qc_reason": "fps_invalid"}, "REJECT", "deterministic_hard_fail", False),
    ({"vlm_decision": "REJECT", "flag_severe_noise_or_compression": True, "vlm_evidence": "compression"}, "WARN_KEEP", "vlm_visual_artifact_only_warn_keep", False), ({"vlm_decision": "REJECT", "vlm_evidence": "a blank frame"}, "REJECT", "vlm_obvious_visual_hard_reject", False),
    ({"vlm_decision": "REJECT", "flag_wrong_robot_or_missing_robot": True}, "REJECT", "vlm_obvious_visual_hard_reject", False), ({"vlm_decision": "REJECT", **{f"score_{s}": 0 for s in Q.ZERO_SCORES[:6]}}, "REJECT", "vlm_obvious_visual_hard_reject", False), ({"qc_status": "reject"}, "NEED_HUMAN_REVIEW", "rule_vlm_conflict", True),
    ({"vlm_decision": "REJECT", "vlm_confidence": 0.75}, "NEED_HUMAN_REVIEW", "rule_vlm_conflict", True), ({"qc_status": "warn", "vlm_decision": "REJECT", "vlm_confidence": 0.75}, "REJECT", "vlm_reject_confident", False), ({"vlm_decision": "REJECT", "vlm_confidence": 0.74}, "WARN_KEEP", "vlm_warn_or_low_confidence", False),
    ({"vlm_decision": "DPO_LOSER_CANDIDATE", "vlm_confidence": 0.7}, "DPO_LOSER_CANDIDATE", "vlm_dpo_loser_confident", False), ({"vlm_decision": "DPO_LOSER_CANDIDATE", "vlm_confidence": 0.69}, "WARN_KEEP", "vlm_warn_or_low_confidence", False), ({"vlm_decision": "WARN_KEEP"}, "WARN_KEEP", "vlm_warn_or_low_confidence", False),
    ({"vlm_decision": None, "vlm_confidence": None}, "WARN_KEEP", "vlm_warn_or_low_confidence", False), ({"vlm_decision": "NEED_HUMAN_REVIEW"}, "NEED_HUMAN_REVIEW", "unhandled_vlm_decision", False), ({"qc_status": "reject", "deterministic_hard_fail": "True"}, "REJECT", "deterministic_hard_fail", True),
]


def test_merge_ladder(spark):
    flags = {f"flag_{f}": False for f in X.FLAGS}
    rows = [{"i": i, **BASE, **ALL2, **flags, **change} for i, (change, *_) in enumerate(MERGES)]
    got = {r.i: (r.final_decision, r.final_reason, r.is_conflict) for r in Q.merge_rule_and_model(spark.createDataFrame(rows)).collect()}
    assert [got[i] for i in range(len(MERGES))] == [tuple(m[1:]) for m in MERGES]


SINGLE = dict(hard_pass=True, hard_reason="", static_clip=False, over_motion=False, duplicate_ratio=0.0, scene_cut=0.0, identity_jump=False, vlm_decision="PASS", vlm_confidence=0.9, vlm_task_progress_score=2, vlm_physics_score=2, vlm_semantic_consistency_score=2, consistency=0.9, action_energy=0.01, visual_energy=1.0, transitions=0)
SINGLES = [
    ({}, "PASS", "ok"), ({"hard_pass": False, "hard_reason": "x"}, "REJECT", "x"), ({"static_clip": True}, "REJECT", "static_clip"), ({"over_motion": True}, "REJECT", "over_motion_clip"), ({"duplicate_ratio": 0.66}, "WARN", "large_duplicate_frame_ratio"), ({"scene_cut": 0.56}, "REJECT", "temporal_identity_jump_or_scene_cut"), ({"identity_jump": True}, "REJECT", "temporal_identity_jump_or_scene_cut"),
    ({"vlm_decision": "REJECT", "vlm_confidence": 0.65}, "REJECT", "vlm_reject"), ({"vlm_decision": "DPO_LOSER", "vlm_confidence": 0.6}, "DPO_LOSER", "vlm_dpo_loser;"), ({"vlm_decision": "DPO_LOSER", "static_clip": True}, "DPO_LOSER", "vlm_dpo_loser;static_clip"), ({"vlm_physics_score": 0}, "REJECT", "vlm_zero_task_physics_or_semantic_score"),
    ({"consistency": 0.34}, "WARN", "low_action_video_consistency"), ({"action_energy": 0.05, "visual_energy": 0.1}, "WARN", "action_large_video_static"), ({"transitions": 13, "vlm_task_progress_score": 1}, "WARN", "many_gripper_transitions_low_task_progress"), ({"visual_energy": 2.1, "action_energy": 0.002}, "DPO_LOSER", "visual_motion_large_action_weak"),
    ({"vlm_decision": "WARN"}, "WARN", "vlm_warn_or_low_confidence"), ({"vlm_confidence": 0.54}, "WARN", "vlm_warn_or_low_confidence"), ({"vlm_confidence": 0.55}, "PASS", "ok"),
]


def test_single_pass_ladder(spark):
    df = spark.createDataFrame([{"i": i, **SINGLE, **change} for i, (change, _, _) in enumerate(SINGLES)])
    got = {r.i: (r.decision, r.decision_reason) for r in Q.single_pass_decision(df).collect()}
    assert [got[i] for i in range(len(SINGLES))] == [(d, r) for _, d, r in SINGLES]


def test_metrics(spark):
    df = spark.createDataFrame([("PASS", "PASS", "a"), ("PASS", "REJECT", "a"), ("REJECT", "REJECT", "b"), ("WARN", "PASS", "b")], "p string, h string, g string")
    got = {r.g: r for r in Q.metrics(df, "p", "h", ["g"]).collect()}
    assert (got[None].tp, got[None].fp, got[None].fn, got[None].tn, got[None].n, got[None].accuracy) == (1, 1, 0, 1, 4, 0.5) and got[None].balanced_accuracy == 0.75
    assert (got["b"].pass_recall, got["b"].pass_precision, got["b"].reject_recall) == (0.0, 0.0, 1.0)
    assert Q.metrics(df.where("false"), "p", "h").first().accuracy == 0.0


@pytest.mark.parametrize("rows,want", [([(0.5, 1), (0.9, 1)], 0.5), ([(0.5, 0), (0.6, 0), (0.9, 1)], 0.65), ([(0.7, 0)], 0.7), ([], 0.75), ([(0.2, 1)], 0.75)])
def test_threshold_sweep(spark, rows, want):
    df = spark.createDataFrame(rows, "c double, ok int")
    assert Q.threshold_sweep(df, "c", F.col("ok") == 1).first().threshold == want


def test_crosstab_fills_zeros(spark):
    df = spark.createDataFrame([("a", "X"), ("b", None)], "r string, c string")
    assert sorted(map(tuple, Q.crosstab(df, "r", "c", ["X", "Y", ""]).collect())) == [("a", 1, 0, 0), ("b", 0, 0, 1)]


def test_priority_merge(spark):
    make = lambda rows: spark.createDataFrame(rows, "id int, status string, note string")
    a, b, c = make([(1, "", "x" * 200), (2, "PASS", "")]), make([(1, "WARN", "b"), (3, None, None)]), make([(1, "REJECT", "c"), (4, "PASS", "d")])
    got = {r.id: (r.status, r.source, r.risk) for r in Q.priority_merge([("a", a), ("b", b), ("c", c)], "id", risk=["note"]).collect()}
    assert got == {1: ("WARN", "b", "note=" + "x" * 140 + "; note=b; note=c"), 2: ("PASS", "a", ""), 3: ("", "", ""), 4: ("PASS", "c", "note=d")}


def test_annotations_are_kept(spark):
    fresh = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3), ("s4", 4)], "sample_id string, episode_id int")
    old = spark.createDataFrame([("s1", 1, "PASS", "one", 1), ("s1", 1, "REJECT", "two", 2), ("zz", 2, "PASS", "by episode", 3), ("s3", 3, "", "no label", 4)], "sample_id string, episode_id int, human_label string, note string, row int")
    got = {r.episode_id: (r.human_label, r.note) for r in Q.keep_annotations(fresh, old, ["human_label", "note"]).collect()}
    assert got == {1: ("REJECT", "two"), 2: ("PASS", "by episode"), 3: ("", ""), 4: ("", "")}


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string")
    b = spark.createDataFrame([(1, "z", 5)], "id int, s string, n int")
    assert sorted(map(tuple, Q.left_suffixed(a, b, ["id"], "_rule").collect())) == [(1, "x", "z", 5), (2, "y", None, None)]
    assert Q.left_new_columns(a, b, ["id"]).columns == ["id", "s", "n"]
    assert sorted(map(tuple, Q.update_by_key(a, b, "id", "s").collect())) == [(1, "z"), (2, "y")]
    last = Q.latest(spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "id int, n int, s string"), ["id"], ["n"])
    assert last.first().s == "b"


def test_stand_in_and_selection(spark):
    df = spark.createDataFrame([("True", "pass", ""), ("", "warn", "possible_object_motion_without_contact"), ("", "pass", ""), ("", "reject", ""), ("", "warn", "x")], "hard string, qc_status string, qc_labels string")
    got = [tuple(r) for r in df.select(*Q.stand_in_verdict("hard", "qc_status", "qc_labels").values()).collect()]
    assert got == [("REJECT", 0.95), ("DPO_LOSER_CANDIDATE", 0.72), ("PASS", 0.82), ("WARN_KEEP", 0.65), ("WARN_KEEP", 0.68)]
    marked = df.withColumn("hard_fail_reason", F.lit(""))
    assert Q.selected_for_model(marked).count() == 3 and Q.selected_for_model(marked, False).count() == 5


def test_hard_score_counts_whole_tokens(spark):
    df = spark.createDataFrame([(1, "PASS", 1, 1, "static_clip=False"), (2, "WARN", 2, 2, "static_clip;low_action")], "id int, s string, t int, c int, r string")
    got = {r.id: r.x for r in Q.with_hard_score(df, "s", "t", "c", "r", "x").collect()}
    assert got[1] == pytest.approx(0.6 + 0.75) and got[2] == pytest.approx(5 + 1.2 + 1.5 + 3.5)


def test_flags_and_gates(spark):
    lit = F.lit
    f = Q.motion_flags(lit(0.02), lit(0.2))
    got = spark.range(1).select(f["static_clip"], f["over_motion"], Q.background_flicker(lit(True), lit(0.6), lit(9.0), lit(0.8), lit(0.05)), Q.color_shift(lit(True), lit(5.0), lit(0.5), lit(0.8)), Q.bad_frame(lit(7), lit(9)), Q.export_ready(lit("WARN_KEEP"), lit(1)), Q.normal_label(lit("dpo_loser"))).first()
    assert tuple(got) == (True, False, True, False, True, True, "REJECT")


def test_aggregates(spark):
    df = spark.createDataFrame([("a;b", 1.0, "x"), ("b", 5.0, "y"), (None, float("nan"), "x")], "t string, v double, g string")
    assert [tuple(r) for r in A.token_counts(df, "t").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in A.token_counts(df, "t", first=1).collect()] == [("a", 1), ("b", 1)]
    assert tuple(A.numeric_summary(df, ["v"]).first()) == ("v", 3.0, 3.0, 4.8, 5.0)
    assert sorted(map(tuple, A.histogram(df, "v", 0, 5, 5).collect())) == [(1, 1), (4, 1)]
    assert [tuple(r)[1:] for r in A.fixed_counts(df, "g", ["z", "x"]).orderBy("place").collect()] == [("z", 0), ("x", 2)]
    assert tuple(A.domain_gap(df.where("v > 0 and not isnan(v)"), "g", ["v"], "x", "y").first()) == ("v", 1.0, 5.0, 4.0)
    assert A.union_by_name(df.select("t"), df.select("v")).columns == ["t", "v"]
    assert df.agg(A.robust_max("v"), A.robust_max("v", 0.5)).first() == (5.0, 3.0)
    assert tuple(A.readable_totals(spark.createDataFrame([("a", True), ("a", None)], "s string, r boolean"), "s", "r").first()) == ("a", 2, 1, 1)

"""Quality control: decision ladders, merging of sources, evaluation against people's labels.

Ladders are chains of conditions, the first that holds decides; reasons are joined in the order of the conditions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.functions.expr import col, either, first_match, items, reasons, safe_float, truthy, truthy_wide

# Labels and phrases that decide.
NEGATIVE_LABELS = ["bad_or_black_frames", "background_flicker_candidate", "true_color_shift_candidate", "possible_object_motion_without_contact", "contact_visibility_borderline", "robot_visibility_borderline", "severe_compression_artifacts"]
HARD_TOKENS = ["unreadable", "black_or_bad", "bad_frame", "resolution_invalid", "fps_invalid", "action_shape_invalid", "action_nan", "action_inf"]
ZERO_SCORES = ["robot_visibility", "gripper_contact_visibility", "object_visibility", "physical_plausibility", "temporal_consistency", "visual_quality", "task_relevance", "sft_positive_suitability", "a2v_positive_suitability"]
GOOD_SCORES = ["domain_match", "robot_visibility", "gripper_contact_visibility", "object_visibility", "physical_plausibility", "task_relevance"]
HARD_PHRASES = ["no robot", "robot or gripper is visible", "no gripper", "no object", "not visible in any frame", "blank", "gray", "no manipulation", "no visual content", "missing robot", "wrong_robot_or_missing_robot"]
VISUAL_WORDS = ["flicker", "color shift", "exposure", "visual artifact", "compression"]
HARD_FLAGS = ["wrong_robot_or_missing_robot", "critical_contact_invisible", "object_moves_without_contact"]
PHYSICAL_FLAGS = [*HARD_FLAGS, "prompt_action_mismatch"]
HARD_SCORE_TOKENS = {"static_clip": 2.0, "over_motion": 2.0, "low_action": 1.5, "hard_fail": 2.0, "contact_region_visible_ratio=0": 1.0, "robot_visible_ratio=0": 1.0}
RISKY_STATUSES = ["WARN", "REJECT", "DPO_LOSER", "DPO_LOSER_CANDIDATE", "NEED_HUMAN_REVIEW"]


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(False))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(True))


def mentions(text: Column, parts: list[str]) -> Column:
    return any_of(*(F.contains(text, F.lit(p)) for p in parts))


# ---- rule check (D-1, D-4) ------------------------------------------------------------------------------


def bad_frame(brightness: Column | str, deviation: Column | str) -> Column:
    return (col(brightness) < 8) | (col(brightness) > 248) | (col(deviation) < 2)


def rule_check(df: DataFrame) -> DataFrame:
    """Adds ``hard_fail_reason``, ``qc_labels``, ``qc_status`` and ``qc_reason`` to rows of clip metrics.

    Columns read: frames, read_fails, bad_ratio, width, height, fps, action_ok, has_nan, has_inf, background_flicker,
    color_shift, rgb_step, luma_step, bg_luma, bg_color, fg_step, contact_score, motion_ratio, contact_visible, robot_visible,
    blockiness, sharpness, dpo_score.
    """
    c = F.col
    hard = reasons(
        (c("read_fails") > F.greatest(F.lit(2), F.floor(c("frames") / 4)), "many_sample_frames_failed"), (c("bad_ratio") > 0.30, "black_or_bad_frames"),
        ((c("width") > 0) & (c("height") > 0) & ~((c("width") == 640) & (c("height") == 480)), "resolution_invalid"), ((c("fps") > 0) & (F.abs(c("fps") - 24) > 2.5), "fps_invalid"),
        (~c("action_ok"), "invalid_action_shape_or_values"), (c("has_nan"), "action_nan"), (c("has_inf"), "action_inf"),
    )
    step = ((c("rgb_step") > 35) | (c("luma_step") > 18)) & (c("bg_luma") < 6) & (c("bg_color") < 5)
    labels = reasons(
        ((c("bad_ratio") > 0.08) & (c("bad_ratio") <= 0.30), "bad_or_black_frames"), (c("background_flicker"), "background_flicker_candidate"), (c("color_shift"), "true_color_shift_candidate"),
        (step, "content_motion_not_flicker"), (step & (c("fg_step") > 0.045), "foreground_entry_caused_global_shift"), (c("contact_score") > 0.70, "possible_object_motion_without_contact"),
        (~(c("contact_score") > 0.70) & (c("motion_ratio") > 0.12) & (c("contact_visible") < 0.12), "contact_visibility_borderline"),
        ((c("robot_visible") < 0.08) & (c("motion_ratio") > 0.08), "robot_visibility_borderline"), ((c("blockiness") > 45) & (c("sharpness") < 25), "severe_compression_artifacts"),
    )
    out = df.withColumns({"hard_fail_reason": hard, "qc_labels": labels})
    listed = items("qc_labels")
    negative = F.size(F.array_intersect(listed, F.array(*map(F.lit, NEGATIVE_LABELS)))) > 0
    loser = F.array_contains(listed, "possible_object_motion_without_contact") & (c("dpo_score") > 0.80)
    status = first_match([(c("hard_fail_reason") != "", F.lit("reject")), (loser, F.lit("dpo_loser_candidate")), (negative, F.lit("warn"))], F.lit("pass"))
    return out.withColumns({"qc_status": status, "qc_reason": F.coalesce(F.nullif("hard_fail_reason", F.lit("")), F.nullif("qc_labels", F.lit("")), F.lit("ok"))})


def background_flicker(reliable: Column, changed: Column, score: Column, sign: Column, foreground: Column) -> Column:
    return all_of(reliable, changed > 0.55, score > 8, sign > 0.75, foreground < 0.10)


def color_shift(reliable: Column, score: Column, changed: Column, direction: Column) -> Column:
    return all_of(reliable, score > 6, changed > 0.45, direction > 0.70)


# ---- rule and model (D-2, D-8) --------------------------------------------------------------------------


def _flag(name: str) -> Column:
    return F.lower(F.col(f"flag_{name}").cast("string")) == "true"


def merge_rule_and_model(df: DataFrame) -> DataFrame:
    """Adds ``final_decision``, ``final_reason`` and ``is_conflict`` to rule columns joined with a flat verdict.

    A row without a verdict counts as NEED_HUMAN_REVIEW with confidence 0, and so ends as WARN_KEEP unless it fails hard.
    """
    c = F.col
    rule = F.lower(F.coalesce(c("qc_status"), F.lit("")))
    vlm = F.upper(F.coalesce(c("vlm_decision"), F.lit("NEED_HUMAN_REVIEW")))
    conf = safe_float("vlm_confidence", 0.0)
    why = F.lower(either("hard_fail_reason", "qc_reason"))
    hard = any_of(truthy_wide("deterministic_hard_fail"), F.lower(F.coalesce(c("video_readable").cast("string"), F.lit("true"))) == "false", mentions(why, HARD_TOKENS))
    evidence = F.lower(F.coalesce(c("vlm_evidence"), F.lit("")))
    zeros = reduce(lambda a, b: a + b, ((safe_float(f"score_{k}", 1.0) <= 0).cast("int") for k in ZERO_SCORES))
    obvious = (vlm == "REJECT") & any_of(zeros >= 6, *(_flag(f) for f in HARD_FLAGS), mentions(evidence, HARD_PHRASES))
    good = all_of(*(safe_float(f"score_{k}", 0.0) >= 2 for k in GOOD_SCORES))
    visual = any_of(_flag("severe_flicker_or_exposure_jump"), _flag("severe_noise_or_compression"))
    artifact = (vlm == "REJECT") & good & visual & mentions(evidence, VISUAL_WORDS) & ~any_of(*(_flag(f) for f in PHYSICAL_FLAGS))
    reject = (vlm == "REJECT") & (conf >= 0.75)
    conflict = ((rule == "reject") & (vlm == "PASS") & (conf >= 0.75)) | ((rule == "pass") & reject & ~obvious & ~artifact)
    ladder = [
        (hard, "REJECT", "deterministic_hard_fail"), (artifact, "WARN_KEEP", "vlm_visual_artifact_only_warn_keep"), (obvious, "REJECT", "vlm_obvious_visual_hard_reject"),
        (conflict, "NEED_HUMAN_REVIEW", "rule_vlm_conflict"), (reject, "REJECT", "vlm_reject_confident"), ((vlm == "DPO_LOSER_CANDIDATE") & (conf >= 0.70), "DPO_LOSER_CANDIDATE", "vlm_dpo_loser_confident"),
        (vlm == "PASS", "PASS", "vlm_pass_no_hard_fail"), ((vlm == "WARN_KEEP") | (conf < 0.75), "WARN_KEEP", "vlm_warn_or_low_confidence"),
    ]
    return df.withColumns({
        "final_decision": first_match([(k, F.lit(d)) for k, d, _ in ladder], F.lit("NEED_HUMAN_REVIEW")),
        "final_reason": first_match([(k, F.lit(r)) for k, _, r in ladder], F.lit("unhandled_vlm_decision")),
        "is_conflict": conflict & (hard | ~(artifact | obvious)),
    })


def stand_in_verdict(hard: Column | str, status: Column | str, labels: Column | str) -> dict[str, Column]:
    """Decision and confidence that follow from the rule check alone, for runs without a model."""
    s = F.lower(col(status))
    loser = F.array_contains(items(labels), "possible_object_motion_without_contact")
    cases = [(truthy(hard), "REJECT", 0.95), (loser, "DPO_LOSER_CANDIDATE", 0.72), (s == "pass", "PASS", 0.82), (s == "reject", "WARN_KEEP", 0.65)]
    return {"vlm_decision": first_match([(k, F.lit(d)) for k, d, _ in cases], F.lit("WARN_KEEP")), "vlm_confidence": first_match([(k, F.lit(x)) for k, _, x in cases], F.lit(0.68))}


def selected_for_model(df: DataFrame, only_borderline: bool = True) -> DataFrame:
    """Rows the model shall see: warned, rejected, labelled or failed hard; all rows if not only borderline ones."""
    border = any_of(F.lower("qc_status").isin("warn", "reject"), F.coalesce("qc_labels", F.lit("")) != "", F.coalesce("hard_fail_reason", F.lit("")) != "")
    return df.where(border) if only_borderline else df


# ---- single pass (D-3) ----------------------------------------------------------------------------------


def motion_flags(active: Column | str, energy: Column | str) -> dict[str, Column]:
    a, e = col(active), col(energy)
    return {"static_clip": (a < 0.03) & (e < 0.25), "over_motion": (a > 0.90) & (e > 18)}


def single_pass_decision(df: DataFrame) -> DataFrame:
    """Adds ``decision`` and ``decision_reason``. Columns read: hard_pass, hard_reason, static_clip, over_motion, duplicate_ratio, scene_cut,
    identity_jump, the short verdict's, consistency, action_energy, visual_energy, transitions."""
    c = F.col
    vlm, conf = c("vlm_decision"), c("vlm_confidence")
    cut = (c("scene_cut") > 0.55) | c("identity_jump")
    early = [(c("static_clip"), "static_clip"), (c("over_motion"), "over_motion_clip"), (c("duplicate_ratio") > 0.65, "large_duplicate_frame_ratio"), (cut, "temporal_identity_jump_or_scene_cut"), ((vlm == "REJECT") & (conf >= 0.65), "vlm_reject")]
    zero = any_of(c("vlm_task_progress_score") == 0, c("vlm_physics_score") == 0, c("vlm_semantic_consistency_score") == 0)
    late = [(zero, "vlm_zero_task_physics_or_semantic_score"), (c("consistency") < 0.35, "low_action_video_consistency"), ((c("action_energy") > 0.04) & (c("visual_energy") < 0.20), "action_large_video_static"), ((c("transitions") > 12) & (c("vlm_task_progress_score") <= 1), "many_gripper_transitions_low_task_progress")]
    first, both = reasons(*early), reasons(*early, *late)
    loser, moving = (vlm == "DPO_LOSER") & (conf >= 0.60), (c("visual_energy") > 2) & (c("action_energy") < 0.003)
    severe = any_of(*(k for k, name in early if name != "large_duplicate_frame_ratio"), zero)
    why = [
        (~c("hard_pass"), F.lit("REJECT"), c("hard_reason")), (loser, F.lit("DPO_LOSER"), F.concat(F.lit("vlm_dpo_loser;"), first)),
        (moving, F.lit("DPO_LOSER"), F.lit("visual_motion_large_action_weak")), (severe, F.lit("REJECT"), both), (both != "", F.lit("WARN"), both),
        ((vlm == "WARN") | (conf < 0.55), F.lit("WARN"), F.lit("vlm_warn_or_low_confidence")),
    ]
    return df.withColumns({"decision": first_match([(k, d) for k, d, _ in why], F.lit("PASS")), "decision_reason": first_match([(k, r) for k, _, r in why], F.lit("ok"))})


# ---- joins of sources (J4-J7, J9, J10, J14) -------------------------------------------------------------


def latest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key in the given order, which has to be total."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(o) if isinstance(o, str) else o.desc() for o in order))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def left_suffixed(left: DataFrame, right: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """Left join; columns of the right that the left has too get the suffix."""
    named = right.select(*keys, *(F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns if c not in keys))
    return left.join(named, keys, "left")


def left_new_columns(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys, *(c for c in right.columns if c not in left.columns)), keys, "left")


def with_verdict(df: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    out = left_new_columns(df, verdicts, keys)
    return out.withColumns({"vlm_decision": F.coalesce("vlm_decision", F.lit("NEED_HUMAN_REVIEW")), "vlm_confidence": F.coalesce("vlm_confidence", F.lit(0.0))})


def priority_merge(sources: list[tuple[str, DataFrame]], key: str, status: str = "status", risk: list[str] | None = None) -> DataFrame:
    """One row a key over several sources, the first in the list first: its first non-empty status, and risk texts of all
    (at most seven columns a source, 140 characters each, 1600 in total). Sources hold a key once."""
    risk = (risk or [])[:7]
    parts = []
    for n, (name, df) in enumerate(sources):
        bits = [F.when(F.coalesce(F.col(r).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{r}="), F.substring(F.col(r).cast("string"), 1, 140))) for r in risk if r in df.columns]
        parts.append(df.select(key, F.lit(n).alias("p"), F.lit(name).alias("source"), F.nullif(F.col(status), F.lit("")).alias("s"), F.concat_ws("; ", *bits).alias("r")))
    rows = reduce(DataFrame.unionAll, parts)
    found = rows.groupBy(key).agg(F.min(F.when(F.col("s").isNotNull(), F.struct("p", "s", "source"))).alias("best"), F.array_sort(F.collect_list(F.when(F.col("r") != "", F.struct("p", "r")))).alias("all"))
    text = F.substring(F.array_join(F.transform("all", lambda x: x["r"]), "; "), 1, 1600)
    return found.select(key, F.coalesce(F.col("best.s"), F.lit("")).alias("status"), F.coalesce(F.col("best.source"), F.lit("")).alias("source"), text.alias("risk"))


def keep_annotations(fresh: DataFrame, old: DataFrame, fields: list[str], label: str = "human_label", order: list[str] | None = None) -> DataFrame:
    """Labels of an earlier table on a fresh one: by sample and episode, else by episode; the last labelled row counts."""
    order = order or ["row"]
    marked = old.where(F.coalesce(label, F.lit("")) != "")
    exact = latest(marked, ["sample_id", "episode_id"], order).select("sample_id", "episode_id", *(F.col(f).alias(f"__e_{f}") for f in fields), F.lit(1).alias("__e"))
    loose = latest(marked, ["episode_id"], order).select("episode_id", *(F.col(f).alias(f"__l_{f}") for f in fields), F.lit(1).alias("__l"))
    both = fresh.drop(*fields).join(exact, ["sample_id", "episode_id"], "left").join(loose, "episode_id", "left")
    got = {f: F.when(F.col("__e") == 1, F.coalesce(f"__e_{f}", F.lit(""))).when(F.col("__l") == 1, F.coalesce(f"__l_{f}", F.lit(""))).otherwise(F.lit("")) for f in fields}
    return both.withColumns(got).select(*(c for c in fresh.columns if c not in fields), *fields)


def update_by_key(table: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    new = updates.select(key, F.col(column).alias("__new"))
    return table.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def attach_by_index(table: DataFrame, scores: DataFrame, index: str, fields: list[str]) -> DataFrame:
    """The table with the fields of the scores at the same index; fields that the scores lack are null."""
    there = [f for f in fields if f in scores.columns]
    both = table.drop(*fields).join(scores.select(index, *there), index, "left")
    return both.withColumns({f: F.lit(None).cast("string") for f in fields if f not in there}).select(*(c for c in table.columns if c not in fields), *fields)


# ---- evaluation (A6-A9, F14) ----------------------------------------------------------------------------


def normal_label(c: Column | str) -> Column:
    up = F.upper(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.when(up == "PASS", "PASS").when(up.isin("REJECT", "DPO_LOSER", "DPO_LOSER_CANDIDATE"), "REJECT").otherwise("WARN")


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of each pair, zeros included; ``values`` are the column labels, nulls count as ''."""
    return df.groupBy(rows).agg(*(F.count_if(F.coalesce(F.col(columns).cast("string"), F.lit("")) == v).alias(v) for v in values))


def metrics(df: DataFrame, predicted: str, human: str, by: list[str] | None = None) -> DataFrame:
    """Counts and rates of PASS against REJECT over all rows, and for each group in ``by`` (one pass)."""
    p, h = F.col(predicted), F.col(human)
    both = lambda a, b: F.count_if((p == a) & (h == b))
    grouped = df.groupingSets([[], [F.col(b) for b in by]], *(F.col(b) for b in by)) if by else df.groupBy()
    out = grouped.agg(both("PASS", "PASS").alias("tp"), both("PASS", "REJECT").alias("fp"), both("REJECT", "PASS").alias("fn"), both("REJECT", "REJECT").alias("tn"), F.count("*").alias("n"))
    rate = lambda a, *b: F.col(a) / F.greatest(reduce(lambda x, y: x + y, map(F.col, b)), F.lit(1))
    out = out.withColumns({"accuracy": (F.col("tp") + F.col("tn")) / F.greatest("n", F.lit(1)), "pass_precision": rate("tp", "tp", "fp"), "pass_recall": rate("tp", "tp", "fn"), "reject_precision": rate("tn", "tn", "fn"), "reject_recall": rate("tn", "tn", "fp")})
    return out.withColumn("balanced_accuracy", (F.col("pass_recall") + F.col("reject_recall")) / 2)


def threshold_sweep(df: DataFrame, confidence: str, correct: Column, goal: float = 0.8, default: float = 0.75) -> DataFrame:
    """One row ``threshold``: of 0.50, 0.55, ... 0.95 the first with a precision of ``goal``, else the last with any rows, else the default."""
    grid = F.transform(F.sequence(F.lit(50), F.lit(95), F.lit(5)), lambda i: i / 100)
    rows = df.select(F.col(confidence).alias("c"), correct.cast("double").alias("ok"), F.explode(grid).alias("t"))
    each = rows.where(F.col("c") >= F.col("t")).groupBy("t").agg(F.avg("ok").alias("precision"))
    return each.agg(F.coalesce(F.min(F.when(F.col("precision") >= goal, F.col("t"))), F.max("t"), F.lit(default)).alias("threshold"))


def confusion_cases(df: DataFrame, predicted: str, human: str, confidence: str) -> dict[str, DataFrame]:
    p, h = F.col(predicted), F.col(human)
    return {"false_pass": df.where((p == "PASS") & (h == "REJECT")), "false_reject": df.where((p == "REJECT") & (h == "PASS")), "low_confidence": df.where(safe_float(confidence, 0.0) <= 1)}


def with_hard_score(df: DataFrame, status: str, t: str, c: str, risk: str, name: str = "hard_score") -> DataFrame:
    """Adds how much a row is worth a person's look. Tokens count as whole items of the risk text, not as parts of words."""
    from tracklode.operators.sampling import percent_ranks

    listed = F.transform(items(risk), lambda x: F.lower(x))
    points = reduce(lambda a, b: a + b, (F.when(F.array_contains(listed, token), w).otherwise(0.0) for token, w in HARD_SCORE_TOKENS.items()))
    rows = percent_ranks(percent_ranks(df, t, "__t"), c, "__c")
    score = F.when(F.col(status).isin(*RISKY_STATUSES), 5.0).otherwise(0.0) + 1.2 * F.col("__t") + 1.5 * F.col("__c") + points
    return rows.withColumn(name, score).select(*df.columns, name)


# ---- exports (F6, D-5, D-7, H8, X45) --------------------------------------------------------------------


def accepted(flag: str, fallback: str = "success") -> Column:
    return truthy(F.coalesce(F.col(flag), F.col(fallback)))


def export_ready(decision: Column | str, score: Column | str) -> Column:
    d = col(decision)
    return (d == "PASS") | ((d == "WARN_KEEP") & (col(score) >= 1))


def review_slices(labels: Column | str, names: list[str]) -> dict[str, Column]:
    return {n: F.array_contains(items(labels), n) for n in names}

"""Episode manifests: index of files, joins across modalities, eligibility, exports and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklode.functions.expr import col, either, first_match, number, truthy
from tracklode.operators.qc import accepted, export_ready

# Inference modes by policy, risky policies and their labels, robot names.
MODES = {
    "SAME_ACTION_OK": "action_driven_original_hdf5", "ACTION_MAYBE_OK": "action_driven_original_or_retrieved_hdf5",
    "TARGET_CHANGED": "action_retrieval_or_robotwin_replan", "VERB_CHANGED": "action_retrieval_or_robotwin_replan",
    "AMBIGUOUS": "manual_review_or_text_driven_fallback",
}
SECOND_STAGE_MODES = MODES | {"AMBIGUOUS": "second_stage_review_or_text_fallback"}
RISKY = ("VERB_CHANGED", "TARGET_CHANGED", "AMBIGUOUS")
ALIASES = {"ur5-wsg": "ur5-wsg", "UR5-Wsg": "ur5-wsg", "UR5-WSG": "ur5-wsg", "arx-x5": "ARX-X5", "ARX-X5": "ARX-X5", "aloha-agilex": "aloha-agilex", "piper": "piper", "franka-panda": "franka-panda"}
BARRED = "franka-panda"
DENOISERS = ("", "none", "null", "false", "oidn", "optix")


def path_parts(path: Column | str, root: str = "") -> dict[str, Column]:
    """``task_name`` and ``task_level`` of a relative path: the folder of the file and the folders above it."""
    rel = F.regexp_replace(col(path), "^" + root.rstrip("/") + "/", "") if root else col(path)
    parts = F.split(F.regexp_replace(rel, "^/+", ""), "/")
    alone = F.size(parts) <= 1
    return {"task_name": F.when(alone, ".").otherwise(F.element_at(parts, -2)), "task_level": F.when(alone, "none").otherwise(F.concat_ws("/", F.lit("root"), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))))}


def episode_index(files: DataFrame, modalities: dict[str, str], dataset: str = "dataset", path: str = "path") -> DataFrame:
    """One row an episode with the path of each modality: files ``.../<modality folder>/.../episode<N>.<suffix>``.

    Names that are no episode's are left out; of several paths the last in order counts.
    """
    kinds = F
    for name, folder in modalities.items():
        kinds = kinds.when(F.contains(F.col(path), F.lit(f"/{folder}/")), F.lit(name))
    found = files.withColumns({"modality": kinds, "episode_id": F.regexp_extract(F.col(path), r"(?:^|/)episode(\d+)\.[^/.]+$", 1).try_cast("int")}).where(F.col("episode_id").isNotNull() & F.col("modality").isNotNull())
    return found.groupBy(dataset, "episode_id").agg(*(F.max(F.when(F.col("modality") == m, F.col(path))).alias(f"{m}_path") for m in modalities))


def cross_table(semantics: DataFrame, actions: DataFrame, visuals: DataFrame, policies: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of three tables, with the policies of the first and second variant next to them.

    Right sides hold a key once (the last row of ``order`` counts elsewhere); policies add no keys.
    """
    pivot = policies.groupBy(*keys).agg(*(F.max(F.when((F.col("comparison") == "variant_1") == F.lit(n == 1), F.col("policy"))).alias(f"policy_{n}") for n in (1, 2)))
    return semantics.join(actions, keys, "full").join(visuals, keys, "full").join(pivot, keys, "left")


def inference_mode(policy: Column | str, modes: dict[str, str] = MODES) -> Column:
    """The mode of a policy; no policy counts as AMBIGUOUS, an unknown one has none."""
    p = F.coalesce(col(policy), F.lit("AMBIGUOUS"))
    return first_match([(p == k, F.lit(m)) for k, m in modes.items()], F.lit(None))


def dpo_type(first: Column | str, second: Column | str) -> Column:
    """Kind of preference pair by how many of two policies are risky."""
    risky = lambda c: F.coalesce(col(c).isin(*RISKY), F.lit(False)).cast("int")
    n = risky(first) + risky(second)
    return first_match([(n == 2, F.lit("hard_negative_prompt_action_mismatch")), (n == 1, F.lit("mixed_policy_pair"))], F.lit("same_action_preference_pair"))


def stratum_weights(family: Column | str, edge: Column | str, brightness: Column | str, complexity: Column | str, arm: Column | str) -> dict[str, Column]:
    """Sampling weights for the two kinds of training; missing figures count as 0."""
    b, e, c = (F.coalesce(number(x), F.lit(0.0)) for x in (brightness, edge, complexity))
    sft = F.when(F.coalesce(col(family), F.lit("unknown")) == "unknown", 0.7).otherwise(1.0) * F.when(e > 0.12, 1.1).otherwise(1.0) * F.when((b < 45) | (b > 210), 0.85).otherwise(1.0)
    a2v = 1 + F.least(c / 10, F.lit(0.8)) + F.when(col(arm) == "balanced", 0.15).otherwise(0.0)
    return {"sft_weight": F.round(sft, 4), "a2v_weight": F.round(a2v, 4)}


def embodiment(c: Column | str, aliases: dict[str, str] = ALIASES) -> Column:
    """The robot's usual name: by alias, then by alias without spaces at the ends, else as it is without them."""
    raw = F.coalesce(col(c), F.lit(""))
    exact = [(raw == k, F.lit(v)) for k, v in aliases.items()]
    return first_match([*exact, *((F.trim(raw) == k, F.lit(v)) for k, v in aliases.items())], F.trim(raw))


def eligible(df: DataFrame, flag: str, allowed: list[str], needed: str = "dual_arm_joint14_valid") -> DataFrame:
    """Rows that may train: accepted, with a video, of an allowed robot, and flagged as valid."""
    robots = [a for a in allowed if a != BARRED]
    return df.where(accepted(flag) & (either("video_path") != "") & embodiment("embodiment").isin(*robots) & F.contains(F.coalesce("quality_flags", F.lit("")), F.lit(needed)))


def stats_input(df: DataFrame, flag: str = "accepted_for_sft", split: str = "train", path: str = "action_joint14_path") -> DataFrame:
    return df.where(truthy(flag) & (F.col("split") == split) & (either(path) != ""))


def export_sft(df: DataFrame, style: Column, templates: dict[str, Column]) -> DataFrame:
    """``video, prompt`` of each row, the prompt in its style."""
    prompt = first_match([(style == n, t) for n, t in templates.items()], F.col("prompt"))
    return df.select(F.col("video_path").alias("video"), prompt.alias("prompt"))


def export_a2v(df: DataFrame, representations: list[str], decision: str, score: str) -> DataFrame:
    """One row for each representation whose path is there, of rows that passed or were kept with a score."""
    ready = df.where(export_ready(decision, score))
    kinds = F.array(*(F.struct(F.lit(r).alias("representation"), F.col(r).alias("action_path")) for r in representations))
    return ready.select("*", F.inline(kinds)).where(F.coalesce("action_path", F.lit("")) != "")


def rejected_pairs(df: DataFrame, label: str = "hard_negative_prompt_action_mismatch", limit: int = 100, order: str = "episode_id") -> DataFrame:
    return df.where(F.contains(F.coalesce("quality_flags", F.lit("")), F.lit(label))).orderBy(order).limit(limit)


def validator_report(df: DataFrame, status: str, flags: list[str]) -> DataFrame:
    """Share of passes, whether training is blocked (under 0.9), and counts of accepted rows."""
    passed = F.avg((F.col(status) == "PASS").cast("double"))
    return df.agg(F.count("*").alias("n"), F.round(passed, 6).alias("pass_rate"), F.coalesce(passed < 0.9, F.lit(True)).alias("block_training"), *(F.count_if(truthy(f)).alias(f"n_{f}") for f in flags))


def coverage(df: DataFrame, by: str, expected: dict[str, int]) -> DataFrame:
    """Rows of each manifest against what is expected; manifests that are not there have 0."""
    dim = df.sparkSession.createDataFrame(list(expected.items()), "name string, expected long")
    got = df.groupBy(F.col(by).alias("name")).agg(F.count("*").alias("n"))
    return dim.join(got, "name", "left").select("name", "expected", F.coalesce("n", F.lit(0)).alias("n")).withColumn("covered", F.col("n") == F.col("expected"))


def missing_references(df: DataFrame, paths: list[str], listing: DataFrame) -> DataFrame:
    """Per path column, how many rows name a file that is not listed; empty paths are not counted."""
    long = df.select(F.inline(F.array(*(F.struct(F.lit(p).alias("field"), F.col(p).cast("string").alias("path")) for p in paths)))).where(F.coalesce("path", F.lit("")) != "")
    known = listing.select(F.col("path").cast("string").alias("path")).distinct().withColumn("there", F.lit(1))
    return long.join(known, "path", "left").groupBy("field").agg(F.count("*").alias("n"), F.count_if(F.col("there").isNull()).alias("missing"))


def available_and_missing(tasks: DataFrame, available: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return tasks.join(available.select(key), key, "left_semi"), tasks.join(available.select(key), key, "left_anti")


def resume(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def best_video(candidates: DataFrame, key: str, least_frames: int = 12) -> DataFrame:
    """Of each key's readable videos with enough frames the largest, then the longest, then the last by path."""
    ok = candidates.where(F.col("readable") & (F.col("frames") >= least_frames))
    best = F.max_by("path", F.struct(F.col("width") * F.col("height"), F.col("duration"), F.col("path")))
    return ok.groupBy(key).agg(best.alias("path"))


def library_union(simulated: DataFrame, benchmark: DataFrame) -> DataFrame:
    a = simulated.withColumns({"training_allowed": F.lit(True), "inference_only": F.lit(False)})
    return a.unionByName(benchmark.withColumns({"training_allowed": F.lit(False), "inference_only": F.lit(True)}), allowMissingColumns=True)


def config_faults(df: DataFrame, limits: dict[str, float]) -> Column:
    """Names of settings outside 0..limit, and of samples, depth and denoiser that are not allowed."""
    from tracklode.functions.expr import reasons

    out = [(number(c).isNull() | (number(c) < 0) | (number(c) > m), c) for c, m in limits.items()]
    out += [(~number("spp").between(1, 512), "spp"), (~number("depth").between(1, 32), "depth"), (~F.lower(F.coalesce("denoiser", F.lit(""))).isin(*DENOISERS), "denoiser")]
    return reasons(*((F.coalesce(k, F.lit(True)), n) for k, n in out))


def label_filters(unlabelled: bool = False, **equal: str | None) -> Column:
    """Conditions of a review screen, all of which must hold; None means any."""
    out = F.coalesce("human_label", F.lit("")) == "" if unlabelled else F.lit(True)
    for c, v in equal.items():
        if v is not None:
            out = out & (F.coalesce(F.col(c).cast("string"), F.lit("")) == v)
    return out


def reference_frame_path(root: str, split: Column | str, episode: Column | str, task: str = "fixed_scene_task") -> Column:
    return F.format_string("%s/%s/first_frame/%s/episode%d.png", F.lit(root), col(split), F.lit(task), col(episode))


def with_text_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds columns that are missing, as empty texts."""
    return df.withColumns({n: F.lit("") for n in names if n not in df.columns})


def first_overlay(files: DataFrame, folder: str, path: str, names: list[str]) -> DataFrame:
    """Of each folder's files the one whose name comes first in the list."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    place = F.array_position(F.array(*map(F.lit, names)), name)
    return files.withColumn("__p", place).where("__p > 0").groupBy(folder).agg(F.min_by(path, "__p").alias("overlay"))


def training_source(manifest: DataFrame, scored: DataFrame | None, source: str) -> DataFrame:
    """The table that exports read: the manifest, or the table with final decisions, which then has to be there."""
    if source == "manifest":
        return manifest
    if scored is None:
        raise FileNotFoundError("the scored table is missing")
    return scored


def final_table(manifest: DataFrame, scores: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Inner join of the manifest with the last score of each key."""
    from tracklode.operators.qc import latest

    return manifest.join(latest(scores, keys, order), keys)

"""Prompt semantics: rule-based parsing, similarity of prompt pairs, tolerant JSON."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklode.functions.expr import clamp, col, first_match, items, jaccard, joined, number, unique_in_order
from tracklode.functions.lexicon import OBJECT_HINTS, PREFIXES, ROBOT, TARGET_HINTS, Lexicon

# ---- single prompts -------------------------------------------------------------------------------------


def core_text(c: Column | str) -> Column:
    """The prompt without its fixed opening."""
    out = F.coalesce(col(c), F.lit(""))
    for pattern in PREFIXES:
        out = F.trim(F.regexp_replace(out, pattern, ""))
    return out


def word_pattern(alternatives: list[str]) -> str:
    """Any of the words, bounded by what is no letter, digit or underscore in any script."""
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(map(re.escape, alternatives)) + r")([^\p{L}\p{N}_]|$)"


def words_of(text: Column) -> Column:
    """The distinct words of a text: runs of letters, digits and underscores of any script."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"), 1))


def found_aliases(text: Column, aliases: dict[str, list[str]], found: Column | None = None) -> Column:
    """Canonical words one of whose aliases occurs, in the order of the table.

    Aliases of one word are looked up among the text's words (``found``, if they are at hand), all by one intersection;
    only phrases take a pattern each.
    """
    found = words_of(text) if found is None else found
    single = {n: [a for a in many if re.fullmatch(r"\w+", a)] for n, many in aliases.items()}
    phrases = {n: [a for a in many if a not in single[n]] for n, many in aliases.items()}
    known = list(dict.fromkeys(a for many in single.values() for a in many))
    # the words of the table that occur, then the names that they or phrases stand for
    hits = F.array_intersect(F.array(*map(F.lit, known)), found) if known else F.array().cast("array<string>")

    def named(hit: Column) -> Column:
        def one(name: str) -> Column:
            tests = ([F.arrays_overlap(hit, F.array(*map(F.lit, single[name])))] if single[name] else []) + ([F.rlike(text, F.lit(word_pattern(phrases[name])))] if phrases[name] else [])
            return F.when(tests[0] | tests[1] if len(tests) > 1 else tests[0], F.lit(name))

        return F.array_compact(F.array(*map(one, aliases)))

    if not any(phrases.values()) and all(many == [name] for name, many in aliases.items()):
        return hits  # names are their own aliases
    return F.transform(F.array(hits), named)[0]  # a variable of the lambda, so that the intersection is made once


def found_keywords(text: Column, keywords: list[str], most: int | None = None, found: Column | None = None) -> Column:
    out = found_aliases(text, {k.lower(): [k.lower()] for k in dict.fromkeys(keywords)}, found)
    return F.slice(out, 1, most) if most else out


# Fixed value: what a noun phrase begins and ends at.
NOUN_PHRASE = r"\b(?:the|a|an)\s+([a-z0-9\- ]{2,80}?)(?=\s+(?:with|using|by|into|in|on|under|beneath|behind|beside|near|from|to|and|then|,|\.|$))"


def noun_phrases(text: Column, stop_words: list[str]) -> Column:
    """Phrases after an article up to a preposition, conjunction or full stop: the last four words that carry meaning."""
    stops = F.array(*map(F.lit, stop_words))
    raw = F.regexp_extract_all(F.lower(text), F.lit(NOUN_PHRASE), 1)
    kept = F.transform(raw, lambda p: F.filter(F.split(F.trim(p), r"\s+"), lambda w: (w != "") & ~F.array_contains(stops, w)))
    last = F.transform(F.filter(kept, lambda t: F.size(t) > 0), lambda t: F.array_join(F.slice(t, -F.least(F.size(t), F.lit(4)), 4), " "))
    return unique_in_order(last)


def contains_any(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.contains(text, F.lit(p))
    return out


def task_family(text: Column, verbs: Column, objects: Column, families) -> Column:
    hay = F.concat_ws(" ", F.lower(text), F.array_join(verbs, " "), F.array_join(objects, " "))
    return first_match([(contains_any(hay, p), F.lit(name)) for name, p in families], F.lit("unknown"))


def interaction_type(text: Column, interactions) -> Column:
    return first_match([(contains_any(F.lower(text), p), F.lit(name)) for name, p in interactions], F.lit("unknown"))


def _points(*cases: tuple[Column, float], start: float = 0.0, most: float = 1.0) -> Column:
    total = F.lit(start)
    for condition, value in cases:
        total = total + F.when(condition, value).otherwise(0.0)
    return F.least(total, F.lit(most))


def bimanual_score(text: Column, lexicon: Lexicon = ROBOT) -> Column:
    low = F.lower(text)
    each = F.lit(True)
    for p in lexicon.each_hand:
        each = each & F.contains(low, F.lit(p))
    return _points((contains_any(low, lexicon.both_hands), 0.7), (each, 0.8), (contains_any(low, lexicon.other_hand), 0.4))


def articulated_score(text: Column, verbs: Column, lexicon: Lexicon = ROBOT) -> Column:
    hinging = F.lit(False)
    for v in lexicon.hinging:
        hinging = hinging | F.array_contains(verbs, v)
    return _points((contains_any(F.lower(text), lexicon.hinged), 0.65), (hinging, 0.35))


def difficulty_score(text: Column, verbs: Column, spatial: Column, bimanual: Column, articulated: Column) -> Column:
    total = 1.0 + F.least(F.size(verbs), F.lit(5)) * 0.45 + F.least(F.size(spatial), F.lit(6)) * 0.22 + bimanual * 1.2 + articulated * 0.8
    total = total + F.when(F.length(text) > 260, 0.6).otherwise(0.0) + F.when(F.length(text) > 420, 0.6).otherwise(0.0)
    return F.round(F.least(total, F.lit(5.0)), 4)


def parse_confidence(family: Column, verbs: Column, objects: Column, text: Column) -> Column:
    return _points((family != "unknown", 0.25), (F.size(verbs) > 0, 0.2), (F.size(objects) > 0, 0.15), (F.length(text) > 20, 0.05), start=0.35)


def prompt_semantics(prompts: DataFrame, text: str = "raw_prompt", lexicon: Lexicon = ROBOT, phrases: bool = True) -> DataFrame:
    """The prompts with their parsed fields. Null prompts count as empty."""
    base = prompts.withColumn("prefix_removed_prompt", core_text(text))
    core = F.col("prefix_removed_prompt")
    low = F.lower(core)
    base, found = base.withColumn("__words", words_of(low)), F.col("__words")
    nouns = noun_phrases(core, lexicon.stop_words) if phrases else F.array().cast("array<string>")
    base = base.withColumns({
        "main_verbs": found_aliases(low, lexicon.verbs, found),
        "main_objects": F.slice(F.array_distinct(F.concat(found_keywords(low, lexicon.objects, found=found), nouns)), 1, 20),
        "receptacles_or_targets": found_keywords(low, lexicon.receptacles, 15, found),
        "spatial_relations": found_keywords(low, lexicon.spatial, 15, found),
    }).drop("__words")
    v, o, s = F.col("main_verbs"), F.col("main_objects"), F.col("spatial_relations")
    base = base.withColumns({
        "task_family": task_family(core, v, o, lexicon.families),
        "interaction_type": interaction_type(core, lexicon.interactions),
        "bimanual_likelihood": bimanual_score(core, lexicon),
        "articulated_object_likelihood": articulated_score(core, v, lexicon),
    })
    return base.withColumns({
        "physical_difficulty_score": difficulty_score(core, v, s, F.col("bimanual_likelihood"), F.col("articulated_object_likelihood")),
        "semantic_parse_confidence": parse_confidence(F.col("task_family"), v, o, core),
    })


def task_name_semantics(name: Column | str) -> dict[str, Column]:
    """Sorted verbs (the first token), objects and targets of a task's name."""
    tokens = F.filter(F.split(F.replace(col(name), F.lit("-"), F.lit("_")), "_"), lambda t: t != "")
    pick = lambda hints: joined(F.array_sort(F.array_intersect(tokens, F.array(*map(F.lit, hints)))))
    return {"verbs": F.coalesce(F.try_element_at(tokens, F.lit(1)), F.lit("")), "objects": pick(OBJECT_HINTS), "targets": pick(TARGET_HINTS)}


# ---- pairs ----------------------------------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, junk heuristic included; there is no built-in for it."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, a or "", b or "").ratio() for a, b in zip(left, right)])


def terms(text: Column | str) -> Column:
    """Words of two or more characters and pairs of neighbours."""
    w = F.regexp_extract_all(F.lower(F.coalesce(col(text), F.lit(""))), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) > 1, F.concat(w, pairs)).otherwise(w)


def tfidf_cosine(pairs: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """``keys, tfidf``: cosine of the two texts' tf-idf vectors, fitted on the pair alone.

    With two documents the smoothed idf is 1 for a shared term and ln(1.5) + 1 for one of a single text, so the sums
    need term counts only. No shared terms, or no terms at all: 0.
    """
    one = lambda c, n: pairs.select(*keys, F.explode(terms(c)).alias("term"), F.lit(n).alias("side"))
    tf = one(left, 0).unionAll(one(right, 1)).groupBy(*keys, "term").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    w = F.when((F.col("a") > 0) & (F.col("b") > 0), 1.0).otherwise(F.log(F.lit(1.5)) + 1)
    sums = tf.groupBy(*keys).agg(F.sum(F.col("a") * F.col("b") * w * w).alias("ab"), F.sum((F.col("a") * w) ** 2).alias("aa"), F.sum((F.col("b") * w) ** 2).alias("bb"))
    length = F.sqrt("aa") * F.sqrt("bb")
    found = sums.select(*keys, F.when(length > 0, F.col("ab") / length).otherwise(0.0).alias("tfidf"))
    return pairs.select(*keys).join(found, keys, "left").select(*keys, F.coalesce("tfidf", F.lit(0.0)).alias("tfidf"))


def reuse_policy(verb: Column, obj: Column, receptacle: Column, sequence: Column, tfidf: Column, families: tuple[Column, Column], fallback: bool = False) -> dict[str, Column]:
    """Whether a variant may reuse the base prompt's action: label, confidence, reasons."""
    same_family = families[0] == families[1]
    low = lambda name, v: F.concat(F.lit(f"{name} low ("), F.format_string("%.2f", v), F.lit(")"))
    listed = [
        (~same_family, F.concat(F.lit("task_family changed "), families[0], F.lit("->"), families[1])), (verb < 0.5, low("verb overlap", verb)),
        (obj < 0.45, low("object overlap", obj)), (receptacle < 0.45, low("target/receptacle overlap", receptacle)), (sequence < 0.58, low("text similarity", sequence)),
    ]
    why = F.concat_ws("; ", *(F.when(c, v) for c, v in listed))
    none = same_family & (verb >= 0.5) & (obj >= 0.45) & (receptacle >= 0.45) & (sequence >= 0.58)
    same = none & (tfidf >= 0.82) & (verb >= 0.75) & (obj >= 0.65)
    target, changed = (receptacle < 0.45) & (verb >= 0.5), verb < 0.5
    maybe = same_family & (tfidf >= 0.62) & (obj >= 0.45)
    say = lambda text: F.coalesce(F.nullif(why, F.lit("")), F.lit(text))
    ladder = [
        (same, "SAME_ACTION_OK", F.lit(0.82), F.lit("same task family with high text, verb, and object similarity")),
        (target, "TARGET_CHANGED", F.least(F.lit(0.9), 0.55 + 0.35 * (1 - receptacle)), why), (changed, "VERB_CHANGED", F.least(F.lit(0.9), 0.55 + 0.35 * (1 - verb)), why),
        (maybe, "ACTION_MAYBE_OK", F.lit(0.62), say("same task family but prompt differs enough to require manual check")),
    ]
    reason = first_match([(k, r) for k, _, _, r in ladder], say("mixed semantic signals; manual inspection recommended"))
    return {
        "estimated_action_reuse_policy": first_match([(k, F.lit(n)) for k, n, _, _ in ladder], F.lit("AMBIGUOUS")),
        "policy_confidence": F.round(first_match([(k, x) for k, _, x, _ in ladder], F.lit(0.55)), 4),
        "reason": F.concat_ws("; ", F.lit("tf-idf unavailable"), reason) if fallback else reason,
    }


def compare_prompts(semantics: DataFrame, keys: list[str], variants: tuple[str, ...] = ("variant_1", "variant_2"), sequence: bool = True) -> DataFrame:
    """Base prompt against each variant of the same episode; episodes without both are left out.

    One row for each key, variant and (the last of) repeated prompts. ``sequence=False`` skips the ratio that needs
    Python and counts it as 1.
    """
    fields = ["prefix_removed_prompt", "main_verbs", "main_objects", "receptacles_or_targets", "task_family", "interaction_type"]
    side = lambda df, p: df.select(*keys, *([F.col("prompt_set").alias("comparison")] if p == "v" else []), *(F.col(f).alias(f"{p}_{f}") for f in fields))
    base = side(semantics.where(F.col("prompt_set") == "base").dropDuplicates(keys), "b")
    other = side(semantics.where(F.col("prompt_set").isin(*variants)).dropDuplicates([*keys, "prompt_set"]), "v")
    both = base.join(other, keys)
    tf = tfidf_cosine(both.select(*keys, "comparison", "b_prefix_removed_prompt", "v_prefix_removed_prompt"), [*keys, "comparison"], "b_prefix_removed_prompt", "v_prefix_removed_prompt")
    both = both.join(tf, [*keys, "comparison"]).withColumns({
        "verb_overlap": jaccard("b_main_verbs", "v_main_verbs"), "object_overlap": jaccard("b_main_objects", "v_main_objects"),
        "receptacle_overlap": jaccard("b_receptacles_or_targets", "v_receptacles_or_targets"),
        "sequence": sequence_ratio("b_prefix_removed_prompt", "v_prefix_removed_prompt") if sequence else F.lit(1.0),
    })
    policy = reuse_policy(F.col("verb_overlap"), F.col("object_overlap"), F.col("receptacle_overlap"), F.col("sequence"), F.col("tfidf"), (F.col("b_task_family"), F.col("v_task_family")))
    return both.withColumns(policy | {
        "family_changed": F.col("b_task_family") != F.col("v_task_family"), "interaction_changed": F.col("b_interaction_type") != F.col("v_interaction_type"),
        "text_equal": F.col("b_prefix_removed_prompt") == F.col("v_prefix_removed_prompt"),
        **{c: F.round(c, 4) for c in ("verb_overlap", "object_overlap", "receptacle_overlap", "sequence", "tfidf")},
    })


# ---- JSON -----------------------------------------------------------------------------------------------

# Keys and labels of a model's verdict.
DECISIONS = ["PASS", "WARN_KEEP", "REJECT", "DPO_LOSER_CANDIDATE", "NEED_HUMAN_REVIEW"]
SCORES = [
    "domain_match",
    "robot_visibility",
    "gripper_contact_visibility",
    "object_visibility",
    "physical_plausibility",
    "temporal_consistency",
    "visual_quality",
    "task_relevance",
    "sft_positive_suitability",
    "a2v_positive_suitability",
    "dpo_loser_suitability",
]
FLAGS = [
    "arm_partially_out_of_frame_but_ok",
    "critical_contact_invisible",
    "object_moves_without_contact",
    "severe_flicker_or_exposure_jump",
    "severe_noise_or_compression",
    "wrong_robot_or_missing_robot",
    "prompt_action_mismatch",
    "possible_left_right_swap",
]
USES = ["use_for_sft", "use_for_a2v", "use_for_dpo_winner", "use_for_dpo_loser"]
SHORT_SCORES = ["vlm_domain_score", "vlm_task_progress_score", "vlm_physics_score", "vlm_semantic_consistency_score"]


def loose_json(c: Column | str) -> Column:
    """The text if it is JSON, else the part from its first brace to its last."""
    c = col(c)
    return F.when(F.try_parse_json(c).isNotNull(), c).otherwise(F.regexp_extract(c, r"(?s)\{.*\}", 0))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value as a lambda's variable, so that it is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def verdict(c: Column | str, scores: list[str] = SCORES, flags: list[str] = FLAGS, uses: list[str] = USES) -> Column:
    """A model's verdict as a struct: unknown decisions become NEED_HUMAN_REVIEW, confidences lie in 0..1, scores in 0..2 (1 where
    missing), flags and uses are booleans, evidence has at most six pieces of 240 characters. The text is parsed once."""
    block = lambda names: "struct<" + ",".join(f"{n}:string" for n in names) + ">"
    form = f"overall_decision string, confidence string, scores {block(scores)}, flags {block(flags)}, evidence array<string>, recommended_use {block(uses)}"
    return once(F.from_json(loose_json(c), form), lambda raw: _verdict(raw, scores, flags, uses))


def _verdict(raw: Column, scores: list[str], flags: list[str], uses: list[str]) -> Column:
    decision = F.upper(F.trim(F.coalesce(raw["overall_decision"], F.lit(""))))
    whole = lambda n: F.coalesce(number(raw["scores"][n]).try_cast("int"), F.lit(1))
    yes = lambda x: F.coalesce(F.lower(x) == "true", F.lit(False))
    pieces = F.coalesce(raw["evidence"], F.array().cast("array<string>"))
    return F.struct(
        F.when(decision.isin(*DECISIONS), decision).otherwise("NEED_HUMAN_REVIEW").alias("overall_decision"),
        clamp(F.coalesce(number(raw["confidence"]), F.lit(0.0))).alias("confidence"),
        F.struct(*(F.greatest(F.lit(0), F.least(F.lit(2), whole(n))).alias(n) for n in scores)).alias("scores"),
        F.struct(*(yes(raw["flags"][n]).alias(n) for n in flags)).alias("flags"),
        F.slice(F.transform(pieces, lambda x: F.substring(x, 1, 240)), 1, 6).alias("evidence"),
        F.struct(*(yes(raw["recommended_use"][n]).alias(n) for n in uses)).alias("recommended_use"),
    )


def short_verdict(c: Column | str) -> Column:
    """The verdict of a single-pass check: decision (WARN if unknown), confidence, four scores, evidence as one text."""
    form = "vlm_decision string, decision string, confidence string, evidence array<string>, " + ", ".join(f"{n} string" for n in SHORT_SCORES)
    return once(F.from_json(loose_json(c), form), _short_verdict)


def _short_verdict(raw: Column) -> Column:
    status = F.upper(F.coalesce(F.nullif(raw["vlm_decision"], F.lit("")), F.nullif(raw["decision"], F.lit("")), F.lit("WARN")))
    pieces = F.slice(F.transform(F.coalesce(raw["evidence"], F.array().cast("array<string>")), lambda x: F.substring(x, 1, 220)), 1, 6)
    return F.struct(
        F.when(status.isin("PASS", "WARN", "REJECT", "DPO_LOSER"), status).otherwise("WARN").alias("vlm_decision"),
        clamp(F.coalesce(number(raw["confidence"]), F.lit(0.0))).alias("vlm_confidence"),
        *(F.greatest(F.lit(0), F.least(F.lit(2), F.coalesce(number(raw[n]).try_cast("int"), F.lit(1)))).alias(n) for n in SHORT_SCORES),
        F.array_join(pieces, "; ").alias("vlm_evidence"),
    )


def flat_verdict(df: DataFrame, c: str) -> DataFrame:
    """``vlm_*``, ``score_*``, ``flag_*`` and ``use_*`` columns of a verdict struct."""
    v = F.col(c)
    parts = {"vlm_decision": v["overall_decision"], "vlm_confidence": v["confidence"], "vlm_evidence": F.array_join(v["evidence"], " | ")}
    for prefix, of in (("score_", "scores"), ("flag_", "flags"), ("", "recommended_use")):
        parts |= {f"{prefix}{f.name}": v[of][f.name] for f in df.schema[c].dataType[of].dataType.fields}
    return df.withColumns(parts).drop(c)


def label_list(c: Column | str) -> Column:
    """Labels of a JSON list, or of a text split at commas and semicolons."""
    c = F.coalesce(col(c), F.lit(""))
    listed = F.from_json(F.when(F.startswith(F.trim(c), F.lit("[")), c), "array<string>")
    return F.coalesce(listed, items(c, "[,;]"))


def rule_context(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def review_prompt(system: str, checklist: str, family: Column, prompt: Column, context: Column) -> Column:
    return F.concat_ws("\n\n", F.lit(system), F.lit(checklist), F.concat(F.lit("Task family: "), F.replace(family, F.lit("_"), F.lit(" "))), F.concat(F.lit("Prompt: "), prompt), F.concat(F.lit("Rule context: "), context))

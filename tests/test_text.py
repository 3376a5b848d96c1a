import math
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tracklode.functions import text as X
from tracklode.functions.lexicon import ROBOT

OPENING = "In a fixed robotic workspace, generate a rigid, physically consistent embodied robotic arm. The arm maintains high stability with no deformation and enters the frame to "


@pytest.mark.parametrize("raw,want", [(OPENING + "pick up", "pick up"), (OPENING.upper() + "Put it", "Put it"), ("in a fixed robotic workspace, anything at all enters the frame to open", "open"), ("  plain ", "plain"), (None, "")])
def test_opening_is_removed(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "x string")
    assert df.select(X.core_text("x")).first()[0] == want


def parse(spark, text):
    return X.prompt_semantics(spark.createDataFrame([(text,)], "raw_prompt string")).first()


def test_semantics(spark):
    r = parse(spark, "Grab the red bottle with the left arm and the right arm, put it into the dustbin, éput")
    assert r.main_verbs == ["pick", "place"] and r.main_objects[:2] == ["bottle", "dustbin"] and "red bottle" in r.main_objects
    assert r.receptacles_or_targets == ["dustbin"] and r.spatial_relations == ["left", "right", "into"]
    assert r.task_family == "object_to_container" and r.interaction_type == "pick_place" and r.bimanual_likelihood == 0.8
    assert r.articulated_object_likelihood == 0.0 and r.physical_difficulty_score == pytest.approx(1 + 2 * 0.45 + 3 * 0.22 + 0.8 * 1.2)
    assert r.semantic_parse_confidence == 1.0


def test_family_order_and_substrings(spark):
    assert parse(spark, "scan and press").task_family == "scanning_qrcode"
    assert parse(spark, "reopen").task_family == "articulated_open_close" and parse(spark, "reopen").main_verbs == []
    empty = parse(spark, None)
    assert (empty.task_family, empty.interaction_type, empty.main_verbs, empty.semantic_parse_confidence) == ("unknown", "unknown", [], 0.35)


def test_noun_phrases_against_python(spark):
    texts = ["Pick the big  red block with the arm, then place a small cup on the wooden table.", "the a", "An old, the new thing near it", ""]
    pattern = re.compile(r"\b(?:the|a|an)\s+([a-z0-9\- ]{2,80}?)(?=\s+(?:with|using|by|into|in|on|under|beneath|behind|beside|near|from|to|and|then|,|\.|$))")
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").orderBy("i").select(X.noun_phrases(F.col("x"), ROBOT.stop_words)).collect()]
    for t, g in zip(texts, got):
        want = []
        for m in pattern.finditer(t.lower()):
            tokens = [w for w in m.group(1).split() if w not in ROBOT.stop_words]
            if tokens and " ".join(tokens[-4:]) not in want:
                want.append(" ".join(tokens[-4:]))
        assert g == want


def plain_tfidf(a, b):
    def terms(t):
        w = re.findall(r"\w\w+", t.lower())
        return Counter(w + [f"{x} {y}" for x, y in zip(w, w[1:])])

    p, q = terms(a), terms(b)
    weight = {t: 1.0 if t in p and t in q else math.log(1.5) + 1 for t in p | q}
    norm = lambda c: math.sqrt(sum((n * weight[t]) ** 2 for t, n in c.items()))
    return sum(p[t] * q[t] * weight[t] ** 2 for t in p) / (norm(p) * norm(q)) if norm(p) and norm(q) else 0.0


PAIRS = [("pick the cup up", "pick the cup up"), ("pick the cup", "place a bowl"), ("", "x"), ("a b", "c"), ("open the big door", "open the door now")]


def test_tfidf_and_ratio(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, l string, r string")
    tf = {r.i: r.tfidf for r in X.tfidf_cosine(df, ["i"], "l", "r").collect()}
    ratio = {r.i: r.s for r in df.select("i", X.sequence_ratio("l", "r").alias("s")).collect()}
    for i, (a, b) in enumerate(PAIRS):
        assert tf[i] == pytest.approx(plain_tfidf(a, b)) and ratio[i] == pytest.approx(SequenceMatcher(None, a, b).ratio())


@pytest.mark.parametrize("v,o,r,s,t,same,want,conf", [
    (1.0, 1.0, 1.0, 0.9, 0.9, True, "SAME_ACTION_OK", 0.82), (0.75, 0.65, 0.45, 0.58, 0.82, True, "SAME_ACTION_OK", 0.82), (1.0, 1.0, 0.0, 0.9, 0.9, True, "TARGET_CHANGED", 0.9), (0.5, 1.0, 0.44, 0.9, 0.9, True, "TARGET_CHANGED", 0.746),
    (0.0, 1.0, 1.0, 0.9, 0.9, True, "VERB_CHANGED", 0.9), (0.49, 1.0, 0.0, 0.9, 0.9, True, "VERB_CHANGED", 0.7285), (0.74, 0.45, 0.45, 0.58, 0.62, True, "ACTION_MAYBE_OK", 0.62), (1.0, 0.44, 1.0, 0.9, 0.9, True, "AMBIGUOUS", 0.55), (1.0, 1.0, 1.0, 0.9, 0.9, False, "AMBIGUOUS", 0.55),
])
def test_reuse_policy(spark, v, o, r, s, t, same, want, conf):
    lit = F.lit
    got = X.reuse_policy(lit(v), lit(o), lit(r), lit(s), lit(t), (lit("a"), lit("a" if same else "b")))
    row = spark.range(1).select(*(c.alias(n) for n, c in got.items())).first()
    assert (row.estimated_action_reuse_policy, row.policy_confidence) == (want, pytest.approx(conf))
    assert ("family" in row.reason) == (not same or want in ("SAME_ACTION_OK",) or "same task family" in row.reason)


def test_compare_prompts(spark):
    rows = [(1, "base", "pick the cup"), (1, "variant_1", "pick the cup"), (1, "variant_2", "open the door"), (2, "base", "pick"), (3, "variant_1", "pick")]
    sem = X.prompt_semantics(spark.createDataFrame(rows, "id int, prompt_set string, raw_prompt string"))
    got = {r.comparison: r for r in X.compare_prompts(sem, ["id"]).collect()}
    assert set(got) == {"variant_1", "variant_2"} and got["variant_1"].text_equal and got["variant_1"].estimated_action_reuse_policy == "SAME_ACTION_OK"
    assert got["variant_2"].family_changed and got["variant_2"].estimated_action_reuse_policy == "VERB_CHANGED"


def test_verdicts(spark):
    texts = ['{"overall_decision": " pass ", "confidence": 7, "scores": {"domain_match": 9, "task_relevance": "0", "visual_quality": -1}, "flags": {"prompt_action_mismatch": true}, "evidence": ["' + "x" * 300 + '", 2, 3, 4, 5, 6, 7]}', 'So: {"overall_decision": "REJECT", "confidence": "0.5"} ok', "{broken", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.verdict("t").alias("v"))
    got = {r.i: r.v for r in df.collect()}
    assert (got[0].overall_decision, got[0].confidence, got[0].scores.domain_match, got[0].scores.task_relevance, got[0].scores.visual_quality, got[0].scores.robot_visibility) == ("PASS", 1.0, 2, 0, 0, 1)
    assert got[0].flags.prompt_action_mismatch and not got[0].flags.critical_contact_invisible and len(got[0].evidence) == 6 and len(got[0].evidence[0]) == 240
    assert (got[1].overall_decision, got[1].confidence) == ("REJECT", 0.5)
    assert got[2].overall_decision == got[3].overall_decision == "NEED_HUMAN_REVIEW" and got[3].scores.domain_match == 1
    flat = X.flat_verdict(df, "v")
    assert {"vlm_decision", "score_domain_match", "flag_prompt_action_mismatch", "use_for_sft"} <= set(flat.columns)


def test_short_verdict_and_labels(spark):
    df = spark.createDataFrame([('{"decision": "dpo_loser", "confidence": 2, "vlm_physics_score": 5, "evidence": ["a", "b"]}', '["p","q"]'), ("?", "a, b;c"), (None, None)], "t string, l string")
    got = df.select(X.short_verdict("t").alias("v"), X.label_list("l").alias("l")).collect()
    assert (got[0].v.vlm_decision, got[0].v.vlm_confidence, got[0].v.vlm_physics_score, got[0].v.vlm_evidence) == ("DPO_LOSER", 1.0, 2, "a; b")
    assert got[1].v.vlm_decision == got[2].v.vlm_decision == "WARN" and [r.l for r in got] == [["p", "q"], ["a", "b", "c"], []]


def test_task_names(spark):
    r = spark.range(1).select(*(c.alias(n) for n, c in X.task_name_semantics(F.lit("place-bottle_in_dustbin_cup")).items())).first()
    assert tuple(r) == ("place", "bottle;cup", "dustbin")


def test_the_whole_policy_sees_order_and_phrases(spark, monkeypatch):
    from tracklode import queries

    said = [("moved", "base", "pick up the cup and then open the drawer"), ("moved", "variant_1", "open the drawer and then pick up the cup"), ("same", "base", "pick the red gizmo and lift it"), ("same", "variant_1", "pick the red gizmo and lift it"), ("other", "base", "pick the red gizmo and lift it"), ("other", "variant_1", "pick the green widget and lift it")]
    prompts = spark.createDataFrame(said, "conv_id string, prompt_set string, text string")
    monkeypatch.setattr(queries, "_prompts", lambda spark, sf_dir: prompts)
    got = {r.conv_id: r for r in queries.queries()["prompt_pair_policy_full"](spark, "").collect()}
    nouns = {r.text: set(r.n) for r in prompts.select("text", X.noun_phrases(F.col("text"), queries.PROSE.stop_words).alias("n")).collect()}
    assert not nouns["pick the red gizmo and lift it"] & nouns["pick the green widget and lift it"] and nouns["pick the red gizmo and lift it"]
    assert SequenceMatcher(None, said[0][2], said[1][2]).ratio() < 0.58 and got["moved"].policy != "SAME_ACTION_OK"
    assert got["same"].policy == "SAME_ACTION_OK" and got["same"].object_overlap == 1
    listed = {r.raw: set(r.main_objects) for r in X.prompt_semantics(prompts, "text", queries.PROSE, phrases=False).select(F.col("text").alias("raw"), "main_objects").collect()}
    a, b = (listed[t] | nouns[t] for t in (said[4][2], said[5][2]))
    assert got["other"].object_overlap == pytest.approx(len(a & b) / len(a | b), abs=1e-4) and got["other"].object_overlap < 1

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracklode.llm import chat
from tracklode.llm.common import Scratch

ODD = [r"\### Assistant: </turn> ok", "&lt;", "&amp;lt;", '<turn role="user">', "a\nb", "", "\\", "</turn>\n", "é😀", '">', "&quot;", "x" * 50_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations():
    rnd = random.Random(4)
    rows = []
    for c in range(40):
        for t in range(rnd.randint(1, 9)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", 'odd"<role>']), rnd.choice(ODD)))
    return [*rows, (50, 0, None, None), (50, None, "assistant", None), (51, 1, "assistant", "b"), (51, 1, "assistant", "b"), (51, 1, "assistant", "a"), (None, 0, "user", "lost"), (52, 5, "user", "late")]


def plain(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((-(1 << 60) if t is None else t, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)))
    return out


def test_digests_are_those_of_the_turns(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string").selectExpr("*", "'q' as tree", "1 as node", "2 as score", "3 as k")
    got = [tuple(r)[:5] for r in chat.digests(df, Scratch(spark)).collect()]
    assert sorted(got, key=str) == sorted(plain(conversations()), key=str)


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    plan = chat.digests(df, Scratch(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_escapes_undo_each_other(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "x string")
    for r in df.select("x", chat.unescape(chat.escape(F.col("x"))).alias("t"), chat.unescape(chat.escape_role(F.col("x"))).alias("r"), chat.escape(F.col("x")).alias("e")).collect():
        assert r.t == r.x == r.r and "<" not in r.e


def test_mask_covers_assistant_texts(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    made = chat.parse(chat.format_paths(chat.chosen(chat.chain(df), Scratch(spark)))).collect()
    for r in made:
        spans = [r.formatted[m.start : m.start + m.length] for m in r.mask]
        assert len(spans) == sum(t.role == "assistant" for t in r.turns)
        assert [s.replace("&lt;", "<").replace("&amp;", "&") for s in spans] == [t.text for t in r.turns if t.role == "assistant"]


TREE = [(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 3, None), (1, 6, 3, 2.0), (2, 1, None, 0.0), (2, 7, 99, 1.0), (None, 1, None, 0.0), (None, 2, 1, 0.0), (3, 1, None, 1.0)]


def tree(spark):
    return spark.createDataFrame([(t, n, p, "user" if n % 2 else "assistant", f"m{n}", s) for t, n, p, s in TREE], "tree long, node long, parent long, role string, text string, score double")


def test_paths_of_a_tree(spark):
    got = defaultdict(list)
    for r in chat.paths(tree(spark), Scratch(spark)).collect():
        got[r.tree, r.leaf].append((-r.back, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {(1, 4): [1, 2, 4], (1, 5): [1, 3, 5], (1, 6): [1, 3, 6], (2, 1): [1], (2, 7): [7], (None, 2): [1, 2], (3, 1): [1]}


def test_branches_rank_by_mean_score(spark):
    best = {(r.tree, r.leaf, r.branch) for r in chat.chosen(tree(spark), Scratch(spark), branches=2).collect()}
    assert best == {(1, 4, 1), (1, 6, 2), (2, 7, 1), (2, 1, 2), (None, 2, 1), (3, 1, 1)}
    assert {r.leaf for r in chat.chosen(tree(spark), Scratch(spark)).where("tree = 1").collect()} == {4}


def test_long_chain_takes_few_rounds(spark):
    df = spark.range(1500).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    r = chat.digests(df, Scratch(spark)).first()
    assert r.n_turns == 1500 and r.turns_sha256 == sha("".join(f"user\n{i}\n" for i in range(1500)))


def test_loop_raises(spark):
    df = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0), (1, 3, 2, "u", "c", 0.0)], "tree long, node long, parent long, role string, text string, score double")
    with pytest.raises(ValueError):
        chat.paths(df, Scratch(spark))


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), Scratch(spark)).count() == 0

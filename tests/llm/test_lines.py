from collections import Counter, defaultdict

import pytest

from tracklode.llm import lines
from tracklode.llm.common import Scratch


def plain(rows, ratio, least):
    pages, on = Counter(), defaultdict(Counter)
    for _, host, text in rows:
        if host is not None:
            pages[host] += 1
            for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
                on[host][line] += 1
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        cut = text.split("\n")
        over = {x for x, n in on[host].items() if n >= least and n > pages[host] * ratio} if host is not None else set()
        kept = [x for x in cut if x.strip(" ") not in over or not x.strip(" ")]
        out.append((i, "\n".join(kept), len(cut), len(cut) - len(kept)))
    return out


def data():
    rows = []
    for i in range(60):
        host = "a" if i % 3 else f"h{i % 4}"
        body = [f"own line {i}", "Menu" if i % 2 else "  Menu  ", "", f"group {i % 5}", f"own line {i}"]
        rows.append((i, host, "\n".join(body)))
    return [*rows, (100, None, "Menu\nx"), (101, "a", None), (102, "a", ""), (103, "a", "\n\n"), (None, "a", "Menu"), rows[1], rows[1], (104, "a", "w " * 50_000 + "\nMenu")]


@pytest.mark.parametrize("ratio,least", [(0.3, 2), (0.03, 5), (0.9, 1)])
def test_against_plain_counts(spark, ratio, least):
    df = spark.createDataFrame(data(), "doc_id long, source string, text string").selectExpr("*", "'q' as host", "'r' as lines", "7 as n_lines", "1 as pages").repartition(3)
    out = lines.drop_boilerplate(df, Scratch(spark), ratio=ratio, min_pages=least)
    assert set(out.columns) == set(df.columns) | {"n_dropped"}
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()]
    assert sorted(got, key=str) == sorted(plain(data(), ratio, least), key=str)


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(data(), "doc_id long, source string, text string")
    plan = lines.drop_boilerplate(df, Scratch(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_table(spark):
    assert lines.drop_boilerplate(spark.createDataFrame([], "doc_id long, source string, text string"), Scratch(spark)).count() == 0

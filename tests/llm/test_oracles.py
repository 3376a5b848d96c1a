"""The registered queries of the subpackage next to their SQL, and op5 next to a plain packing of the library's counts."""

import math
from collections import Counter

import duckdb
import pytest

from tracklode.llm import queries

TABLES = "documents embeddings pages labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns and got
    assert sorted(got, key=str) == sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)


def test_op5_packs_exact_tokens(spark, sf_dir):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    count = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    docs = {r.doc_id: len(count.encode(r.text or "", add_special_tokens=False)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.queries()["op5_packing"](spark, sf_dir).collect()
    tokens, batches = Counter(), {}
    for r in rows:
        tokens[r.doc_id] += r.length
        assert r.start == 2048 * r.piece and r.length <= min(2048, r.bucket) and r.padding == r.bucket - r.length
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    assert dict(tokens) == docs and len(rows) == sum(max(1, math.ceil(n / 2048)) for n in docs.values())
    assert len({r.bucket for r in rows}) <= 8
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bucket <= max(65_536, bucket)
    # no other choice of as many bounds pads less
    lengths = Counter(r.length for r in rows)
    order = sorted(lengths)
    cost = {0: 0}
    for _ in range(8):
        cost = cost | {j: min(c + order[j - 1] * sum(lengths[x] for x in order[i:j]) for i, c in cost.items() if i < j) for j in range(1, len(order) + 1)} | {0: 0}
    assert sum(r.bucket for r in rows) == cost[len(order)]


def test_line_breaks_and_hosts_of_pages(spark):
    from tracklode.llm import lines

    rows = [
        (1, "HTTP://User:pw@News.Example.com:8080/a?b#c", "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style></head><body><p>one <b>two</b>\nthree</p><!-- no\n --><script>var x='<p>';</script> four<BR/>five</body></html>"),
        (2, "no url", ""), (3, None, None), (4, "https://x.org", "<p></p>  \n<div> </div>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' as text", "'h' as host")
    got = {r.page_id: (r.host, r.text) for r in lines.site_pages(df).collect()}
    assert got == {1: ("news.example.com", "T &amp; t\none two\nthree\nfour\nfive"), 2: (None, ""), 3: (None, None), 4: ("x.org", "")}

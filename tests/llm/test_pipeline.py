import __spark_entry__
import corpus_pipeline
from tracklode.llm.common import Scratch


def test_stages_and_registration():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "SimHash near-dedup", "substring dedup", "packing"]
    got = __spark_entry__.queries()
    assert "pipeline" in got and sum(n.startswith("op") and n[2].isdigit() for n in got) == 10


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    scratch = Scratch(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.write(stage(spark, docs, sf), f"test-{k}")
        if name != "packing":
            assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
            assert out.count() <= n and out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
            n = out.count()
            for r in out.collect():
                assert r.n_chars == len(r.text)
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
            from tracklode.llm import tokens

            counted = tokens.count_tokens(docs, corpus_pipeline.vocabulary_path(corpus_pipeline.VOCABULARY))
            assert sum(r.length for r in out.collect()) == sum(r.n_tokens for r in counted.collect())
        docs = out


def test_stages_on_an_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


def test_a_large_group_of_copies_keeps_its_lines(spark):
    rows = [(i, "a", f"Menu\nown line {i}") for i in range(60)] + [(100 + i, "a", "Menu\nfirst line of the copies\nsecond line") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "length(text) as n_chars").selectExpr("doc_id", "source", "text", "cast(n_chars as long) as n_chars")
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert out == {i: f"own line {i}" if i < 100 else "first line of the copies\nsecond line" for i, _, _ in rows}

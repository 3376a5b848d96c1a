"""Each stage of the pipeline next to a plain loop over the rows that it is given."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from test_quality import plain_scores
from test_simhash import similarity

FORM = "doc_id long, text string, lang string, source string, n_chars long, extra array<int>"


def corpus():
    """Copies and near copies, a line that a source repeats, a passage that documents share, ids that repeat, nulls."""
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, texts = " ".join(words(60)), []
    for i in range(70):
        lines = [" ".join(words(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 4))]
        if i % 4 == 0:
            lines.append("Share this page")
        if i % 9 == 0:
            lines.insert(0, passage)
        texts.append("\n".join(lines))
    for i in range(5):
        texts.append(texts[i * 7])
        near = texts[30 + i].split(" ")
        near[len(near) // 2 :: 40] = ["changed"] * len(near[len(near) // 2 :: 40])
        texts.append(" ".join(near))
    texts += [None, "", " \n ", "one", "long " * 3000]
    rows = [(i, t, "en", "b" if i % 3 else "a", len(t or ""), [i]) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return [*rows, (None, "a text without an id " * 3, "en", None, 63, None), (3, "another text of one id", None, "a", 22, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), FORM).repartition(3)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_quality_stage(spark, docs, tmp_path):
    rows = corpus()
    labels = [(i, int(i % 4 > 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    import zlib

    known = dict(labels)
    train = [(i, t, known[i]) for i, t, *_ in rows if i in known and zlib.crc32(str(i).encode()) % 4 != 2]
    # rows of one id are one label each, in the order of id, then of features
    scores = plain_scores(train, [r[1] for r in rows])
    close = [s for s in scores if abs(s - 0.7) < 1e-6]
    out = corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))
    assert not close and out.columns == docs.columns
    assert rows_of(out) == sorted(((r[0], r[1]) for r, s in zip(rows, scores) if s >= 0.7), key=str)


def test_line_stage(spark, docs):
    pages, on = Counter(), defaultdict(Counter)
    for source, text in {(r[3], r[1]) for r in corpus() if r[3] is not None}:
        pages[source] += 1
        on[source].update({x.strip(" ") for x in (text or "").split("\n")} - {""})
    want = []
    for i, text, _, source, *_ in corpus():
        over = {x for x, n in on[source].items() if n >= 5 and n > pages[source] * 0.03}
        want.append((i, None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" ") not in over or not x.strip(" "))))
    out = corpus_pipeline.line_dedup(spark, docs, "")
    assert out.columns == docs.columns and rows_of(out) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text or "") for r in out.collect() if r.doc_id != 3)


def test_near_duplicate_stage(spark, docs):
    rows = [r for r in corpus() if r[0] is not None and (r[1] or "").split()]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(rows[i][1], rows[j][1]) >= 0.8 - 1e-9:
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for k, r in enumerate(rows):
        low[find(k)].append(r[0])
    gone = {r[0] for k, r in enumerate(rows) if r[0] != min(low[find(k)])}
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert gone and out.columns == docs.columns
    assert rows_of(out) == sorted(((r[0], r[1]) for r in corpus() if r[0] not in gone), key=str)


def test_substring_stage(spark, docs):
    seen, kept = set(), {}
    order = sorted({(r[0] if r[0] is not None else -(1 << 63), r[1] or "") for r in corpus()}, key=lambda x: (x[0], __import__("hashlib").sha256(x[1].encode()).hexdigest()))
    for i, text in order:
        words = text.split()
        gone = set()
        for s in range(len(words) - 19):
            key = tuple(words[s : s + 20])
            gone |= set(range(s, s + 20)) if key in seen else set()
            seen.add(key)
        kept[i, text] = [w for k, w in enumerate(words) if k not in gone], bool(gone)
    out = corpus_pipeline.substring_dedup(spark, docs, "").collect()
    got = sorted((str(r.doc_id), (r.text or "").split()) for r in out)
    assert got == sorted((str(r[0]), kept[r[0] if r[0] is not None else -(1 << 63), r[1] or ""][0]) for r in corpus())
    untouched = {t for (_, t), (_, cut) in kept.items() if not cut}
    assert {r.text or "" for r in out} >= untouched


def test_packing_stage(spark, docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    count = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want, got = Counter(), Counter()
    for i, text, *_ in corpus():
        want[i] += len(count.encode(text or "", add_special_tokens=False))
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        got[r.doc_id] += r.length
        assert r.length <= min(r.bucket, 2048)
    assert got == want and set(got) == {r[0] for r in corpus()}

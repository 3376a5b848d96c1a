"""Queries of the ten operators over the driver's tables, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.llm import chat, lines, media, packing, quality, simhash, substrings, tokens, topk
from tracklode.llm.common import Scratch


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = media.store(table(spark, sf_dir, "documents"), Scratch(spark))
    read = media.payloads(media.headers(index))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), memo=3.0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), Scratch(spark))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths are exact token counts; the token budget and the context are those of the vocabulary."""
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), memo=3.0)
    return packing.pack(counted, Scratch(spark), length=F.col("n_tokens"))


def packing_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with words as the unit, which SQL can express."""
    return packing.pack(table(spark, sf_dir, "documents"), Scratch(spark))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), Scratch(spark))


def _cleaned(rows: DataFrame, key: str, host: str) -> DataFrame:
    cleaned = lines.drop_boilerplate(rows, Scratch(rows.sparkSession), host=host)
    return cleaned.select(key, host, "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages by host. Their texts are written once, as the operator reads them twice."""
    pages = Scratch(spark).write(lines.site_pages(table(spark, sf_dir, "pages")), "site-pages")
    return _cleaned(pages, "page_id", "host")


def line_dedup_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over documents, with their source for a host, as the pipeline has it."""
    return _cleaned(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id", "source")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(rows, Scratch(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (
        op1_media_columns, op2_quality_classifier, op3_token_counts, op4_substring_dedup, op5_packing, op6_byte_bpe, op7_exact_topk, op8_line_dedup, op9_simhash_near_dedup, op10_chat_formatting,
        packing_by_words, line_dedup_by_source,
    )
    return {f.__name__: f for f in made}


OP4_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM w WHERE len(words) >= 20),
k AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) AS h FROM win),
f AS (SELECT h, min({'d': doc_id, 's': s}) AS first, count(*) AS n FROM k GROUP BY h HAVING count(*) > 1),
later AS (SELECT k.doc_id, k.s FROM k JOIN f ON k.h = f.h WHERE NOT (k.doc_id = f.first.d AND k.s = f.first.s)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
pos AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT pos.doc_id, count(*) FILTER (WHERE gone.p IS NULL) AS n_kept, string_agg(word, ' ' ORDER BY pos.p) FILTER (WHERE gone.p IS NULL) AS body
         FROM pos LEFT JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p GROUP BY pos.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""



def _lines_sql(rows: str, key: str, host: str) -> str:
    """Lines of ``rows``, which have a key, a host and a text."""
    return f"""
WITH rows AS ({rows}), l AS (SELECT {key}, {host}, string_split(text, chr(10)) AS x FROM rows),
totals AS (SELECT {host}, count(*) AS pages FROM rows WHERE {host} IS NOT NULL GROUP BY {host}),
each AS (SELECT {host}, unnest(list_distinct(list_filter(list_transform(x, lambda y: trim(y, ' ')), lambda y: y <> ''))) AS line FROM l WHERE {host} IS NOT NULL),
over AS (SELECT e.{host}, e.line FROM each e JOIN totals t ON e.{host} = t.{host} GROUP BY e.{host}, e.line, t.pages HAVING count(*) >= 5 AND count(*) > t.pages * 0.03),
sets AS (SELECT {host}, list(line) AS lines FROM over GROUP BY {host}),
kept AS (SELECT l.{key}, l.{host}, l.x, CASE WHEN s.lines IS NULL THEN l.x ELSE list_filter(l.x, lambda y: trim(y, ' ') = '' OR NOT list_contains(s.lines, trim(y, ' '))) END AS k
         FROM l LEFT JOIN sets s ON l.{host} = s.{host})
SELECT {key}, {host}, coalesce(len(x), 0)::BIGINT AS n_lines, (coalesce(len(x), 0) - coalesce(len(k), 0))::BIGINT AS n_dropped, sha256(coalesce(array_to_string(k, chr(10)), '')) AS kept_sha256 FROM kept
"""


def _pages_sql() -> str:
    text = f"regexp_replace(regexp_replace(html, '{lines.INVISIBLE}', '', 'g'), '{lines.BLOCK}', chr(10), 'g')"
    split = f"string_split(replace(regexp_replace({text}, '<[^>]*>', '', 'g'), chr(13), chr(10)), chr(10))"
    host = "nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')"
    return f"SELECT page_id, {host} AS host, array_to_string(list_filter(list_transform({split}, lambda x: trim(x, ' ')), lambda x: x <> ''), chr(10)) AS text FROM pages"


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, t, CASE WHEN t = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(t)),
e AS (SELECT *, '<turn role="' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') || '">' || replace(replace(text, '&', '&amp;'), '<', '&lt;') || '</turn>' || chr(10) AS shown FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(shown))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _packing_sql(context: int = 2048, buckets: int = 8, budget: int = 65_536, part_rows: int = 50_000) -> str:
    """The same dynamic programming, one step of it a common table; ``b`` walks back from the longest length."""
    steps = ["d0 AS (SELECT 0::BIGINT AS j, 0::DOUBLE AS cost, 0::BIGINT AS come)"]
    for k in range(1, buckets + 1):
        steps.append(f"d{k} AS (SELECT g.j, min(p.cost + g.length * (g.rows - g0.rows)) AS cost, arg_min(p.j, {{'c': p.cost + g.length * (g.rows - g0.rows), 'j': p.j}}) AS come FROM d{k - 1} p JOIN h0 g0 ON g0.j = p.j JOIN h g ON g.j > p.j GROUP BY g.j)")
    ends = " UNION ALL ".join(f"SELECT {k} AS k, d.cost FROM d{k} d, top WHERE d.j = top.j" for k in range(1, buckets + 1))
    walk = ["b0 AS (SELECT top.j, (SELECT arg_min(k, {'c': cost, 'k': k}) FROM ends) AS k FROM top)"]
    for n in range(1, buckets + 1):
        come = " ".join(f"WHEN {k} THEN (SELECT come FROM d{k} WHERE d{k}.j = b.j)" for k in range(1, buckets + 1))
        walk.append(f"b{n} AS (SELECT CASE k {come} END AS j, k - 1 AS k FROM b{n - 1} b WHERE k > 0)")
    bounds = " UNION ".join(f"SELECT j FROM b{n} WHERE j > 0" for n in range(buckets + 1))
    return rf"""
WITH t AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
u AS (SELECT doc_id, tokens, unnest(range(0, greatest(1, (tokens + {context - 1}) // {context}))) AS piece FROM t),
p AS (SELECT doc_id, piece, piece * {context} AS start, least({context}, tokens - piece * {context}) AS length FROM u),
g AS (SELECT length, count(*) AS n FROM p GROUP BY length),
h AS (SELECT row_number() OVER (ORDER BY length) AS j, length, sum(n) OVER (ORDER BY length) AS rows FROM g),
h0 AS (SELECT j, rows FROM h UNION ALL SELECT 0, 0), top AS (SELECT max(j) AS j FROM h),
{", ".join(steps)}, ends AS ({ends}), {", ".join(walk)},
bounds AS (SELECT DISTINCT h.length AS bound FROM ({bounds}) x JOIN h ON x.j = h.j),
parts AS (SELECT greatest(1, (count(*) + {part_rows - 1}) // {part_rows}) AS n FROM p),
placed AS (SELECT p.*, (SELECT min(bound) FROM bounds WHERE bound >= p.length) AS bucket, (coalesce(doc_id, 0) % 1000003 * 7919 + piece + length * 104729) % (SELECT n FROM parts) AS part FROM p),
numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY part, doc_id, piece, length) - 1 AS number, greatest(1, {budget} // greatest(bucket, 1)) AS room FROM placed)
SELECT doc_id, piece, start, length, bucket::BIGINT AS bucket, (bucket - length)::BIGINT AS padding, (number // room)::BIGINT AS batch, (number % room)::INT AS slot FROM numbered
"""


def oracle_sql() -> dict[str, str]:
    by_source = _lines_sql("SELECT doc_id, source, text FROM documents", "doc_id", "source")
    return {
        "op4_substring_dedup": OP4_SQL, "op7_exact_topk": OP7_SQL, "op8_line_dedup": _lines_sql(_pages_sql(), "page_id", "host"), "op10_chat_formatting": OP10_SQL,
        "packing_by_words": _packing_sql(), "line_dedup_by_source": by_source,
    }

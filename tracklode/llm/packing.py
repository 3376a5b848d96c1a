"""Packing (op 5): optimal length buckets and token-budget batches.

Documents over the context length are cut to pieces of at most that many tokens, so the global histogram of lengths
has at most ``context + 1`` bins however large the corpus; only it goes to the driver. Dynamic programming over it picks the bucket
boundaries of least padding. Inside a bucket pieces are numbered and each run of ``budget // boundary`` pieces is a
batch. Numbers come from two levels: ranks within hashed parts of a bucket, and sums of the parts before, so that no
task holds a whole bucket. Parts are dealt by id, piece and length, so rows without an id, or of one id, are spread too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.llm.common import Scratch


def word_count(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over a histogram of distinct lengths, with the least padding.

    ``cost[j]`` for the lengths up to the j-th in k buckets is the least of ``cost[i] + length[j] * (rows i+1..j)``
    over i; what is left of the tokens is the same for all choices. Ties go to the smaller i.
    """
    order = np.argsort(lengths)
    x, c = np.array(lengths, dtype=np.float64)[order], np.array(counts, dtype=np.float64)[order]
    if not len(x):
        return []
    rows = np.append(0, np.cumsum(c))
    cost, back = np.append(0, np.full(len(x), np.inf)), []
    best, best_k = np.inf, 0
    for k in range(1, min(buckets, len(x)) + 1):
        new, come = np.full(len(x) + 1, np.inf), np.zeros(len(x) + 1, np.int64)
        for j in range(1, len(x) + 1):
            total = cost[:j] + x[j - 1] * (rows[j] - rows[:j])
            come[j] = int(np.argmin(total))
            new[j] = total[come[j]]
        back.append(come)
        cost = new
        if cost[-1] < best:
            best, best_k = cost[-1], k
    out, j = [], len(x)
    for come in reversed(back[:best_k]):
        out.append(int(x[j - 1]))
        j = come[j]
    return out[::-1]


def pack(docs: DataFrame, scratch: Scratch, length: Column | None = None, context: int = 2048, buckets: int = 8, budget: int = 65_536, part_rows: int = 50_000) -> DataFrame:
    """``doc_id, piece, start, length, bucket, padding, batch, slot``: one row for each piece of each document.

    ``length`` is the number of tokens, exact where it comes from ``tokens.count_tokens``; without it words are the unit, and
    context and budget too. ``start`` and ``length`` of a piece count in that unit. Empty and null texts give one piece of length 0. ``bucket`` is the
    length to which the piece is padded, ``batch`` counts from 0 within the bucket, ``slot`` within the batch.
    Pieces that are alike in all columns (repeated rows) get numbers of their own in any order.
    """
    size = F.greatest(F.coalesce(word_count() if length is None else length, F.lit(0)).cast("long"), F.lit(0).cast("long"))
    whole = docs.select("doc_id", size.alias("tokens"))
    cut = whole.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("tokens") / context) - 1, F.lit(0).cast("long")))).alias("piece"))
    start = F.col("piece") * context
    made = cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(context).cast("long"), F.col("tokens") - start).alias("length"))
    pieces = scratch.write(made, "pieces")

    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()
    bounds = boundaries([r["length"] for r in histogram], [r["n"] for r in histogram], buckets) or [context]
    parts = max(1, -(-sum(r["n"] for r in histogram) // part_rows))
    limits = F.array(*(F.lit(b).cast("long") for b in bounds))
    bucket = F.element_at(F.filter(limits, lambda b: b >= F.col("length")), 1)
    placed = pieces.withColumn("bucket", bucket).withColumn("part", F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)) % 1_000_003 * 7919 + F.col("piece") + F.col("length") * 104_729, F.lit(parts)))
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("doc_id", "piece", "length"))
    numbered = placed.withColumn("rank", rank).join(offsets, ["bucket", "part"])
    number, room = F.col("offset") + F.col("rank") - 1, F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1).cast("long"))))
    return numbered.select("doc_id", "piece", "start", "length", "bucket", (F.col("bucket") - F.col("length")).alias("padding"), F.floor(number / room).cast("long").alias("batch"), F.pmod(number, room).cast("int").alias("slot"))

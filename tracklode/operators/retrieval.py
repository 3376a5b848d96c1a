"""Retrieval of library actions by overlap scores: top k of each query.

A row's overlap with a query depends on its signature alone, that is its family and token sets; what it loses is its own. So
rows are first gathered by signature: how many lose less than each number of points, and the k that lose least. Signatures
meet by equality of a family or a token, distinct ones on both sides, and a query looks at rows of its k best signatures only.
What it lacks to k rows comes from rows without any overlap, in the order of what they lose: short lists of the library's
best rows, read further only while some query still lacks rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.functions.expr import either_number, overlaps, rounded, safe_float
from tracklode.sources.scratch import Scratch

# Points of each overlap.
POINTS = {"verbs": 3.0, "objects": 3.0, "targets": 2.0, "spatial": 1.0}
FAMILY_POINTS = 4.0


def penalty(t: Column | str, quality: Column | str) -> Column:
    """What a library row loses on any query: its length over 500, and what its quality lacks to 1 (0 counts as 1)."""
    return F.abs(safe_float(t, 0.0)) / 500 + F.greatest(F.lit(0.0), 1 - F.coalesce(either_number(quality), F.lit(1.0)))


def overlap_points(q: str, lib: str) -> Column:
    total = F.when(F.col(f"{q}family") == F.col(f"{lib}family"), FAMILY_POINTS).otherwise(0.0)
    return reduce(lambda a, f: a + F.when(overlaps(f"{q}{f}", f"{lib}{f}"), POINTS[f]).otherwise(0.0), POINTS, total)


FIELDS = ["family", *POINTS]
#: What all overlaps together can give; a row that loses as much scores 0 or less with any query.
MOST_POINTS = int(FAMILY_POINTS + sum(POINTS.values()))
#: Distinct tokens of the queries that are broadcast at most.
TOKENS = 10_000
#: Library rows in the first list for queries that lack rows, for each row wanted.
LISTED = 8


def signed(df: DataFrame) -> DataFrame:
    """The rows with ``sig``, a digest of family and token sets."""
    sets = [F.array_sort(F.array_distinct(F.coalesce(F.filter(f, lambda x: x.isNotNull()), F.array().cast("array<string>")))) for f in POINTS]
    return df.withColumns(dict(zip(POINTS, sets))).withColumn("sig", F.md5(F.to_json(F.struct(*FIELDS)).cast("binary")))


def asked_only(library: DataFrame, queries: DataFrame) -> DataFrame:
    """The library's token sets without tokens that no query has, which no score depends on: so fewer signatures differ.

    Queries with over ``TOKENS`` tokens leave the sets as they are."""
    tokens = [queries.select(F.explode(f).alias("t"), F.lit(f).alias("f")) for f in POINTS]
    distinct = reduce(DataFrame.unionAll, tokens).distinct()
    if distinct.count() > TOKENS:
        return library
    known = distinct.agg(*(F.collect_list(F.when(F.col("f") == f, F.col("t"))).alias(f"__{f}") for f in POINTS))
    return library.crossJoin(F.broadcast(known)).withColumns({f: F.array_intersect(f, f"__{f}") for f in POINTS}).drop(*(f"__{f}" for f in POINTS))


def _keys(df: DataFrame, name: str) -> DataFrame:
    def named(f: str) -> Column:
        return F.transform(f, lambda x: F.concat(F.lit(f"{f}="), x))

    fields = [F.array(F.concat(F.lit("family="), F.col("family"))), *map(named, POINTS)]
    return df.select(F.col("sig").alias(name), F.explode(F.filter(F.concat(*fields), lambda x: x.isNotNull())).alias("token"))


def _named(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    return df.select(F.col("sig").alias(f"{prefix}sig"), *(F.col(c).alias(prefix + c) for c in (*FIELDS, *more)))


def _fill(short: DataFrame, lib: DataFrame, k: int) -> DataFrame:
    """``q_sig, library_id, score``: for each of the signatures the first k rows, in the order of loss, that it overlaps with in nothing.

    Lists of the library's best rows go out to the signatures, each list eight times as long as the one before, until all
    have their rows or the library ends. Rows with a loss under 1 that overlap score above 0, and a signature that is
    short has fewer than k of those, so the first list serves wherever the library has some rows of small loss.
    """
    found, lack, size, upto = None, _named(short, "q_").withColumn("have", F.lit(0).cast("long")), LISTED * k, 0
    total = lib.count()
    while upto < total:
        best = lib.orderBy("loss", "library_id").offset(upto).limit(size).select("library_id", "loss", *FIELDS)
        listed = best.agg(F.array_sort(F.collect_list(F.struct("loss", "library_id", *FIELDS))).alias("l"))
        apart = lambda r: ~F.coalesce(F.col("q_family") == r["family"], F.lit(False)) & reduce(lambda a, f: a & ~F.arrays_overlap(F.col(f"q_{f}"), r[f]), POINTS, F.lit(True))
        got = lack.crossJoin(F.broadcast(listed)).withColumn("l", F.slice(F.filter("l", apart), 1, k))
        rows = got.select("q_sig", F.explode("l").alias("r")).select("q_sig", F.col("r.library_id").alias("library_id"), (-F.col("r.loss")).alias("score"))
        found = rows if found is None else found.unionAll(rows)
        upto, size = upto + size, size * 8
        if upto >= total:
            break
        lack = got.withColumn("have", F.col("have") + F.size("l")).where(F.col("have") < k).drop("l")
        if lack.isEmpty():
            break
    return found if found is not None else lack.select("q_sig", F.lit(None).cast(lib.schema["library_id"].dataType).alias("library_id"), F.lit(0.0).alias("score")).where("false")


def top_k(queries: DataFrame, library: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, library_id, score, candidate_count``: the k best library rows of each query, ties to the smaller id.

    Both sides hold ``family`` and the arrays ``verbs, objects, targets, spatial``; the library ``t`` and ``quality`` too.
    ``candidate_count`` is how many rows score above 0. Rows that score 0 or less fill up the k.
    """
    scratch = Scratch(queries.sparkSession)
    asked = scratch.write(signed(queries).select("query_id", "sig", *FIELDS), "queries")
    lib = signed(asked_only(library.withColumn("loss", penalty("t", "quality")), asked)).select("library_id", "loss", "sig", *FIELDS)
    lib = scratch.write(lib, "library")
    asked_sigs = asked.select("sig", *FIELDS).dropDuplicates(["sig"])
    under = F.array(*(F.count_if(F.col("loss") < p) for p in range(MOST_POINTS + 1)))
    sums = lib.groupBy("sig").agg(*(F.first(f).alias(f) for f in FIELDS), under.alias("under"))
    place = F.row_number().over(Window.partitionBy("sig").orderBy("loss", "library_id"))
    few = lib.withColumn("n", place).where(F.col("n") <= k).groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("loss", "library_id"))).alias("few"))
    library_sigs = scratch.write(sums.join(few, "sig"), "signatures")

    pairs = _keys(asked_sigs, "q_sig").join(_keys(library_sigs, "l_sig"), "token").select("q_sig", "l_sig").distinct()
    met = pairs.join(_named(asked_sigs, "q_"), "q_sig").join(_named(library_sigs, "l_", "under", "few"), "l_sig")
    points = overlap_points("q_", "l_")
    met = met.select("q_sig", "l_sig", points.alias("points"), F.element_at("l_under", points.cast("int") + 1).alias("above"), F.col("l_few")[0].alias("top"))
    met = scratch.write(met, "met")
    best = Window.partitionBy("q_sig").orderBy(F.desc(F.col("points") - F.col("top.loss")), F.col("top.library_id"))
    counts = scratch.write(met.groupBy("q_sig").agg(F.sum("above").alias("candidate_count")), "counts")
    chosen = met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("q_sig", "l_sig", "points")
    first = chosen.join(library_sigs.select(F.col("sig").alias("l_sig"), "few"), "l_sig").select("q_sig", "points", F.explode("few").alias("r"))
    rows = first.select("q_sig", F.col("r.library_id").alias("library_id"), (F.col("points") - F.col("r.loss")).alias("score"))
    short = asked_sigs.join(counts.where(F.col("candidate_count") >= k), asked_sigs["sig"] == counts["q_sig"], "left_anti")
    rows = rows.unionByName(_fill(short, lib, k))
    order = Window.partitionBy("q_sig").orderBy(F.desc("score"), "library_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(counts, "q_sig", "left")
    out = asked.select("query_id", F.col("sig").alias("q_sig")).join(ranked, "q_sig")
    return out.select("query_id", "rank", "library_id", rounded("score").alias("score"), F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"))


def candidates(top: DataFrame, library: DataFrame, fields: list[str]) -> DataFrame:
    """One row a query with its candidates as an array of structs, best first."""
    full = top.join(library.select("library_id", *fields), "library_id", "left")
    return full.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "library_id", "score", *fields))).alias("retrieved_candidates"), F.first("candidate_count").alias("candidate_count"))

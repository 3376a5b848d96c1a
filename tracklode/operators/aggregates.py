"""Counts, top lists, histograms and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklode.functions.expr import col, finite, items, rounded
from tracklode.operators.quantiles import quantile_row


def most_common(df: DataFrame, column: str, by: list[str] | None = None, top: int | None = None) -> DataFrame:
    """Counts by value, most frequent first, ties by value; with ``top`` only so many."""
    out = df.groupBy(*(by or []), column).agg(F.count("*").alias("n")).orderBy(*(by or []), F.desc("n"), column)
    return out.limit(top) if top else out


def token_counts(df: DataFrame, column: Column | str, pattern: str = ";", top: int | None = None, first: int | None = None) -> DataFrame:
    """Counts of the parts of a delimited text; ``first`` takes only the first parts of each row."""
    parts = items(column, pattern)
    parts = F.slice(parts, 1, first) if first else parts
    return most_common(df.select(F.explode(parts).alias("token")), "token", top=top)


def array_counts(df: DataFrame, column: Column | str, top: int | None = None) -> DataFrame:
    return most_common(df.select(F.explode(col(column)).alias("token")), "token", top=top)


def evidence_counts(df: DataFrame, decision: str, evidence: str, decisions: tuple[str, ...] = ("REJECT", "DPO_LOSER_CANDIDATE"), top: int = 12) -> DataFrame:
    """Most frequent of the first two pieces of evidence of rows with one of the decisions."""
    return token_counts(df.where(F.col(decision).isin(*decisions)), evidence, r"\|", top=top, first=2)


def fixed_counts(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Counts of given values in their order, with zeros for those that do not occur."""
    dim = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(values)], "place int, value string")
    got = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return dim.join(got, "value", "left").select("place", "value", F.coalesce("n", F.lit(0)).alias("n"))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median, 95th percentile and maximum of each column's finite numbers, a row a column."""
    def one(c: str) -> list[Column]:
        v = finite(c)
        return [F.avg(v).alias(f"{c}_0"), F.max(v).alias(f"{c}_2")]

    middle = quantile_row(df, {f"{c}_{q}": (finite(c), q / 100) for c in columns for q in (50, 95)})
    wide = df.agg(*(x for c in columns for x in one(c))).crossJoin(F.broadcast(middle))
    rows = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(f"{c}_0").alias("mean"), F.col(f"{c}_50").alias("p50"), F.col(f"{c}_95").alias("p95"), F.col(f"{c}_2").cast("double").alias("max")) for c in columns))
    return wide.select(F.inline(rows)).select("metric", *(rounded(c).alias(c) for c in ("mean", "p50", "p95", "max")))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """``bin, n`` over equal bins; the last bin holds its upper end, values outside are left out."""
    v = finite(column)
    at = F.least(F.floor((v - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.where((v >= low) & (v <= high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def domain_gap(df: DataFrame, split: str, features: list[str], first: str, second: str) -> DataFrame:
    """Means of each feature in two splits, and the second less the first."""
    mean = lambda f, s: F.avg(F.when(F.col(split) == s, F.col(f)))
    wide = df.agg(*(mean(f, s).alias(f"{f}_{k}") for f in features for k, s in enumerate((first, second))))
    rows = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"{f}_0").alias("a"), F.col(f"{f}_1").alias("b")) for f in features))
    return wide.select(F.inline(rows)).select("feature", rounded("a").alias("a"), rounded("b").alias("b"), rounded(F.col("b") - F.col("a")).alias("gap"))


def split_summary(df: DataFrame, split: str, key: str, modalities: list[str], level: str) -> DataFrame:
    """Rows, smallest and largest id, missing values by modality, and the distinct levels of each split."""
    return df.groupBy(split).agg(F.count("*").alias("n"), F.min(key).alias("min_id"), F.max(key).alias("max_id"), *(F.count_if(F.col(m).isNull()).alias(f"missing_{m}") for m in modalities), F.array_join(F.array_sort(F.collect_set(level)), ";").alias("levels"))


def step_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *(F.count_if(c).alias(n) for n, c in conditions.items()))


def retrieval_report(df: DataFrame, count: str, score: str) -> DataFrame:
    s = F.col(score)
    return df.agg(F.count("*").alias("queries"), F.count_if(F.col(count) == 0).alias("without"), rounded(F.avg(count)).alias("mean_candidates"), F.count_if(s <= 0).alias("le_0"), F.count_if((s > 0) & (s <= 3)).alias("le_3"), F.count_if((s > 3) & (s <= 6)).alias("le_6"), F.count_if(s > 6).alias("gt_6"))


def embodiment_ranking(df: DataFrame, key: str, success: str, exportable: str, distance: str) -> DataFrame:
    """Score of each robot by trial runs: ten a success, five an exportable run, less the mean distance (999 where 0 or missing)."""
    d = F.coalesce(F.nullif(F.col(distance), F.lit(0.0)), F.lit(999.0))
    score = 10 * F.sum(F.col(success).cast("int")) + 5 * F.sum(F.col(exportable).cast("int")) - F.avg(d)
    return df.groupBy(key).agg(rounded(score).alias("score")).orderBy(F.desc("score"), key)


def selected_embodiment(ranking: DataFrame, key: str, default: str) -> DataFrame:
    """One row ``key, score, reason``: the best robot of a ranking, or the default if there is none."""
    best = ranking.agg(F.max_by(F.struct(key, "score"), F.struct(F.col("score"), F.reverse(F.col(key)))).alias("b"))
    found = F.col("b").isNotNull()
    return best.select(F.coalesce(f"b.{key}", F.lit(default)).alias(key), F.col("b.score").alias("score"), F.when(found, "best score").otherwise("no successful trial, default").alias("reason"))


def robust_max(value: Column | str, share: float | None = None) -> Column:
    """Aggregate of one group: the largest finite value, or the one at a share of all; 0 without values."""
    v = finite(value)
    return F.coalesce(F.percentile(v, share) if share is not None else F.max(v), F.lit(0.0))


def first_rows_mean(df: DataFrame, order: list[str], features: list[str], n: int = 80) -> DataFrame:
    return df.orderBy(*order).limit(n).agg(*(F.avg(f).alias(f) for f in features))


def readable_totals(df: DataFrame, by: str, readable: str) -> DataFrame:
    ok = F.coalesce(F.col(readable), F.lit(False))
    return df.groupBy(by).agg(F.count("*").alias("total"), F.count_if(ok).alias("readable"), F.count_if(~ok).alias("unreadable"))


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows, all columns in the order first seen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)

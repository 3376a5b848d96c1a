"""Exact quantiles of whole tables, without a buffer that holds all values.

Rows are counted by value before anything is ordered. A sketch cuts the values to ranges of about equal size, the
ranges' counts tell in which of them a rank lies, and only the values of those ranges are ordered, each range apart.
The sketch moves borders of ranges and no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges of a group's values, and how finely the sketch that cuts them is made.
RANGES, ACCURACY = 1024, 10_000


def cut_points(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, __cuts``: rising values that cut each group's rows to about ``RANGES`` equal parts."""
    shares = F.array(*(F.lit(i / RANGES) for i in range(1, RANGES)))
    return rows.groupBy(*by).agg(F.array_sort(F.array_distinct(F.percentile_approx(value, shares, ACCURACY))).alias("__cuts"))


def range_of(value: str, cuts: str = "__cuts") -> Column:
    """How many of the rising cuts lie under the value: the number of its range, found by halving."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(RANGES.bit_length()))))
    further = lambda at, step: (at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) < F.col(value))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``by`` and a column for each name: the value at that share of a group's rows in order, between two of them their
    linear mean. Nulls are left out; a group without values has nulls. Without ``by`` there is always one row.

    ``by`` is for few groups (dimensions, columns): the cuts of all go out together, 8 kB each.
    """
    kept = rows.select(*by, F.col(value).cast("double").alias("__v"))
    keys = by or [F.lit(0).alias("__g")]
    kept = kept.select("*", *([] if by else keys))
    names = by or ["__g"]
    groups = kept.select(*names).distinct() if by else kept.sparkSession.range(1).select(F.lit(0).alias("__g"))
    held = kept.where(F.col("__v").isNotNull())
    counts = held.groupBy(*names, "__v").agg(F.count("*").alias("__n"))
    placed = counts.join(F.broadcast(cut_points(held, names, "__v")), names)
    placed = placed.select(*names, "__v", "__n", range_of("__v").alias("__r"))
    sums = placed.groupBy(*names, "__r").agg(F.sum("__n").alias("__s"))
    line = Window.partitionBy(*names).orderBy("__r")
    before = F.sum("__s").over(line) - F.col("__s")
    every = F.sum("__s").over(Window.partitionBy(*names))
    ends = sums.select(*names, "__r", "__s", before.alias("__b"), every.alias("__all"))
    # the rank of each share, its fraction, and the ranges that hold the rank and the one after it
    rank = lambda p: (F.col("__all") - 1) * F.lit(p)
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), F.floor(rank(p)).alias("low"), F.ceil(rank(p)).alias("high"), (F.ceil(rank(p)) - rank(p)).alias("of_low"), (rank(p) - F.floor(rank(p))).alias("of_high")) for n, p in shares.items()))
    inside = lambda at: (F.col("__b") <= at) & (at < F.col("__b") + F.col("__s"))
    asked = ends.select("*", F.explode(wanted).alias("__w")).where(inside(F.col("__w.low")) | inside(F.col("__w.high")))
    per_range = asked.groupBy(*names, "__r", "__b").agg(F.collect_set("__w").alias("__ws"))
    within = Window.partitionBy(*names, "__r").orderBy("__v")
    near = placed.join(F.broadcast(per_range), [*names, "__r"])
    near = near.withColumn("__to", F.col("__b") + F.sum("__n").over(within)).withColumn("__from", F.col("__to") - F.col("__n"))
    hit = near.select(*names, "__v", "__from", "__to", F.explode("__ws").alias("__w"))
    has = lambda at: (F.col("__from") <= at) & (at < F.col("__to"))
    out = hit.where(has(F.col("__w.low")) | has(F.col("__w.high"))).groupBy(*names)
    mark = lambda n: F.col("__w.name") == n

    def one(n: str) -> Column:
        low, high = (F.max(F.when(mark(n) & has(F.col(f"__w.{side}")), F.col("__v"))) for side in ("low", "high"))
        of_low, of_high = (F.max(F.when(mark(n), F.col(f"__w.of_{side}"))) for side in ("low", "high"))
        return F.when(low == high, low).otherwise(of_low * low + of_high * high).alias(n)

    found = out.agg(*(one(n) for n in shares))
    return groups.join(F.broadcast(found), names, "left").select(*by, *shares)


def quantile_row(rows: DataFrame, wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row with a column for each name: the quantile of an expression, all from one pass over the rows."""
    kinds = list(dict.fromkeys(str(c) for c, _ in wanted.values()))
    values = {str(c): c for c, _ in wanted.values()}
    long = rows.select(F.inline(F.array(*(F.struct(F.lit(i).alias("__k"), values[k].cast("double").alias("__x")) for i, k in enumerate(kinds)))))
    found = quantiles(long.where(F.col("__x").isNotNull()), ["__k"], "__x", {n: p for n, (_, p) in wanted.items()})
    return found.agg(*(F.max(F.when(F.col("__k") == kinds.index(str(c)), F.col(n))).alias(n) for n, (c, _) in wanted.items()))

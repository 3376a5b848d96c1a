"""Deterministic samples: orders come from arithmetic hashes of ids, so any run and any engine draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.functions.expr import arithmetic_hash, col, quantile_bin
from tracklode.operators.quantiles import cut_points, range_of


def first_per_group(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    return first_per_group(df, keys, order, 1)


def simple_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows, or all if there are fewer; a top-n over the hash, so no full sort."""
    return df.orderBy(arithmetic_hash(key), key).limit(n)


def sample_per_class(df: DataFrame, label: str, key: str, n: int) -> DataFrame:
    return first_per_group(df, [label], [arithmetic_hash(key), F.col(key)], n)


def ratio_sample(df: DataFrame, label: str, key: str, ratio: float) -> DataFrame:
    """A share of each class in hash order, one row at least. Only rows of the hash at a class's cut are numbered."""
    h = arithmetic_hash(key)
    take = F.greatest(F.lit(1).cast("long"), F.floor(F.col("all") * ratio))
    rows = df.withColumn("__h", h)
    cuts = hash_cuts(rows.select(F.col(label).alias("__label"), "__h"), ["__label"], take)
    return first_of_hash_order(rows, cuts, key, F.col(label).eqNullSafe(F.col("__label"))).select(*df.columns)


def hash_cuts(rows: DataFrame, by: list[str], take: Column) -> DataFrame:
    """``by, __cut, __room``: the hash at which the first ``take`` rows (of ``all``) of each group end, and how many rows of it belong to
    them. Rows are counted by hash, of which there are 1,000,003 at most, before anything is ordered."""
    names = by or ["__one"]
    counts = rows.withColumns({} if by else {"__one": F.lit(0)}).groupBy(*names, "__h").agg(F.count("*").alias("n"))
    line = Window.partitionBy(*names)
    run = counts.withColumns({"upto": F.sum("n").over(line.orderBy("__h")), "all": F.sum("n").over(line)}).withColumn("take", take)
    first = F.min(F.when(F.col("upto") >= F.col("take"), F.struct(F.col("__h").alias("h"), (F.col("take") - F.col("upto") + F.col("n")).alias("room"))))
    return run.groupBy(*names).agg(first.alias("c")).select(*by, F.col("c.h").alias("__cut"), F.col("c.room").alias("__room"))


def first_of_hash_order(rows: DataFrame, cuts: DataFrame, key: str, on: Column | None) -> DataFrame:
    """The rows before their group's cut, and of those at the cut the first by key."""
    both = rows.join(cuts, on) if on is not None else rows.crossJoin(F.broadcast(cuts))
    group = [c for c in cuts.columns if c not in ("__cut", "__room")]
    edge = both.where(F.col("__h") == F.col("__cut")).withColumn("__n", F.row_number().over(Window.partitionBy(*group, "__h").orderBy(key)))
    return both.where(F.col("__h") < F.col("__cut")).unionByName(edge.where(F.col("__n") <= F.col("__room")).drop("__n"))


def train_split(df: DataFrame, key: str, share: float = 0.9) -> DataFrame:
    """Adds ``split``: the first ``share`` of the rows in hash order are train, the rest val.

    The cut is the exact quantile row of the hash order, found by one aggregate over distinct hashes (at most 1,000,003),
    so rows need no global order: those of the hash at the cut are numbered, others are decided by the hash alone.
    """
    rows = df.withColumn("__h", arithmetic_hash(key))
    cut = hash_cuts(rows.select("__h"), [], F.floor(F.col("all") * share))
    both = rows.crossJoin(F.broadcast(cut))
    named = lambda x, train: x.withColumn("split", F.when(train, "train").otherwise("val")).select(*df.columns, "split")
    edge = both.where(F.col("__h") == F.col("__cut")).withColumn("__n", F.row_number().over(Window.partitionBy("__h").orderBy(key)))
    return named(both.where(F.col("__h") != F.col("__cut")), F.col("__h") < F.col("__cut")).unionAll(named(edge, F.col("__n") <= F.col("__room")))


def style_choice(key: Column | str, styles: list[tuple[str, int]]) -> Column:
    """One of several styles by shares in per cent, as the id's hash falls."""
    at, upto, out = F.pmod(arithmetic_hash(key), F.lit(100)), 0, None
    for name, share in styles:
        upto += share
        out = F.when(at < upto, name) if out is None else out.when(at < upto, name)
    return out.otherwise(styles[-1][0])


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """``__v, __n, __less, __all``: each distinct value, its rows, the rows of smaller values, and all rows. Null is the smallest.

    Rows are counted by value before anything is ordered; values are ordered within ranges that a sketch of quantiles cuts, and
    only the ranges' sums are ordered in one place.
    """
    counts = df.groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    ends = counts.agg(F.sum("__n").alias("__all")).crossJoin(F.broadcast(cut_points(counts, [], "__v")))
    placed = counts.crossJoin(F.broadcast(ends)).withColumn("__r", F.when(F.col("__v").isNull(), F.lit(-1)).otherwise(range_of("__v")))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("__r").agg(F.sum("__n").alias("__s")).select("__r", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__b"))
    within = Window.partitionBy("__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("__w", F.coalesce(F.sum("__n").over(within), F.lit(0))).join(ranges, "__r")
    return out.select("__v", "__n", (F.col("__b") + F.col("__w")).alias("__less"), "__all")


def _ranked(df: DataFrame, value: str) -> DataFrame:
    ranks = value_ranks(df, value)
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__v")))


def percent_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds rank over count, ties sharing the mean of their ranks."""
    rank = F.col("__less") + (F.col("__n") + 1) / 2
    return _ranked(df, value).withColumn(name, rank / F.col("__all")).select(*df.columns, name)


def with_bins(df: DataFrame, value: str, key: str, bins: int, name: str) -> DataFrame:
    """Adds the quantile bin of a value, ties dealt in the order of the key."""
    rows = _ranked(df, value).withColumn("__k", F.row_number().over(Window.partitionBy("__v").orderBy(key)))
    return rows.withColumn(name, quantile_bin(F.col("__less") + F.col("__k"), F.col("__all"), bins)).select(*df.columns, name)


def stratified_sample(df: DataFrame, strata: list[str], key: str, n: int) -> DataFrame:
    """``n`` rows, one of each stratum in turn, strata and rows in hash order; strata that run out are passed over."""
    rows = df.withColumn("__turn", F.row_number().over(Window.partitionBy(*strata).orderBy(arithmetic_hash(key), key))).where(F.col("__turn") <= n)
    return rows.orderBy("__turn", *strata).limit(n).drop("__turn")


def composed_sample(df: DataFrame, key: str, n_random: int, n_hard: int, n: int, hard: Column | str) -> DataFrame:
    """Random rows, then the hardest of the rest, then more random ones up to ``n``; no row twice. ``sample_group`` names each part."""
    first = simple_sample(df, key, n_random).withColumn("sample_group", F.lit("random"))
    rest = df.join(first.select(key), key, "left_anti")
    second = rest.orderBy(col(hard).desc(), key).limit(n_hard).withColumn("sample_group", F.lit("hard"))
    left = rest.join(second.select(key), key, "left_anti")
    third = simple_sample(left, key, max(0, n - n_random - n_hard)).withColumn("sample_group", F.lit("fill"))
    return first.unionByName(second).unionByName(third)


def next_unlabelled(df: DataFrame, index: str, label: str, after: int) -> DataFrame:
    """The next row without a label after an index, else the first such row, else 0."""
    free = F.coalesce(label, F.lit("")) == ""
    return df.agg(F.coalesce(F.min(F.when(free & (F.col(index) > after), F.col(index))), F.min(F.when(free, F.col(index))), F.lit(0)).alias("next"))


def filtered_or_all(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet the condition; all rows if none does."""
    found = df.where(condition)
    return found.unionAll(df.join(F.broadcast(found.agg(F.count("*").alias("__n"))), F.col("__n") == 0).drop("__n"))

"""Trajectory statistics over long tables: one row a time step, scalar or array values.

Each operator is a window over ``keys`` ordered by a unique time, then an aggregate on the same keys, so the shuffle of
the window serves both. Corpus-wide thresholds are one aggregate row, joined by broadcast: its size is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.functions.expr import clamp, col, finite, l2, minus, quaternion_norm, reasons, rounded
from tracklode.operators.quantiles import quantile_row, quantiles


def steps(df: DataFrame, keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def deltas(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "delta") -> DataFrame:
    """Size of the step from the row before (null on the first row); what is not finite counts as 0."""
    before = F.lag(value).over(steps(df, keys, order))
    if df.schema[value].dataType.typeName() == "array":
        return df.withColumn(name, F.when(before.isNotNull(), l2(minus(value, before))))
    gap = F.abs(F.col(value) - before)
    return df.withColumn(name, F.when(before.isNotNull(), F.coalesce(finite(gap), F.lit(0.0))))


def _middle(few: Column, low: Column, high: Column, p05: Column, p95: Column) -> Column:
    return F.coalesce(F.when(few, (low + high) / 2).otherwise((p05 + p95) / 2), F.lit(0.5))


def binary_threshold(value: Column | str) -> Column:
    """Aggregate of one episode: the middle of a signal's two levels. With at most 8 distinct values the middle of the extremes,
    else of the 5th and 95th percentile; 0.5 without values. Its buffer holds the distinct values: ``thresholds`` serves whole tables."""
    v = finite(value)
    return _middle(F.count_distinct(F.round(v, 6)) <= 8, F.min(F.round(v, 6)), F.max(F.round(v, 6)), F.percentile(v, 0.05), F.percentile(v, 0.95))


def thresholds(moved: DataFrame, value: str, delta: str = "delta") -> DataFrame:
    """One row of corpus-wide thresholds: pause (p10), active (p25), spike (p99), mean and p95 of the steps, and the signal's middle."""
    d, v = finite(delta), finite(value)
    # distinct values end after nine: whether there are more is all that counts
    nine = moved.select(F.round(v, 6).alias("v")).where("v is not null").distinct().limit(9).agg((F.count("*") <= 8).alias("few"))
    one = moved.agg(F.avg(d).alias("mean"), F.min(F.round(v, 6)).alias("low"), F.max(F.round(v, 6)).alias("high")).crossJoin(F.broadcast(nine))
    shares = {"p10": (d, 0.10), "p25": (d, 0.25), "p95": (d, 0.95), "p99": (d, 0.99), "v05": (v, 0.05), "v95": (v, 0.95)}
    both = one.crossJoin(F.broadcast(quantile_row(moved, shares)))
    get = lambda n, x: F.coalesce(F.col(n), F.lit(x))
    grip = _middle(*map(F.col, ("few", "low", "high", "v05", "v95")))
    return both.select(get("p10", 1e-6).alias("pause_thr"), get("p25", 1e-4).alias("active_thr"), get("p95", 1.0).alias("p95_ref"), get("p99", 1.0).alias("spike_thr"), get("mean", 1.0).alias("mean_ref"), grip.alias("grip_thr"))


def complexity(mean: Column, p95: Column, mean_ref: Column, p95_ref: Column, bimanual: Column, transitions: Column, segments: Column) -> Column:
    pull = F.least(mean / F.greatest(mean_ref, F.lit(1e-9)), F.lit(3.0)) + F.least(p95 / F.greatest(p95_ref, F.lit(1e-9)), F.lit(3.0))
    size = F.when(mean.isNotNull(), pull).otherwise(0.0)  # an episode of one step has no deltas
    return F.least(size + bimanual * 1.5 + F.least(transitions / 6.0, F.lit(1.5)) + F.least(segments / 8.0, F.lit(1.0)), F.lit(10.0))


def dominant_arm(left: Column | str, right: Column | str) -> Column:
    left, right = col(left), col(right)
    return F.when(left > right * 1.15, "left").when(right > left * 1.15, "right").otherwise("balanced")


def flagged(moved: DataFrame, keys: list[str], order: list[str], value: str, limits: DataFrame) -> DataFrame:
    """The steps with ``active`` (over the pause threshold), ``edge`` (first of an active stretch) and ``switch`` (the signal crosses
    its middle)."""
    w = steps(moved, keys, order)
    wide = moved.crossJoin(F.broadcast(limits))
    wide = wide.withColumn("active", F.col("delta") > F.col("pause_thr"))
    up = F.coalesce(finite(value), F.col("grip_thr")) > F.col("grip_thr")
    return wide.withColumns({
        "edge": F.coalesce(F.col("active"), F.lit(False)) & ~F.coalesce(F.lag("active").over(w), F.lit(False)),
        "switch": F.coalesce(up != F.lag(up).over(w), F.lit(False)),
    })


def episode_stats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """One row an episode: steps, step sizes, pause, spike and active shares, segments, transitions, complexity."""
    moved = deltas(df.select(*keys, *order, value), keys, order, value)
    rows = flagged(moved, keys, order, value, thresholds(moved, value))
    d = F.col("delta")
    share = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("t"), F.avg(d).alias("delta_mean"), F.percentile(d, 0.95).alias("delta_p95"), F.max(d).alias("delta_max"), F.stddev_pop(d).alias("delta_std"),
        F.coalesce(F.sum(d), F.lit(0.0)).alias("motion"), share(d <= F.col("pause_thr")).alias("pause_ratio"), share(d >= F.col("spike_thr")).alias("spike_ratio"), share(d > F.col("active_thr")).alias("active_ratio"),
        F.count_if("edge").alias("segments"), F.count_if("switch").alias("transitions"), F.first("mean_ref").alias("mean_ref"), F.first("p95_ref").alias("p95_ref"),
    )
    score = complexity(F.col("delta_mean"), F.col("delta_p95"), F.col("mean_ref"), F.col("p95_ref"), F.lit(0.0), F.col("transitions"), F.col("segments"))
    names = ("delta_mean", "delta_p95", "delta_max", "delta_std", "motion", "pause_ratio", "spike_ratio", "active_ratio")
    return out.select(*keys, "t", *(rounded(n).alias(n) for n in names), "segments", "transitions", rounded(score).alias("complexity"))


def transition_stats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Percentiles of the steps, and counts of pauses and spikes."""
    moved = deltas(df.select(*keys, *order, value), keys, order, value)
    rows = moved.crossJoin(F.broadcast(thresholds(moved, value)))
    p = F.percentile("delta", F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99))))
    out = rows.groupBy(*keys).agg(F.count("delta").alias("n"), p.alias("p"), F.count_if(F.col("delta") <= F.col("pause_thr")).alias("pauses"), F.count_if(F.col("delta") >= F.col("spike_thr")).alias("spikes"))
    return out.select(*keys, "n", *(rounded(F.col("p")[i]).alias(f"p{q}") for i, q in enumerate((50, 90, 95, 99))), "pauses", "spikes")


def two_arm_stats(df: DataFrame, keys: list[str], order: list[str], left: str, right: str) -> DataFrame:
    """Motion of two arms, the share of steps in which both move, and the dominant arm."""
    base = df.select(*keys, *order, left, right)
    moved = deltas(deltas(base, keys, order, left, "dl"), keys, order, right, "dr")
    both = moved.select(F.explode(F.array("dl", "dr")).alias("d"))
    limit = quantiles(both, [], "d", {"q": 0.25}).select(F.coalesce("q", F.lit(1e-4)).alias("active_thr"))
    rows = moved.crossJoin(F.broadcast(limit))
    on = lambda c: (F.col(c) > F.col("active_thr")).cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = rows.groupBy(*keys).agg(
        zero(F.sum("dl")).alias("left_motion"), zero(F.sum("dr")).alias("right_motion"), zero(F.avg(on("dl"))).alias("left_active"), zero(F.avg(on("dr"))).alias("right_active"), zero(F.avg(on("dl") * on("dr"))).alias("bimanual_ratio"),
    )
    return out.select(*keys, *(rounded(c).alias(c) for c in out.columns[len(keys) :]), dominant_arm("left_motion", "right_motion").alias("dominant_arm"))


def quaternion_stats(df: DataFrame, keys: list[str], pose: str) -> DataFrame:
    n = quaternion_norm(pose)
    gap = F.abs(n - 1)
    out = df.groupBy(*keys).agg(F.avg(n).alias("norm_mean"), F.stddev_pop(n).alias("norm_std"), F.max(gap).alias("max_abs_dev"), F.avg((gap <= 0.05).cast("double")).alias("close_ratio"))
    return out.select(*keys, *(rounded(c).alias(c) for c in ("norm_mean", "norm_std", "max_abs_dev", "close_ratio")))


def dim_stats(df: DataFrame, keys: list[str], values: str) -> DataFrame:
    """Per dimension of an array: extremes, percentiles, mean, deviation, share of episodes in which it is constant, and
    counts of NaN and infinity. Only finite values count for the rest."""
    long = df.select(*keys, F.posexplode(values).alias("dim", "raw")).withColumn("raw", F.col("raw").cast("double"))
    long = long.withColumn("x", finite("raw"))
    flat = long.groupBy(*keys, "dim").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.max(F.abs("x")).alias("most"))
    still = flat.groupBy("dim").agg(F.avg(F.coalesce((F.col("high") - F.col("low") <= 1e-8) | (F.col("most") <= 1e-8), F.lit(True)).cast("double")).alias("constant_ratio"))
    all_ = long.groupBy("dim").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count_if(F.isnan("raw")).alias("nan_count"), F.count_if(F.abs("raw") == float("inf")).alias("inf_count"))
    p = quantiles(long, ["dim"], "x", {f"p{q:02d}": q / 100 for q in (1, 5, 50, 95, 99)})
    picked = all_.join(p, "dim").join(still, "dim")
    return picked.select("dim", *(rounded(c).alias(c) for c in ("low", "high", "mean", "std", "p01", "p05", "p50", "p95", "p99", "constant_ratio")), "nan_count", "inf_count")


def longest_run(df: DataFrame, keys: list[str], order: list[str], condition: Column) -> DataFrame:
    """``n_runs, longest``: stretches of rows on which the condition holds."""
    w = steps(df, keys, order)
    rows = df.withColumn("on", F.coalesce(condition, F.lit(False))).withColumn("i", F.row_number().over(w))
    islands = rows.withColumn("island", F.col("i") - F.row_number().over(Window.partitionBy(*keys, "on").orderBy(*order)))
    runs = islands.groupBy(*keys, "on", "island").agg(F.count("*").alias("length"))
    return runs.groupBy(*keys).agg(F.count_if("on").alias("n_runs"), F.coalesce(F.max(F.when(F.col("on"), F.col("length"))), F.lit(0)).cast("long").alias("longest"))


def contact_score(events: Column | str, no_contact: Column | str, longest: Column | str) -> Column:
    """Share of motion events without contact, if there are two and two of them in a row."""
    return F.when((col(events) >= 2) & (col(longest) >= 2), col(no_contact) / col(events)).otherwise(0.0)


def outliers(stats: DataFrame, t: str = "t", delta: str = "delta_max", score: str = "complexity") -> DataFrame:
    """Episodes at or over the 99th percentile of length, largest step or complexity, with the reasons."""
    limits = quantile_row(stats, {f"{n}_limit": (F.col(c), 0.99) for n, c in (("t", t), ("d", delta), ("c", score))})
    wide = stats.crossJoin(F.broadcast(limits))
    why = reasons((F.col(t) >= F.col("t_limit"), "trajectory_length_p99"), (F.col(delta) >= F.col("d_limit"), "delta_max_p99"), (F.col(score) >= F.col("c_limit"), "complexity_p99"))
    return wide.withColumn("outlier_reason", why).where("outlier_reason <> ''").drop("t_limit", "d_limit", "c_limit")


def summary(stats: DataFrame, t: str = "t") -> DataFrame:
    out = stats.agg(F.min(t).alias("t_min"), F.avg(t).alias("t_mean"), F.max(t).alias("t_max"))
    both = out.crossJoin(F.broadcast(quantiles(stats, [], t, {"t_median": 0.5, "t_p95": 0.95})))
    return both.select("t_min", "t_median", rounded("t_mean").alias("t_mean"), "t_p95", "t_max")


def normalise(df: DataFrame, values: str) -> tuple[DataFrame, DataFrame]:
    """The winsorised, standardised array of each row, and the table of limits by dimension.

    Limits are the 1st and 99th percentile of all rows; mean and deviation (plus 1e-6) are those of clipped values.
    The limits come back to the rows as two arrays in one row, as wide as the array.
    """
    long = df.select(F.posexplode(values).alias("dim", "x")).select("dim", F.col("x").cast("double").alias("x"))
    limits = quantiles(long, ["dim"], "x", {"p01": 0.01, "p99": 0.99})
    clipped = long.join(F.broadcast(limits), "dim").withColumn("x", clamp("x", F.col("p01"), F.col("p99")))
    config = clipped.groupBy("dim").agg(F.first("p01").alias("p01"), F.first("p99").alias("p99"), F.avg("x").alias("mean"), (F.stddev_pop("x") + 1e-6).alias("std"))
    packed = config.agg(F.array_sort(F.collect_list(F.struct("dim", "p01", "p99", "mean", "std"))).alias("cfg"))
    scaled = F.zip_with(values, "cfg", lambda x, c: (clamp(x.cast("double"), c["p01"], c["p99"]) - c["mean"]) / c["std"])
    return df.crossJoin(F.broadcast(packed)).withColumn("normalised", scaled).drop("cfg"), config


def adjacent_similarity(df: DataFrame, keys: list[str], order: list[str], vector: str) -> DataFrame:
    """Cosine of neighbouring vectors: mean and least, scene cut (1 less the least), and the share of near repeats."""
    from tracklode.functions.expr import cosine

    w = steps(df, keys, order)
    rows = df.select(*keys, *order, vector).withColumn("before", F.lag(vector).over(w)).where(F.col("before").isNotNull())
    rows = rows.withColumn("cos", cosine(vector, "before"))
    out = rows.groupBy(*keys).agg(F.avg("cos").alias("cos_mean"), F.min("cos").alias("cos_min"), F.avg((F.col("cos") > 0.999).cast("double")).alias("repeat_ratio"))
    return out.select(*keys, rounded("cos_mean").alias("cos_mean"), rounded("cos_min").alias("cos_min"), rounded(1 - F.col("cos_min")).alias("scene_cut"), rounded("repeat_ratio").alias("repeat_ratio"))


def blended_similarity(df: DataFrame, keys: list[str], order: list[str], first: str, second: str, share: float = 0.65) -> DataFrame:
    """Neighbours' cosines of two kinds of vectors, blended: mean and least of the blend, scene cut, and the least of each kind."""
    from tracklode.functions.expr import cosine

    w = steps(df, keys, order)
    a, b = (cosine(c, F.lag(c).over(w)) for c in (first, second))
    rows = df.select(*keys, a.alias("a"), b.alias("b")).withColumn("both", share * F.col("a") + (1 - share) * F.col("b"))
    out = rows.groupBy(*keys).agg(F.avg("both").alias("blend_mean"), F.min("both").alias("blend_min"), F.min("a").alias("first_min"), F.min("b").alias("second_min"))
    return out.select(*keys, *(rounded(c).alias(c) for c in out.columns[len(keys) :]), rounded(1 - F.col("blend_min")).alias("scene_cut"))


def identity_jump(cut: Column | str, least_clip: Column | str, least_dino: Column | str) -> Column:
    return (col(cut) > 0.55) & (col(least_clip) < 0.72) & (col(least_dino) < 0.45)


def motion_peaks(df: DataFrame, keys: list[str], order: list[str], value: str, n: int = 3) -> DataFrame:
    """The ``n`` rows of each key with the largest steps, ties to the earlier; ``peak`` counts from 1."""
    moved = deltas(df.select(*keys, *order, value), keys, order, value).where(F.col("delta").isNotNull())
    best = Window.partitionBy(*keys).orderBy(F.desc("delta"), *order)
    return moved.withColumn("peak", F.row_number().over(best)).where(F.col("peak") <= n).select(*keys, *order, "peak", rounded("delta").alias("delta"))


def peak_frames(position: Column | str, length: Column | str, frames: Column | str) -> Column:
    """Frame that a step of a trajectory falls on."""
    return F.bround(col(position) / F.greatest(col(length) - 1, F.lit(1)) * (col(frames) - 1)).cast("int")


def contract_reasons(values: Column, least_steps: int = 60, width: int = 14, needed: dict[str, Column] | None = None, poses: tuple[Column, ...] = ()) -> Column:
    """Why an episode's array of rows is refused; '' if it is not. ``needed`` are the series that must be there (arms and grips by
    name), ``poses`` those that must be as long as the actions where they are there."""
    bad = F.exists(values, lambda r: F.exists(r, lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    shape = F.exists(values, lambda r: F.size(r) != width)
    missing = values.isNull()
    lacking = [(c.isNull(), f"missing_{n}") for n, c in (needed or {}).items()]
    uneven = [(F.coalesce(F.size(p) != F.size(values), F.lit(False)), "pose_length_mismatch") for p in poses]
    said = reasons((shape, "action_shape_invalid"), *lacking, (F.size(values) < least_steps, "too_short"), (bad, "action_not_finite"), *uneven)
    return F.when(missing, "action_missing").otherwise(F.array_join(F.array_distinct(F.split(said, ";")), ";"))


def largest_steps(df: DataFrame, keys: list[str], order: list[str], series: list[str]) -> DataFrame:
    """Largest change between neighbouring rows of each series (luma, colour, foreground share); 0 for a single row."""
    w = steps(df, keys, order)
    rows = df.select(*keys, *(F.abs(F.col(c) - F.lag(c).over(w)).alias(c) for c in series))
    return rows.groupBy(*keys).agg(*(rounded(F.coalesce(F.max(finite(c)), F.lit(0.0))).alias(f"{c}_step") for c in series))


def motion_energy(df: DataFrame, keys: list[str], order: list[str], joint: str, arms: tuple[tuple[int, int], ...] = ((1, 6), (8, 6)), grips: tuple[int, ...] = (7, 14), middle: float = 0.5) -> DataFrame:
    """Mean step of the arms' joints, and how often the grippers cross the middle. ``arms`` are first joint and count, from 1."""
    w = steps(df, keys, order)
    arm = F.concat(*(F.slice(joint, a, n) for a, n in arms))
    rows = deltas(df.select(*keys, *order, joint, arm.alias("arm")), keys, order, "arm")
    for g in grips:
        up = F.coalesce(finite(F.get(joint, g - 1)), F.lit(middle)) > middle
        rows = rows.withColumn(f"__{g}", F.coalesce(up != F.lag(up).over(w), F.lit(False)).cast("int"))
    crossed = sum((F.sum(f"__{g}") for g in grips), F.lit(0))
    return rows.groupBy(*keys).agg(rounded(F.coalesce(F.avg("delta"), F.lit(0.0))).alias("motion_energy"), crossed.cast("long").alias("grip_transitions"))


def duplicate_ratio(df: DataFrame, keys: list[str], order: list[str], pixels: str, limit: float = 1.0) -> DataFrame:
    """Share of neighbouring frames whose mean absolute difference is under the limit."""
    before = F.lag(pixels).over(steps(df, keys, order))
    gap = F.aggregate(F.transform(minus(pixels, before), lambda x: F.abs(x)), F.lit(0.0), lambda s, x: s + x) / F.size(pixels)
    rows = df.select(*keys, F.when(before.isNotNull(), (gap < limit).cast("double")).alias("same"))
    return rows.groupBy(*keys).agg(rounded(F.coalesce(F.avg("same"), F.lit(0.0))).alias("duplicate_ratio"))

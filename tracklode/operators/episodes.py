"""The whole tables of an episode's actions: 42 columns of statistics, 20 of its steps, the outliers among them, and what to train on.

Input is a row a step: keys, an order, ``joint`` (14 wide), ``left_pose``, ``right_pose`` (7 wide) and ``left_grip``,
``right_grip``; poses and grips may be null. One window on the keys gives the steps, one aggregate on the same keys the
rows; what holds for the whole corpus comes from ``quantiles`` as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklode.functions.expr import finite, l2, minus, quaternion_norm, reasons, rounded
from tracklode.operators.quantiles import quantile_row
from tracklode.operators.trajectory import _middle, complexity, dominant_arm, steps

# Names of the columns, and places of the arms in a joint vector.
EPISODE_COLUMNS = [
    "T", "action_dim", "has_nan", "has_inf", "joint_action_min", "joint_action_max", "joint_action_mean_l2", "joint_delta_mean_l2", "joint_delta_max_l2", "joint_delta_p95_l2",
    "left_arm_motion_l2_sum", "right_arm_motion_l2_sum", "left_arm_active_ratio", "right_arm_active_ratio", "bimanual_active_ratio", "dominant_arm",
    "left_gripper_min", "left_gripper_max", "left_gripper_mean", "left_gripper_std", "right_gripper_min", "right_gripper_max", "right_gripper_mean", "right_gripper_std",
    "left_gripper_transition_count", "right_gripper_transition_count", "pause_ratio", "spike_ratio", "estimated_motion_segments", "action_complexity_score",
    "left_quat_norm_mean", "left_quat_norm_std", "left_quat_norm_max_abs_dev", "left_quat_norm_close_ratio",
    "right_quat_norm_mean", "right_quat_norm_std", "right_quat_norm_max_abs_dev", "right_quat_norm_close_ratio",
]
TRANSITION_COLUMNS = [
    "T", "transition_count", "delta_l2_min", "delta_l2_mean", "delta_l2_std", "delta_l2_p50", "delta_l2_p90", "delta_l2_p95", "delta_l2_p99", "delta_l2_max",
    "pause_transition_count", "spike_transition_count", "pause_ratio", "spike_ratio", "left_gripper_transition_count", "right_gripper_transition_count", "bimanual_active_ratio", "estimated_motion_segments",
]
ARMS = {"left": (1, 6), "right": (8, 6)}
PRIMARY = {True: "joint14+ee16", False: "joint14"}
ADVICE = {
    "close": "End-effector quaternion norms are mostly valid, so ee16 is usable as an auxiliary representation.",
    "apart": "End-effector quaternion norms show deviations; inspect ee16 before using it as the only action signal.",
    "moving": "Motion complexity is non-trivial; joint14+ee16 is recommended for richer A2V conditioning if model capacity allows.",
    "plain": "joint14 is compact and directly matches /joint_action/vector; use it as the primary baseline.",
    "last": "Compare joint14, ee16, and joint14+ee16 in ablations; use joint14 as the minimum reliable representation.",
}


def _moved(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The steps with the lengths of their changes: of all joints (``delta``) and of each arm."""
    w = steps(df, keys, order)
    before = lambda c: F.lag(c).over(w)
    rows = df.withColumns({f"{s}_arm": F.slice("joint", a, n) for s, (a, n) in ARMS.items()})
    change = lambda c: F.when(before(c).isNotNull(), l2(minus(c, before(c))))
    return rows.withColumns({"delta": change("joint"), "left_delta": change("left_arm"), "right_delta": change("right_arm")}).drop("left_arm", "right_arm")


def corpus_limits(moved: DataFrame) -> DataFrame:
    """One row: pause (p10), active (p25) and spike (p99) of all steps, their mean and p95, and the middle of each gripper's levels."""
    d = finite("delta")
    shares = {"p10": (d, 0.10), "p25": (d, 0.25), "p95": (d, 0.95), "p99": (d, 0.99)}
    few, ends = [], [F.avg(d).alias("mean")]
    for s in ARMS:
        g = finite(f"{s}_grip")
        shares |= {f"{s}_05": (g, 0.05), f"{s}_95": (g, 0.95)}
        ends += [F.min(F.round(g, 6)).alias(f"{s}_low"), F.max(F.round(g, 6)).alias(f"{s}_high")]
        few.append(moved.select(F.round(g, 6).alias("g")).where("g is not null").distinct().limit(9).agg((F.count("*") <= 8).alias(f"{s}_few")))
    one = moved.agg(*ends)
    for more in (*few, quantile_row(moved, shares)):
        one = one.crossJoin(F.broadcast(more))
    get = lambda n, x: F.coalesce(F.col(n), F.lit(x))
    grips = [_middle(*(F.col(f"{s}_{k}") for k in ("few", "low", "high", "05", "95"))).alias(f"{s}_grip_thr") for s in ARMS]
    return one.select(get("p10", 1e-6).alias("pause_thr"), get("p25", 1e-4).alias("active_thr"), get("p99", 1.0).alias("spike_thr"), get("mean", 1.0).alias("mean_ref"), get("p95", 1.0).alias("p95_ref"), *grips)


def full_stats(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row an episode with all columns of both tables.

    Null arrays and null numbers count as missing, numbers that are not finite as 0 in lengths and as missing elsewhere.
    Ratios of an episode of one step are 0, its step statistics null. Steps with one key and order are taken in any order.
    """
    moved = _moved(df.select(*keys, *order, "joint", "left_pose", "right_pose", "left_grip", "right_grip"), keys, order)
    rows, w = moved.crossJoin(F.broadcast(corpus_limits(moved))), steps(moved, keys, order)
    rows = rows.withColumn("active", F.col("delta") > F.col("pause_thr"))
    flags = {"edge": F.coalesce(F.col("active") & ~F.coalesce(F.lag("active").over(w), F.lit(False)), F.lit(False))}
    for s in ARMS:
        up = F.when(F.col(f"{s}_grip").isNotNull(), F.coalesce(finite(f"{s}_grip"), F.col(f"{s}_grip_thr")) > F.col(f"{s}_grip_thr"))
        flags |= {f"{s}_switch": F.coalesce(up != F.lag(up).over(w), F.lit(False)), f"{s}_norm": F.when(F.size(f"{s}_pose") >= 7, quaternion_norm(F.transform(f"{s}_pose", lambda x: F.coalesce(finite(x), F.lit(0.0)))))}
    rows = rows.withColumns(flags)
    d, zero = F.col("delta"), lambda c: F.coalesce(c, F.lit(0.0))
    share = lambda c: zero(F.avg(c.cast("double")))
    clean = F.filter(F.transform("joint", lambda x: finite(x)), lambda x: x.isNotNull())
    on = {s: F.col(f"{s}_delta") > F.col("active_thr") for s in ARMS}
    p = F.percentile(d, F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99))))
    agg: list[Column] = [
        F.count("*").alias("T"), F.max(F.size("joint")).alias("action_dim"), F.bool_or(F.exists("joint", lambda x: F.isnan(x.cast("double")))).alias("has_nan"),
        F.bool_or(F.exists("joint", lambda x: F.abs(x.cast("double")) == float("inf"))).alias("has_inf"), F.min(F.array_min(clean)).alias("joint_action_min"), F.max(F.array_max(clean)).alias("joint_action_max"),
        F.avg(l2("joint")).alias("joint_action_mean_l2"), F.min(d).alias("delta_l2_min"), F.avg(d).alias("joint_delta_mean_l2"), F.max(d).alias("joint_delta_max_l2"), F.stddev_pop(d).alias("delta_l2_std"), p.alias("p"),
        share(on["left"] & on["right"]).alias("bimanual_active_ratio"), share(d <= F.col("pause_thr")).alias("pause_ratio"), share(d >= F.col("spike_thr")).alias("spike_ratio"),
        F.count_if(d <= F.col("pause_thr")).alias("pause_transition_count"), F.count_if(d >= F.col("spike_thr")).alias("spike_transition_count"), F.count_if("edge").alias("estimated_motion_segments"),
        F.first("mean_ref").alias("mean_ref"), F.first("p95_ref").alias("p95_ref"),
    ]
    for s in ARMS:
        g, n = finite(f"{s}_grip"), F.col(f"{s}_norm")
        gap = F.abs(n - 1)
        agg += [zero(F.sum(f"{s}_delta")).alias(f"{s}_arm_motion_l2_sum"), share(on[s]).alias(f"{s}_arm_active_ratio"), F.count_if(f"{s}_switch").alias(f"{s}_gripper_transition_count")]
        agg += [f(g).alias(f"{s}_gripper_{k}") for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))]
        agg += [F.avg(n).alias(f"{s}_quat_norm_mean"), F.stddev_pop(n).alias(f"{s}_quat_norm_std"), F.max(gap).alias(f"{s}_quat_norm_max_abs_dev"), F.avg((gap <= 0.05).cast("double")).alias(f"{s}_quat_norm_close_ratio")]
    out = rows.groupBy(*keys).agg(*agg)
    more = {"transition_count": F.greatest(F.col("T") - 1, F.lit(0)), "dominant_arm": dominant_arm("left_arm_motion_l2_sum", "right_arm_motion_l2_sum"), "joint_delta_p95_l2": F.col("p")[2]}
    more |= {f"delta_l2_p{q}": F.col("p")[i] for i, q in enumerate((50, 90, 95, 99))} | {"delta_l2_mean": F.col("joint_delta_mean_l2"), "delta_l2_max": F.col("joint_delta_max_l2")}
    crossings = F.col("left_gripper_transition_count") + F.col("right_gripper_transition_count")
    more["action_complexity_score"] = complexity(F.col("joint_delta_mean_l2"), F.col("p")[2], F.col("mean_ref"), F.col("p95_ref"), F.col("bimanual_active_ratio"), crossings, F.col("estimated_motion_segments"))
    out = out.withColumns(more)
    kinds = dict(out.dtypes)
    names = [*keys, *dict.fromkeys([*EPISODE_COLUMNS, *TRANSITION_COLUMNS])]
    return out.select(*(rounded(c).alias(c) if kinds[c] in ("double", "float") and c not in keys else F.col(c) for c in names))


def episode_table(full: DataFrame, keys: list[str]) -> DataFrame:
    return full.select(*keys, *EPISODE_COLUMNS)


def transition_table(full: DataFrame, keys: list[str]) -> DataFrame:
    return full.select(*keys, *TRANSITION_COLUMNS)


def outlier_table(full: DataFrame, keys: list[str]) -> DataFrame:
    """Episodes with values that are no numbers, at or over the 99th percentile of length, largest step or complexity, or with
    quaternions over 0.1 away from length 1; with all the reasons."""
    shown = ["joint_delta_max_l2", "action_complexity_score"]
    rows = full.withColumns({f"__{c}": F.coalesce(c, F.lit(0.0)) for c in shown})
    limits = quantile_row(rows, {"t_limit": (F.col("T"), 0.99), "d_limit": (F.col("__joint_delta_max_l2"), 0.99), "c_limit": (F.col("__action_complexity_score"), 0.99)})
    wide = rows.crossJoin(F.broadcast(limits))
    why = reasons(
        (F.col("has_nan"), "has_nan"), (F.col("has_inf"), "has_inf"), (F.col("T") >= F.col("t_limit"), "trajectory_length_p99"), (F.col("__joint_delta_max_l2") >= F.col("d_limit"), "delta_max_p99"),
        (F.col("__action_complexity_score") >= F.col("c_limit"), "complexity_p99"), *((F.col(f"{s}_quat_norm_max_abs_dev") > 0.1, f"{s}_quat_norm_max_abs_dev>0.1") for s in ARMS),
    )
    picked = wide.withColumn("reason", why).where("reason <> ''")
    return picked.select(*keys, "reason", "T", "joint_delta_max_l2", "spike_ratio", "action_complexity_score", "left_quat_norm_max_abs_dev", "right_quat_norm_max_abs_dev")


def recommendation(full: DataFrame) -> DataFrame:
    """One row: the representation to train on, and why, by how close quaternions are to length 1 and how complex motion is."""
    close = F.least(*(F.coalesce(F.avg(f"{s}_quat_norm_close_ratio"), F.lit(0.0)) for s in ARMS))
    one = full.agg(close.alias("close"), F.coalesce(F.avg("action_complexity_score"), F.lit(0.0)).alias("mean"))
    good, moving = F.col("close") >= 0.98, F.col("mean") >= 4.0
    text = F.concat_ws(" ", F.when(good, ADVICE["close"]).otherwise(ADVICE["apart"]), F.when(moving, ADVICE["moving"]).otherwise(ADVICE["plain"]), F.lit(ADVICE["last"]))
    return one.select(F.when(moving, PRIMARY[True]).otherwise(PRIMARY[False]).alias("recommended_primary"), text.alias("recommendation"))

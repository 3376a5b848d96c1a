"""Collection plans: quotas to slots to jobs, progress over their outputs, and what gates them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.functions.expr import half_even, safe_name, target_count

# Randomisation profiles and their shares of a quota.
PROFILES = ("wa_clean_fixed", "wa_mild_random", "wa_hard_success")
SHARES = {(False, False): (1.0, None, None), (True, True): (0.70, 0.20, "rest"), (True, False): (0.80, "rest", None), (False, True): (0.90, None, "rest")}
SECONDARY_RATIO = 0.05
SETTINGS = {
    "wa_clean_fixed": {
        "cluttered_table": False, "random_background": False, "clean_background_rate": 1.0, "random_light": False,
        "crazy_random_light_rate": 0.0, "random_table_height": 0.0, "random_head_camera_dis": 0.0,
    },
    "wa_mild_random": {
        "cluttered_table": True, "random_background": True, "clean_background_rate": 0.7, "random_light": True,
        "crazy_random_light_rate": 0.03, "random_table_height": 0.02, "random_head_camera_dis": 0.0,
    },
    "wa_hard_success": {
        "cluttered_table": True, "random_background": True, "clean_background_rate": 0.35, "random_light": True,
        "crazy_random_light_rate": 0.03, "random_table_height": 0.03, "random_head_camera_dis": 0.0,
    },
}


def profile_settings(spark: SparkSession) -> DataFrame:
    """``profile`` and its settings, a row a profile."""
    names = list(SETTINGS[PROFILES[0]])
    kinds = ", ".join(f"{n} {'boolean' if isinstance(SETTINGS[PROFILES[0]][n], bool) else 'double'}" for n in names)
    return spark.createDataFrame([(p, *SETTINGS[p].values()) for p in PROFILES], f"profile string, {kinds}")


def enabled_profiles(mild: bool, hard: bool) -> list[str]:
    return [p for p, s in zip(PROFILES, SHARES[mild, hard]) if s is not None]


def config_counts(df: DataFrame, quota: str, mild: bool = False, hard: bool = False) -> DataFrame:
    """One row a quota and profile with its count: shares rounded half to even, the last takes the rest."""
    rows, used = [], F.lit(0).cast("long")
    for place, (name, share) in enumerate(zip(PROFILES, SHARES[mild, hard])):
        if share is None:
            continue
        n = F.col(quota).cast("long") - used if share == "rest" else half_even(F.col(quota) * F.lit(share))
        used = used + n if share != "rest" else used
        rows.append(F.struct(F.lit(place).alias("profile_order"), F.lit(name).alias("profile"), n.alias("count")))
    return df.select("*", F.inline(F.array(*rows))).where("count > 0")


def weighted_names(weights: list[tuple[str, float]]) -> list[str]:
    """The cycle in which robots are dealt: each name once for every hundredth of its weight, once at least."""
    return [n for n, w in weights for _ in range(max(1, int(w * 100)))]


def embodiment_weights(main: str, secondary: str | None = None, ratio: float = SECONDARY_RATIO) -> list[tuple[str, float]]:
    return [(main, 1 - ratio), (secondary, ratio)] if secondary else [(main, 1.0)]


def round_robin(index: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (F.pmod(index, F.lit(len(names))) + 1).cast("int"))


def numbered(df: DataFrame, order: list[str], name: str, pattern: str, start: int = 0) -> DataFrame:
    """Adds ids like ``job_00000`` in the given total order. Plans are small: one row a job or slot of a quota table."""
    return df.withColumn(name, F.format_string(pattern, F.row_number().over(Window.orderBy(*order)) - 1 + start))


def slots(counts: DataFrame, order: list[str], weights: list[tuple[str, float]]) -> DataFrame:
    """One row a planned episode, with its place in its configuration, its overall number, and the robot dealt to it."""
    before = F.coalesce(F.sum("count").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = counts.withColumn("before", before).withColumn("config", F.row_number().over(Window.orderBy(*order)))
    long = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("place"))
    return long.withColumn("slot", F.col("before") + F.col("place")).withColumn("embodiment", round_robin(F.col("slot"), weighted_names(weights))).drop("before")


def jobs(planned: DataFrame, family: str, target: int = 5, attempts: int = 3, gpus: int = 1) -> DataFrame:
    """Runs of at most ``target`` neighbouring slots of one configuration and robot, numbered in order.

    A run begins where the robot changes; within it every ``target``-th slot begins a job.
    """
    w = Window.partitionBy("config").orderBy("place")
    new = F.coalesce((F.col("embodiment") != F.lag("embodiment").over(w)).cast("int"), F.lit(1))
    rows = planned.withColumn("stretch", F.sum(new).over(w))
    rows = rows.withColumn("part", F.floor((F.row_number().over(Window.partitionBy("config", "stretch").orderBy("place")) - 1) / target))
    out = rows.groupBy("config", "stretch", "part").agg(F.first(family).alias("task_family"), F.first("profile").alias("profile"), F.first("embodiment").alias("embodiment"), F.count("*").alias("target_success"), F.min("slot").alias("first_slot"))
    n = F.row_number().over(Window.orderBy("first_slot")) - 1
    base = F.concat_ws("__", "profile", safe_name("embodiment"))
    made = out.withColumn("n", n).withColumns({"job_id": F.format_string("job_%05d", "n"), "base_task_config": base})
    return made.select("job_id", "task_family", "base_task_config", F.concat_ws("__", "base_task_config", "job_id").alias("task_config"), "embodiment", "target_success", (F.col("target_success") * attempts).alias("max_attempts"), F.pmod("n", F.lit(gpus)).alias("gpu_id"))


# Codes of a job that ended without enough, and of one that broke.
INCOMPLETE, BROKEN = 996, 997


def run_until(run: Callable[[], int], count: Callable[[], int], target: int, most: int) -> dict[str, int]:
    """Runs a job again until it has its target, up to ``most`` times (once at least); a code other than 0 ends it.

    ``rc`` is the job's code, 996 if it ended well with too little, 997 if it could not be run.
    """
    attempts, rc = 0, 0
    try:
        while count() < target and attempts < max(1, most) and rc == 0:
            attempts += 1
            rc = run()
    except Exception:
        rc = BROKEN
    got = count()
    return {"rc": INCOMPLETE if rc == 0 and got < target else rc, "attempts": attempts, "done": got}


def done_counts(files: DataFrame, job: str = "job_id", path: str = "path", suffix: str = ".hdf5") -> DataFrame:
    return files.where(F.endswith(F.col(path), F.lit(suffix))).groupBy(job).agg(F.count("*").alias("done"))


def progress(plan: DataFrame, done: DataFrame, job: str, target: str, by: list[str]) -> DataFrame:
    """Totals over all jobs and by each column: target, done (never over a job's target), complete, partial and empty jobs."""
    rows = plan.join(done, job, "left").select(job, *by, target_count(target).alias("target"), F.coalesce("done", F.lit(0)).alias("raw"))
    rows = rows.withColumn("done", F.least("raw", "target"))
    out = rows.groupingSets([[], *([F.col(b)] for b in by)], *(F.col(b) for b in by)).agg(
        F.count("*").alias("jobs"), F.sum("target").alias("target"), F.sum("done").alias("done"), F.count_if(F.col("done") >= F.col("target")).alias("complete"),
        F.count_if((F.col("done") > 0) & (F.col("done") < F.col("target"))).alias("partial"), F.count_if((F.col("done") == 0) & (F.col("target") > 0)).alias("empty"),
    )
    return out.withColumn("share", F.round(F.col("done") / F.greatest("target", F.lit(1)), 6))


def probe_passed(reports: DataFrame, column: str) -> DataFrame:
    return reports.agg(F.coalesce(F.bool_or(F.get_json_object(column, "$.probe_pass") == "true"), F.lit(False)).alias("passed"))


def probe_summary(outputs: DataFrame, shape: str, exportable: str, frame: str | None = None) -> DataFrame:
    """Runs of each shape, how many can be exported, and with ``frame`` the first one's first frame."""
    first = [F.min(frame).alias("first_frame")] if frame else []
    return outputs.groupBy(shape).agg(F.count("*").alias("n"), F.count_if(exportable).alias("exportable"), *first)

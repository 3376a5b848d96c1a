"""Structured Streaming: progress over arriving files, results appended once, and event windows (an extension)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, path: str, like: DataFrame, files: int = 100) -> DataFrame:
    """A stream of the Parquet files under a path, with the columns of a table."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(path)


def run_once(stream: DataFrame, mode: str, path: str) -> DataFrame:
    """What a stream of mode ``complete`` gives for all that has arrived, from a Parquet table under ``path``, next to its checkpoint.

    Each batch writes the whole result under its number, so a batch that runs again
    replaces its own; nothing passes through the driver.
    """
    seen: list[int] = []

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/result/batch={n:09d}")
        seen.append(n)

    stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    if not seen:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{path}/result/batch={max(seen):09d}")


def run_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends the stream to a Parquet table; the checkpoint makes each file count once."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def progress_counts(stream: DataFrame, by: list[str], done: Column) -> DataFrame:
    return stream.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(done).alias("done"))


def append_new(stream: DataFrame, key: str, sink: str, work: Callable[[DataFrame], DataFrame], checkpoint: str) -> None:
    """Works on rows whose key has no result in the sink yet and appends the results; a batch that runs again adds nothing."""

    def batch(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        fresh = df.dropDuplicates([key])
        try:
            done = spark.read.parquet(sink).select(key)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            done = None
        work(fresh.join(done, key, "left_anti") if done is not None else fresh).write.mode("append").parquet(sink)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def utc_micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970 of a time column; a clock without zone is that of UTC, whatever the session's zone."""
    if dict(df.dtypes)[time] != "timestamp_ntz":
        return F.unix_micros(F.col(time).cast("timestamp"))
    minutes = F.unix_date(F.col(time).cast("date")).cast("long") * 1440 + F.hour(time) * 60 + F.minute(time)
    return minutes * 60_000_000 + (F.expr(f"extract(SECOND FROM `{time}`)") * 1_000_000).cast("long")


def tumbling(stream: DataFrame, time: str, width: str, by: list[str], value: str, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window of a fixed width; rows later than the watermark are dropped, and rows without a time have no window."""
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def sliding(stream: DataFrame, time: str, width: str, step: str, by: list[str], value: str, late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width, step), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def sessions(stream: DataFrame, time: str, gap: str, by: list[str], late: str = "10 minutes") -> DataFrame:
    w = F.session_window(time, gap)
    return stream.withWatermark(time, late).groupBy(w, *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def distinct_events(stream: DataFrame, time: str, key: str, late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def retried(call: Callable[[str], str], prompt: str, valid: Callable[[str], bool], correction: str, times: int = 3, default: str = "") -> str:
    """The first valid answer of a model, asked again with a correction up to ``times``; else the default."""
    for turn in range(times):
        try:
            answer = call(prompt if not turn else f"{prompt}\n\n{correction}")
        except Exception:
            continue
        if valid(answer):
            return answer
    return default

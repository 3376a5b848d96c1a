"""Sources: text tables, JSON lines, file listings, images, and adapters for formats without a Spark reader.

All reading goes through Spark's file systems; paths may lie in any store that Spark knows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAMES = "path string, frame_idx int, seconds double, height int, width int, pixels binary"
VIDEO = "path string, width int, height int, fps double, frames int, duration double, readable boolean"
STEPS = "path string, t int, joint array<double>, left_pose array<double>, right_pose array<double>, left_grip double, right_grip double"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """All columns as text, '' kept apart from null by neither side; quotes inside quotes are doubled, lines may break.

    A file whose texts may break lines is read by one task; ``multi_line=False`` lets large files without such texts be split.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("nullValue", None).option("emptyValue", "")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path).fillna("")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON document a line; blank lines are passed over; without the file an empty table (a schema is needed then)."""
    if not exists(spark, path):
        return empty(spark, schema or T.StructType())
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at a path, or at what stands in for it: CSV or Parquet by its ending, a CSV next to it, or the file that a
    ``<name>.fallback.json`` names; an empty table of the schema if there is none. Texts have '' for null."""
    if path.endswith(".csv"):
        return read_csv(spark, path) if exists(spark, path) else empty(spark, schema)
    if exists(spark, path):
        return spark.read.parquet(path).fillna("")
    stem = path.rsplit(".", 1)[0]
    if exists(spark, stem + ".csv"):
        return read_csv(spark, stem + ".csv")
    for pointer in (f"{path}.fallback.json", f"{stem}.fallback.json"):
        if exists(spark, pointer):
            named = read_json(spark, pointer, {}).get("path", "")
            if named and exists(spark, named):
                return read_csv(spark, named)
    return empty(spark, schema)


def read_required(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or Parquet table that has to be there."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return read_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, default: Any = None) -> Any:
    """A small JSON document (settings, summaries) as Python values."""
    if not exists(spark, path):
        return default
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_yaml(spark: SparkSession, path: str, default: Any = None) -> Any:
    if not exists(spark, path):
        return default
    import yaml

    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])


def instruction(c: Column | str) -> Column:
    return F.get_json_object(c, "$.instruction")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path, length, modified`` of all files under a root. Only names are read, no content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def datasets(files: DataFrame, root: str) -> DataFrame:
    """``dataset, kind, files``: the split folders and video folders under a root, by their first folder, and the outermost
    video folders further down in split folders (``nested``, by their path). Files right under the root belong to none."""
    rel = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + root.replace("file://", "").rstrip("/") + "/", "")
    parts = F.split(rel, "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    deep = F.array_position(F.transform(folders, lambda x: F.contains(x, F.lit("video"))), True).cast("int")
    one = lambda name, kind: F.struct(name.alias("dataset"), F.lit(kind).alias("kind"))
    first = F.when(deep == 1, one(folders[0], "video")).otherwise(one(folders[0], "split"))
    nested = F.when(deep > 1, one(F.array_join(F.slice(folders, F.lit(1), F.greatest(deep, F.lit(1))), "/"), "nested"))
    found = files.where(F.size(folders) > 0).select(F.inline(F.array_compact(F.array(first, nested))))
    return found.groupBy("dataset", "kind").agg(F.count("*").alias("files"))


def tasks(files: DataFrame) -> DataFrame:
    """Names of tasks that have code (``envs/<name>.py``) or settings (``<name>.json``), without private ones, in order."""
    name = F.regexp_extract("path", r"([^/]+)\.(?:py|json)$", 1)
    return files.select(name.alias("task")).where((F.col("task") != "") & ~F.startswith(F.col("task"), F.lit("_"))).distinct().orderBy("task")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``path, height, width, channels, pixels`` of pictures (blue, green, red)."""
    raw = spark.read.format("image").option("dropInvalid", True).load(path)
    return raw.select("image.origin", "image.height", "image.width", F.col("image.nChannels").alias("channels"), F.col("image.data").alias("pixels")).withColumnRenamed("origin", "path")


def decoded(files: DataFrame, decode: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that a decoder makes of each file's bytes, with ``source_path`` and ``decode_error``; a file that cannot be
    decoded gives one row with its error and nothing else. A missing library is no file's fault and raises.

    ``files`` has ``path`` and ``content``. Decoders for HDF5, NPY and video plug in here; they run on executors, one
    file at a time.
    """
    names = [p.split()[0] for p in schema.split(",")] if "<" not in schema else [f.name for f in T._parse_datatype_string(schema).fields]

    def run(parts):
        import pandas as pd

        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows, error = list(decode(path, content)), None
                except ImportError:
                    raise
                except Exception as e:
                    rows, error = [(None,) * len(names)], f"{type(e).__name__}: {e}"[:500]
                if rows:
                    yield pd.DataFrame([(*r, path, error) for r in rows], columns=[*names, "source_path", "decode_error"])

    return files.select("path", "content").mapInPandas(run, f"{schema}, source_path string, decode_error string")


def decode_files(files: DataFrame, decode: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of the files that can be decoded; ``rejected_files`` has the others."""
    return decoded(files, decode, schema).where("decode_error is null").drop("source_path", "decode_error")


def rejected_files(files: DataFrame, decode: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """``path, reason`` of the files that cannot be decoded."""
    bad = decoded(files, decode, schema).where("decode_error is not null")
    return bad.select(F.col("source_path").alias("path"), F.col("decode_error").alias("reason"))


def decode_npy(path: str, content: bytes) -> Iterator[tuple]:
    """``path, t, joint`` of an array saved by NumPy, a row a step."""
    import io

    import numpy as np

    for t, row in enumerate(np.load(io.BytesIO(content), allow_pickle=False)):
        yield path, t, [float(x) for x in np.atleast_1d(row)]


def decode_hdf5(path: str, content: bytes) -> Iterator[tuple]:
    """Steps of an episode file, in the columns of ``STEPS``; parts that are missing are null. Needs h5py."""
    import io

    import h5py
    import numpy as np

    with h5py.File(io.BytesIO(content), "r") as f:
        get = lambda name: np.asarray(f[name]) if name in f else None
        joint, lp, rp = get("joint_action/vector"), get("endpose/left_endpose"), get("endpose/right_endpose")
        lg, rg = get("joint_action/left_gripper"), get("joint_action/right_gripper")
        at = lambda a, t: None if a is None else a[t].tolist() if a[t].ndim else float(a[t])
        for t in range(0 if joint is None else len(joint)):
            yield path, t, at(joint, t), at(lp, t), at(rp, t), at(lg, t), at(rg, t)


@contextmanager
def opened_video(content: bytes):
    """The bytes as a capture of cv2, which reads files only: they pass through a temporary file of the executor."""
    import tempfile

    import cv2

    with tempfile.NamedTemporaryFile(suffix=".mp4") as tmp:
        tmp.write(content)
        tmp.flush()
        video = cv2.VideoCapture(tmp.name)
        try:
            yield cv2, video
        finally:
            video.release()


def decode_video(path: str, content: bytes, count: int | None = None, width: int | None = None) -> Iterator[tuple]:
    """Frames of a video, in the columns of ``FRAMES``: all, or ``count`` spread evenly, at most ``width`` wide. Needs cv2.

    A frame that cannot be read has null size and pixels, so that reads that failed can be counted.
    """
    with opened_video(content) as (cv2, video):
        fps, total = video.get(cv2.CAP_PROP_FPS) or 0.0, int(video.get(cv2.CAP_PROP_FRAME_COUNT) or 0)
        wanted = range(total) if count is None or count >= total else sorted({round(i * (total - 1) / max(1, count - 1)) for i in range(count)})
        at = 0
        for k in wanted:
            if k != at:
                video.set(cv2.CAP_PROP_POS_FRAMES, k)
            ok, frame = video.read()
            at = k + 1
            if ok and width and frame.shape[1] > width:
                frame = cv2.resize(frame, (width, max(1, round(frame.shape[0] * width / frame.shape[1]))), interpolation=cv2.INTER_AREA)
            size = (frame.shape[0], frame.shape[1], frame.tobytes()) if ok else (None, None, None)
            yield path, k, k / fps if fps else 0.0, *size


def probe_video(path: str, content: bytes) -> Iterator[tuple]:
    """One row in the columns of ``VIDEO``, from the container's header and the first frame alone. Needs cv2."""
    with opened_video(content) as (cv2, video):
        get = lambda name: video.get(getattr(cv2, f"CAP_PROP_{name}")) or 0.0
        ok, _ = video.read()
        fps, frames = get("FPS"), int(get("FRAME_COUNT"))
        yield path, int(get("FRAME_WIDTH")), int(get("FRAME_HEIGHT")), float(fps), frames, frames / fps if fps else 0.0, bool(ok)


def read_fails(frames: DataFrame) -> DataFrame:
    """``path, frames, read_fails`` of decoded videos."""
    return frames.groupBy("path").agg(F.count("*").alias("frames"), F.count_if(F.col("pixels").isNull()).alias("read_fails"))


def video_meta(frames: DataFrame) -> DataFrame:
    """Size, frame count and duration of decoded videos."""
    return frames.groupBy("path").agg(F.max("width").alias("width"), F.max("height").alias("height"), F.count("*").alias("frames"), F.max("seconds").alias("duration"), (F.count("*") > 0).alias("readable"))

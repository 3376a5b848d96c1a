"""Tables in the folder that driver and executors share, to cut lineage; nothing goes to local disks on a cluster."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session may lack the setting; it then gets a folder of its own, as tests do, which goes with the process.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tracklode.shared.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local-test")) and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tracklode-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("tracklode.shared.dir", "file://" + made)
    return "file://" + made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder, with its scheme, so that readers outside Spark find the same store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tracklode/{label}-{uuid.uuid4().hex}")
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def delete(spark: SparkSession, path: str | None) -> None:
    if path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Tables written to the shared folder to cut lineage; ``drop`` removes those no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            delete(self.spark, self.paths.pop(id(df), None))

    def sweep(self) -> None:
        """Lets Spark remove the shuffle files of jobs whose DataFrames are gone."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

"""Sinks: tables in given columns, one file set a status, JSON lines, small documents, reports."""

from __future__ import annotations

import json
import time
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.operators.aggregates import union_by_name


def in_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Just these columns in this order; those that are missing are null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as texts joined by semicolons, for formats without nesting."""
    return df.select(*(F.array_join(F.transform(c, lambda x: x.cast("string")), ";").alias(c) if t.startswith("array") else F.to_json(c).alias(c) if t.startswith(("map", "struct")) else F.col(c) for c, t in df.dtypes))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    _flat(in_columns(df, columns) if columns else df).write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_union_csv(tables: list[DataFrame], path: str) -> None:
    write_csv(union_by_name(*tables), path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet at the path, or, for types that Parquet cannot hold, a CSV next to it that ``<path>.fallback.json`` names.
    Returns which: ``parquet`` or ``csv``."""
    try:
        df.write.mode(mode).parquet(path)
        return "parquet"
    except AnalysisException as e:
        if "UNSUPPORTED_DATA_TYPE" not in str(e):
            raise
    other = path.rsplit(".", 1)[0] + ".fallback.csv"
    write_csv(df.select(*(F.col(c).cast("string").alias(c) for c in df.columns)), other, mode=mode)
    write_json(df.sparkSession, f"{path}.fallback.json", {"path": other, "mode": "csv"})
    return "csv"


def write_files(df: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """Writes each row's bytes as a file of its name under the folder, from the executors; returns ``path, length``.

    Names tell files apart; a task that runs again writes the same file again.
    """

    def run(parts):
        import pandas as pd
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        for pdf in parts:
            for n, data in zip(pdf[name], pdf[content]):
                with system.open_output_stream(f"{at}/{n}") as out:
                    out.write(data)
            yield pd.DataFrame({"path": [f"{folder}/{n}" for n in pdf[name]], "length": [len(x) for x in pdf[content]]})

    return df.select(name, content).mapInPandas(run, "path string, length long")


def npy_bytes(df: DataFrame, keys: list[str], order: list[str], values: str) -> DataFrame:
    """``keys, content``: each key's arrays in order as one NumPy file of 32-bit floats. A key's rows are one file by nature."""

    @F.pandas_udf("binary")
    def packed(rows: pd.Series) -> pd.Series:
        import io

        import numpy as np

        def one(arrays) -> bytes:
            out = io.BytesIO()
            np.save(out, np.array([list(a) for a in arrays], dtype=np.float32), allow_pickle=False)
            return out.getvalue()

        return rows.map(one)

    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(values).alias("__v"))))
    rows = df.groupBy(*keys).agg(F.transform(listed, lambda r: r["__v"]).alias("__rows"))
    return rows.select(*keys, packed("__rows").alias("content"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def write_by_status(df: DataFrame, path: str, status: str) -> None:
    """One folder of files a status; rows of a status are spread over all tasks, so none gathers them."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def write_accepted_and_rejected(df: DataFrame, path: str, reason: str) -> None:
    ok = F.coalesce(reason, F.lit("")) == ""
    df.where(ok).drop(reason).write.mode("overwrite").parquet(f"{path}/accepted")
    df.where(~ok).write.mode("overwrite").parquet(f"{path}/rejected")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small document, written through Spark's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, default=str) + "\n")


def to_yaml(value: Any, indent: int = 0) -> str:
    """Plain YAML of nested dicts, lists and scalars; texts are quoted as in JSON."""
    pad = "  " * indent
    if isinstance(value, dict):
        return "".join(f"{pad}{k}:\n{to_yaml(v, indent + 1)}" if isinstance(v, (dict, list)) and v else f"{pad}{k}: {_scalar(v)}\n" for k, v in value.items())
    return "".join(f"{pad}-\n{to_yaml(v, indent + 1)}" if isinstance(v, (dict, list)) and v else f"{pad}- {_scalar(v)}\n" for v in value)


def _scalar(v: Any) -> str:
    if isinstance(v, dict):
        return "{}"
    if isinstance(v, list):
        return "[]"
    return json.dumps(v, ensure_ascii=False)


def write_yaml(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, to_yaml(value))


def save_labels(df: DataFrame, path: str, count: int, every: int = 20) -> str:
    """Writes a new version of a label table next to the old ones and returns its path; every so many labels it is kept as a backup."""
    kind = "backup" if count and count % every == 0 else "labels"
    out = f"{path}/{kind}-{time.time_ns()}"
    df.write.parquet(out)
    return out


def archive(spark: SparkSession, names: dict[str, DataFrame], path: str) -> None:
    """A tar.gz of small manifests as JSON lines. Manifests go through the driver, so their rows are limited to those of one each."""
    import io
    import tarfile

    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w:gz") as tar:
        for name, df in names.items():
            body = "".join(r["value"] + "\n" for r in df.select(F.to_json(F.struct("*")).alias("value")).toLocalIterator()).encode()
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data.getvalue()))
    out.close()


def markdown_table(df: DataFrame, most: int = 50) -> str:
    """A report's table of the first rows of a small aggregate."""
    rows = df.limit(most).collect()
    head = ["| " + " | ".join(df.columns) + " |", "|" + " - |" * len(df.columns)]
    return "\n".join([*head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"


def report(title: str, sections: dict[str, DataFrame | str]) -> str:
    return reduce(lambda text, s: text + f"\n## {s[0]}\n\n" + (s[1] if isinstance(s[1], str) else markdown_table(s[1])), sections.items(), f"# {title}\n")

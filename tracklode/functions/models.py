"""Model hooks: embeddings and verdicts from any loader, in batches on the executors, loaded once a task.

Weights stay outside: a hook takes a function that loads a model and returns a function from a batch to vectors, or from
a prompt to an answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.functions.expr import dot
from tracklode.streaming.progress import retried

# Fixed value: what a backend without a model answers.
NO_MODEL = '{"overall_decision": "NEED_HUMAN_REVIEW", "confidence": 0.0, "evidence": ["no model"]}'


def unit(vector: Column | str) -> Column:
    """The vector brought to length 1; null if its length is 0."""
    length = F.sqrt(dot(vector, vector))
    return F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length))


def with_embedding(df: DataFrame, column: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]], name: str = "embedding", batch: int = 16) -> DataFrame:
    """Adds a unit vector that the model gives for a column, ``batch`` rows a call. Null inputs give null."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    predict = predict_batch_udf(load, return_type=ArrayType(FloatType()), batch_size=batch)
    raw = F.when(F.col(column).isNotNull(), predict(F.coalesce(column, F.lit("")) if dict(df.dtypes)[column] == "string" else F.col(column)))
    return df.withColumn("__raw", raw).withColumn(name, unit("__raw")).drop("__raw")


def with_answer(df: DataFrame, prompt: str, load: Callable[[], Callable[[str], str]], valid: Callable[[str], bool], correction: str, name: str = "answer", times: int = 3, default: str = NO_MODEL) -> DataFrame:
    """Adds a model's answer to a prompt, asked again with a correction up to ``times``, else the default; null prompts get it at once."""

    @F.pandas_udf("string")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for prompts in parts:
            yield prompts.map(lambda p: default if p is None else retried(model, p, valid, correction, times, default))

    return df.withColumn(name, answered(prompt))


def no_model() -> Callable[[str], str]:
    """A backend for runs without a model."""
    return lambda prompt: NO_MODEL


def register_frames(spark: SparkSession, name: str = "even_frames") -> None:
    """Registers a table function for SQL: ``even_frames(count, n)`` gives ``place, frame`` of n frames spread evenly over a clip."""

    @F.udtf(returnType="place int, frame long")
    class EvenFrames:
        def eval(self, count: int, n: int):
            if count is None or n is None or count <= 0 or n <= 0:
                return
            picked = range(count) if count <= n else dict.fromkeys(round(i * (count - 1) / max(1, n - 1)) for i in range(n))
            yield from enumerate(picked)

    spark.udtf.register(name, EvenFrames)

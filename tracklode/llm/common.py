"""Shared plumbing: bounded Arrow batches, connected components."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.sources.scratch import Scratch, scratch_path

__all__ = ["Scratch", "scratch_path", "components", "forest", "map_rows", "only", "release", "small_batches"]

#: Rows and bytes of a batch that a Python worker holds at once; long texts make rows of 100 kB and more.
ARROW_ROWS, ARROW_BYTES = 1024, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Caps rows and bytes of the session's Arrow batches, so that long texts fit a Python worker. Smaller caps stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


#: What empties the tables and memos that modules keep in a worker, by module.
CACHES: dict[str, Callable[[], None]] = {}


def release() -> None:
    """Hands freed memory back to the system: workers live on between tasks, next to those of other stages."""
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def only(user: str) -> None:
    """Empties what other modules than ``user`` keep in this worker. Kernels call it as they begin, so that a stage does not run next
    to the memos of the stage before."""
    for name in [n for n in CACHES if n != user]:
        CACHES.pop(name)()
        release()


def map_rows(df: DataFrame, columns: list[str], schema: str, kernel: Callable[[], Callable[..., Iterable[tuple]]], user: str = "rows") -> DataFrame:
    """Applies ``kernel()``'s function to the columns of each Arrow batch, as lists; it gives output rows.

    ``kernel`` runs once a task, so that tables and caches are built once and held by no closure.
    """
    names = [part.split()[0] for part in schema.split(",")]
    small_batches(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        only(user)
        # memos of millions of tuples hold no cycles, and scans of them take most of the time
        arrow, apply, collected = to_arrow_schema(target), kernel(), gc.isenabled()
        gc.disable()
        try:
            for batch in batches:
                rows = list(apply(*(batch.column(i).to_pylist() for i in range(len(columns)))))
                cols = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)
        finally:
            if collected:
                gc.enable()
            release()

    return df.select(*columns).mapInArrow(run, schema)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex of the edges ``a[i] - b[i]`` with the smallest vertex that these edges link it to."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            return nodes, nodes[root]


def components(edges: DataFrame, scratch: Scratch, local_edges: int = 500_000) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, root)``: root is the same for linked nodes.

    Each round first shrinks every partition of at most about ``local_edges`` edges to a star forest, then
    contracts: each vertex moves to the neighbour that comes first in a random order, which leaves at most
    three quarters of the vertices on average. One partition's forest ends it. All of it is distributed and
    every round is written to the shared folder; nothing goes to the driver but counts.
    """
    spark = scratch.spark
    schema = "node long, root long"

    def stars(batches):
        got = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        if got:
            node, root = forest(np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got]))
            keep = node != root
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], names=["node", "root"])

    pairs = scratch.write(edges.select("a", "b").where("a <> b"), "edges")
    moves: list[DataFrame] = []
    for turn in range(200):
        count = pairs.count()
        parts = max(1, -(-count // local_edges))
        starred = scratch.write(pairs.repartition(parts).mapInArrow(stars, schema), "stars")
        scratch.drop(pairs)
        if parts == 1:
            moves.append(starred)
            break
        both = starred.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(starred.select(F.col("root").alias("a"), F.col("node").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("v"))
        first = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        move = first.select(F.col("a").alias("node"), F.least(F.col("m"), order("a"))["v"].alias("root"))
        move = scratch.write(move, "moves")
        moves.append(move.where("node <> root"))
        x, y = move.select(F.col("node").alias("node"), F.col("root").alias("a")), move.select(F.col("node").alias("root"), F.col("root").alias("b"))
        pairs = scratch.write(starred.join(x, "node").join(y, "root").select("a", "b").where("a <> b").distinct(), "edges")
        scratch.drop(starred)
        scratch.sweep()
    else:
        raise RuntimeError("the components did not settle")
    found = moves.pop()
    while moves:
        move = moves.pop()
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        via = move.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
        found = scratch.write(via.unionAll(found), "labels")
    return found

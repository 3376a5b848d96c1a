"""Exact top-k search (op 7): the three-phase uniform threshold.

The dimensions of a vector are dealt to two nodes, each of which holds its own half of every vector and nothing else; a
pair's score is the sum of its nodes' partial scores.

1. Gather: each node makes, for each query, the list of its best partial scores in every group of rows, and notes the
   best one of each chunk. The best of the lists are resolved exactly; the k-th best score is a cutoff that at least k
   rows reach.
2. Broadcast and collect: the cutoff goes back to the nodes. A row that reaches it has, at one node at least, a partial
   score of half the cutoff, and at that node no less than the cutoff leaves when the other node gives its best. Chunks
   whose best partial score lies under that bound are skipped; of the others a node gives the rows that reach it.
3. Resolve: rows that both nodes gave have their score; of the others only the half that is missing is looked up, at
   the node that has it.

Rows stand in chunks in the order of a few signs of random projections, so that like vectors share chunks and chunks
can be skipped. Equal vectors are one class with its k + 1 smallest ids, so a vector that a third of all rows share
costs no more than any other. Queries are a stated share of the rows; queries, classes and what is collected travel in
packed blocks of bounded size that meet by equality. Integers stay exact: products are summed as floats only where no
sum can leave their range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.llm.common import Scratch, small_batches

NODES = 2
#: Rows of a packed block: of queries, and of classes (a chunk). Both fit 16 bits.
QUERIES, ROWS = 512, 1024
#: Classes of one group at most. Small tables are cut finer, to at least this many and so that all cores have some.
GROUP_ROWS, LEAST_ROWS = 32_768, 2048
#: Lists that a task holds before it gives them away, in blocks of queries.
HELD = 64
#: Signs of projections by which rows are ordered.
SIGNS = 16
LOW = -(1 << 62)
#: A query row is told by its id and a hash of its vector, a class by its smallest id and that hash.
QUERY, CLASS = ["query_id", "q_hash"], ["rep", "hash"]
INT64 = pa.list_(pa.int64())


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component. Null ids, null vectors and those with null or non-finite
    components take no part."""
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def unpack(data: bytes, dim: int) -> np.ndarray:
    """The vectors in a binary of 16-bit or 64-bit integers."""
    kind = np.int16 if len(data) == 2 * dim else np.int64
    return np.frombuffer(data, kind)


def signs(vectors: np.ndarray) -> np.ndarray:
    """Which side of ``SIGNS`` fixed random planes the vectors of one dimension lie on, as a number."""
    planes = np.random.default_rng(1).standard_normal((vectors.shape[1], SIGNS))
    return ((vectors @ planes > 0) @ (1 << np.arange(SIGNS))).astype(np.int32) if vectors.shape[1] else np.zeros(len(vectors), np.int32)


def packed(numbers: DataFrame) -> DataFrame:
    """``vec_id, dim, data, side``: vectors as 16-bit integers where all components fit, else as 64-bit ones, and their signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum([0, *(len(x) for x in vectors)])
            dims, side, out = np.diff(ends), np.zeros(len(vectors), np.int32), []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                side[at] = signs(flat[ends[at, None] + np.arange(dim)].astype(np.float64))
            for a, b in zip(ends, ends[1:]):
                v = flat[a:b]
                out.append((v.astype(np.int16) if np.abs(v).max(initial=0) < 1 << 15 else v).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims.astype(np.int32)), pa.array(out, pa.binary()), pa.array(side)], names=["vec_id", "dim", "data", "side"])

    return numbers.select("vec_id", "v").mapInArrow(run, "vec_id long, dim int, data binary, side int")


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """``dim, data, side, rep, hash, ids``: each distinct vector once, with its k + 1 smallest ids, in order."""
    first = F.row_number().over(Window.partitionBy("dim", "data").orderBy("vec_id"))
    few = vectors.distinct().withColumn("n", first).where(F.col("n") <= k + 1)
    ids = few.groupBy("dim", "data").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("side").alias("side"))
    return ids.select("dim", "data", "side", F.col("ids")[0].alias("rep"), F.xxhash64("data").alias("hash"), "ids")


def edges(dim: int) -> list[int]:
    return [dim * n // NODES for n in range(NODES + 1)]


def _blocks(rows: DataFrame, names: list[str], size: int, extra: str | None = None) -> DataFrame:
    """``node, dim, chunk, n, ids, hashes, alone, data``: each node's part of blocks of at most ``size`` rows of one dimension.

    ``data`` has 16-bit integers if all components fit. ``alone`` tells which rows have a single id.
    """
    form = "node int, dim int, chunk long, n int, ids binary, hashes binary, alone binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            data = batch.column(3).to_pylist()
            single = batch.column(4).to_numpy(zero_copy_only=False)
            out = []
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for s in range(0, len(at), size):
                    take = at[s : s + size]
                    full = np.stack([unpack(data[i], dim).astype(np.int64) for i in take]).reshape(len(take), dim)
                    chunk = int(ids[take[0]] ^ hashes[take[0]] ^ np.int64(dim))
                    cut = edges(dim)
                    for node, (a, b) in enumerate(zip(cut, cut[1:])):
                        part = np.ascontiguousarray(full[:, a:b])
                        part = part.astype(np.int16) if np.abs(part).max(initial=0) < 1 << 15 else part
                        out.append((node, dim, chunk, len(take), ids[take].tobytes(), hashes[take].tobytes(), single[take].astype(np.uint8).tobytes(), part.tobytes()))
            cols = list(zip(*out)) or [()] * 8
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in form.split(", ")])

    return rows.select(*names, "dim", "data", F.lit(True).alias("alone") if extra is None else F.expr(extra).alias("alone")).mapInArrow(run, form)


def _matrix(data: bytes, n: int, width: int) -> np.ndarray:
    return unpack(data, n * width).reshape(n, width) if n * width else np.zeros((n, width), np.int16)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, as 64-bit integers."""
    most = float(np.abs(a.astype(np.int64)).max(initial=0)) * float(np.abs(b.astype(np.int64)).max(initial=0)) * max(1, a.shape[1])
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def best_columns(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` best of each row, in no order."""
    return np.argpartition(scores, -n, axis=1)[:, -n:] if scores.shape[1] > n else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)


def _schema(form: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": INT64}
    return pa.schema([(n, kinds[t]) for n, t in (part.split() for part in form.split(", "))])


def _rows(form: str, rows: list[tuple]) -> pa.RecordBatch:
    schema = _schema(form)
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _side(row: dict) -> int:
    cut = edges(row["dim"])
    return cut[row["node"] + 1] - cut[row["node"]]


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


GATHERED = "node int, q_chunk long, chunk long, bests binary, query_id long, q_hash long, reps array<long>, hashes array<long>, parts array<long>"


def gather(paired: DataFrame, k: int) -> DataFrame:
    """What the nodes find, of two kinds of rows: ``bests`` has, for a block of queries and a chunk, each query's best partial
    score there; the others have, for a query, its k + 1 best of all chunks that a task saw, as long as it held them.

    A query's own class takes no part if no other id has that vector.
    """

    def lists(key, held) -> Iterator[tuple]:
        for q_id, q_hash, reps, hashes, parts in zip(*held):
            real = parts > LOW
            yield key[0], key[1], None, None, int(q_id), int(q_hash), reps[real].tolist(), hashes[real].tolist(), parts[real].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key, width = (row["node"], row["q_chunk"], row["dim"]), _side(row)
                q_ids, q_hashes, reps, hashes = (_longs(row[c]) for c in ("q_ids", "q_hashes", "ids", "hashes"))
                scores = products(_matrix(row["q_data"], row["q_n"], width), _matrix(row["data"], row["n"], width))
                scores[(q_ids[:, None] == reps) & (np.frombuffer(row["alone"], np.uint8) > 0)] = LOW
                out.append((*key[:2], row["chunk"], scores.max(axis=1, initial=LOW).tobytes(), None, None, None, None, None))
                at = best_columns(scores, k + 1)
                mine = [reps[at], hashes[at], np.take_along_axis(scores, at, axis=1)]
                if before := held.get(key):
                    mine = [np.concatenate([x, y], axis=1) for x, y in zip(before[2:], mine)]
                    top = best_columns(mine[2], k + 1)
                    mine = [np.take_along_axis(x, top, axis=1) for x in mine]
                held[key] = (q_ids, q_hashes, *mine)
            yield _rows(GATHERED, out)
            if len(held) > HELD:
                for key, value in held.items():
                    yield _rows(GATHERED, list(lists(key, value)))
                held.clear()
        for key, value in held.items():
            yield _rows(GATHERED, list(lists(key, value)))

    return paired.mapInArrow(run, GATHERED)


def requested(bests: DataFrame, bounds: DataFrame) -> DataFrame:
    """The pairs of a block and a chunk in which some query's best partial score reaches its bound at the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool((_longs(x) >= np.asarray(y)).any()) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield batch.select(range(3)).filter(pa.array(keep, pa.bool_()))

    both = bests.join(bounds, ["node", "q_chunk"]).select("node", "q_chunk", "chunk", "bests", "bounds")
    return both.mapInArrow(run, "node int, q_chunk long, chunk long")


ENTRIES = "node int, q_chunk long, chunk long, at binary, parts binary"


def collect(asked: DataFrame) -> DataFrame:
    """Of each pair of a block and a chunk the rows that reach a query's bound: ``at`` is query times 2**16 plus row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                width, bounds = _side(row), np.array(row["bounds"], np.int64)
                scores = products(_matrix(row["q_data"], row["q_n"], width), _matrix(row["data"], row["n"], width))
                own = (_longs(row["q_ids"])[:, None] == _longs(row["ids"])) & (np.frombuffer(row["alone"], np.uint8) > 0)
                q, r = np.nonzero((scores >= bounds[:, None]) & ~own)
                if len(q):
                    out.append((row["node"], row["q_chunk"], row["chunk"], (q.astype(np.int64) << 16 | r).tobytes(), scores[q, r].tobytes()))
            yield _rows(ENTRIES, out)

    return asked.mapInArrow(run, ENTRIES)


LACKING = "node int, q_chunk long, chunk long, at binary, parts binary, whole int"


def compared(entries: DataFrame) -> DataFrame:
    """Entries of both nodes side by side: those of both with their score (``whole`` 1), the others for the node that lacks them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q_chunk, chunk, *sides in zip(*(batch.column(c).to_pylist() for c in ("q_chunk", "chunk", "at_0", "parts_0", "at_1", "parts_1"))):
                at, parts = ([_longs(x or b"") for x in (sides[c], sides[c + 2])] for c in (0, 1))
                _, i, j = np.intersect1d(*at, assume_unique=True, return_indices=True)
                if len(i):
                    out.append((0, q_chunk, chunk, at[0][i].tobytes(), (parts[0][i] + parts[1][j]).tobytes(), 1))
                for node, known in ((1, i), (0, j)):
                    rest = np.delete(np.arange(len(at[1 - node])), known)
                    if len(rest):
                        out.append((node, q_chunk, chunk, at[1 - node][rest].tobytes(), parts[1 - node][rest].tobytes(), 0))
            yield _rows(LACKING, out)

    one = lambda n: entries.where(F.col("node") == n).select("q_chunk", "chunk", F.col("at").alias(f"at_{n}"), F.col("parts").alias(f"parts_{n}"))
    return one(0).join(one(1), ["q_chunk", "chunk"], "full").mapInArrow(run, LACKING)


RESOLVED = "query_id long, q_hash long, rep long, hash long, score long"


def resolved(lacking: DataFrame) -> DataFrame:
    """Rows whose score reaches the cutoff; the half that is missing is looked up for the rows that lack it, no others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, score = _longs(row["at"]), _longs(row["parts"])
                q, r = at >> 16, at & 0xFFFF
                if not row["whole"]:
                    width = _side(row)
                    a, b = (_matrix(row[c], row[n], width).astype(np.int64) for c, n in (("q_data", "q_n"), ("data", "n")))
                    score = score + np.concatenate([np.einsum("ij,ij->i", a[q[s : s + 8192]], b[r[s : s + 8192]]) for s in range(0, len(q), 8192)])
                keep = score >= np.array(row["cuts"], np.int64)[q]
                q, r = q[keep], r[keep]
                cols = (_longs(row["q_ids"])[q], _longs(row["q_hashes"])[q], _longs(row["ids"])[r], _longs(row["hashes"])[r], score[keep])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=_schema(RESOLVED))

    return lacking.mapInArrow(run, RESOLVED)


def exact(pairs: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """``query_id, q_hash, score, ids`` of some pairs ``query_id, q_hash, rep, hash``."""
    form = "query_id long, q_hash long, score long, ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, a, b = (batch.column(c).to_pylist() for c in ("dim", "q_data", "data"))
            scores = [int(products(unpack(x, d)[None], unpack(y, d)[None])[0, 0]) for d, x, y in zip(dims, a, b)]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("q_hash"), pa.array(scores, pa.int64()), batch.column("ids")], schema=_schema(form))

    full = pairs.join(queries.select(*QUERY, F.col("data").alias("q_data")), QUERY).join(classes, CLASS)
    return full.select(*QUERY, "dim", "q_data", "data", "ids").mapInArrow(run, form)


def ranked(scored: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``keys, rank, vec_id, score``: the k best ids, each once with its best score, ties to the smaller; no query's own."""
    each = scored.select(*keys, "score", F.explode("ids").alias("vec_id")).where(F.col("vec_id") != F.col("query_id"))
    once = each.groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select(*keys, "rank", "vec_id", "score")


def _places(blocks: DataFrame) -> DataFrame:
    """``q_chunk, place, query_id, q_hash`` of the queries in their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, hashes in zip(*(batch.column(c).to_pylist() for c in range(3))):
                n = len(_longs(ids))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(_longs(ids)), pa.array(_longs(hashes))], names=["q_chunk", "place", *QUERY])

    return blocks.where("node = 0").select("chunk", "ids", "hashes").mapInArrow(run, "q_chunk long, place int, query_id long, q_hash long")


def phases(vectors: DataFrame, scratch: Scratch, every: int = 50, k: int = 5, scale: int = 256) -> dict[str, DataFrame]:
    """The tables of all phases: ``gathered``, ``bounds``, ``requests`` (pairs of blocks that are not skipped), ``entries``,
    ``lacking`` and ``scored``."""
    small_batches(scratch.spark)
    rows = scratch.write(packed(quantised(vectors, scale)), "vectors")
    classes = scratch.write(classes_of(rows, k), "classes")
    asked = rows.where(F.col("vec_id") % every == 0).distinct().select(F.col("vec_id").alias("query_id"), F.xxhash64("data").alias("q_hash"), "dim", "data", "side")
    queries = scratch.write(asked, "queries")
    n = classes.count()
    groups = max(1, -(-n // GROUP_ROWS), min(-(-n // LEAST_ROWS), 4 * scratch.spark.sparkContext.defaultParallelism))

    # phase 1; like vectors come to one partition, in order, and so to one chunk
    ordered = classes.repartitionByRange(groups, "dim", "side", "rep").sortWithinPartitions("dim", "side", "rep").coalesce(groups)
    chunks = scratch.write(_blocks(ordered, CLASS, ROWS, "size(ids) = 1").withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int")), "chunks")
    parts = max(1, -(-queries.count() // QUERIES))
    held = queries.repartitionByRange(parts, "dim", "side", *QUERY).sortWithinPartitions("dim", "side", *QUERY).coalesce(parts)
    blocks = scratch.write(_blocks(held, QUERY, QUERIES), "blocks")
    q = blocks.select("node", "dim", *(F.col(c).alias(f"q_{c}") for c in ("chunk", "n", "ids", "hashes", "data")))
    every_group = q.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    gathered = scratch.write(gather(every_group.join(chunks, ["node", "dim", "group"]), k), "gathered")
    bests, lists = gathered.where("bests is not null"), gathered.where("bests is null")
    found = lists.select(*QUERY, "node", F.inline(F.arrays_zip("reps", "hashes", "parts")).alias("rep", "hash", "part"))
    place = F.row_number().over(Window.partitionBy(*QUERY, "node").orderBy(F.desc("part"), "rep", "hash"))
    top = found.withColumn("n", place).where(F.col("n") <= k + 1).select(*QUERY, *CLASS).distinct()
    first = ranked(exact(top, queries, classes), QUERY, k).where(F.col("rank") == k).select(*QUERY, F.col("score").alias("cut"))

    # phase 2: what each node must give, from the cutoff and from what the other node can add at most
    most = lists.groupBy(*QUERY, "node").agg(F.max(F.coalesce(F.array_max("parts"), F.lit(LOW))).alias("most"))
    known = most.groupBy(*QUERY).agg(F.sum("most").alias("all")).join(first, QUERY, "left")
    bound = F.greatest(F.expr(f"cut div {NODES} - 1"), F.col("cut") - (F.col("all") - F.col("most")))
    told = most.join(known, QUERY).join(_places(blocks), QUERY)
    told = told.select("node", "q_chunk", F.struct("place", F.coalesce(bound, F.lit(LOW + 1)).cast("long").alias("bound"), F.coalesce("cut", F.lit(LOW + 1)).alias("cut")).alias("t"))
    listed = told.groupBy("node", "q_chunk").agg(F.array_sort(F.collect_list("t")).alias("t"))
    bounds = scratch.write(listed.select("node", "q_chunk", F.transform("t", lambda t: t["bound"]).alias("bounds"), F.transform("t", lambda t: t["cut"]).alias("cuts")), "bounds")
    requests = requested(bests, bounds)
    both = requests.join(q, ["node", "q_chunk"]).join(chunks.drop("group", "dim"), ["node", "chunk"])
    entries = scratch.write(collect(both.join(bounds, ["node", "q_chunk"])), "entries")

    # phase 3
    lacking = compared(entries)
    full = lacking.join(q, ["node", "q_chunk"]).join(chunks.drop("group", "dim"), ["node", "chunk"]).join(bounds.drop("bounds"), ["node", "q_chunk"])
    scored = resolved(full).join(classes.select(*CLASS, "ids"), CLASS)
    return {"gathered": gathered, "bounds": bounds, "requests": requests, "entries": entries, "lacking": lacking, "scored": scored}


def search(vectors: DataFrame, scratch: Scratch, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows of each row whose id is divisible by ``every``.

    Rows of the query's own id are no candidates, nor are vectors of another dimension; if there are fewer than k
    candidates, all are given. Rows that share an id count once, with their best score, and repeated query rows too.
    """
    return ranked(phases(vectors, scratch, every, k, scale)["scored"], ["query_id"], k).select("query_id", "rank", "vec_id", "score")

"""Pairs of texts whose word shingles have a Jaccard similarity of at least ``least``: prefix filter, then exact check.

The shingles of all texts are put in one order. Two sets that are similar enough share a shingle among the first
``n - ceil(least * n) + 1`` of each, so texts meet in the groups of these. Any order gives the same pairs; shingles
frequent in a sample come last, which keeps groups small. Shingles and texts are told apart by 64 bits of hash.

Pairs that are near by another measure can be given beforehand; they are checked first, and what they join is not looked at
again. A group is sorted by size of set. Rounds look at pairs that lie further and further apart in it, and leave out only
those that verified links of earlier rounds already join, so the components are those of all similar pairs.

Of most pairs that meet, the texts never travel: a text's sketch counts its shingles by the low bits of their hashes,
and sets differ by at least as many shingles as their sketches do. Pairs that pass are checked in parts of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklode.llm.common import Scratch, components
from tracklode.llm.windows import shingle_sets

#: Distance in a group up to which the first round looks; each later round looks so many times further.
REACH = 4
#: Documents whose shingles are counted for the order, and frequent shingles that come last. Results do not depend on them.
SAMPLE, FREQUENT = 10_000, 50_000
#: Keeps products of floats from being taken for more than they are.
EPS = 1e-9
#: Rows of an index partition that are looked at together.
WINDOW = 1 << 17
#: Members of a group compared with the others at a time.
BLOCK = 256
#: Nodes that are broadcast at most, to pick their texts before a join.
PICKED = 200_000
#: Candidate pairs given at a time.
GIVE = 1 << 16
#: Counts in a sketch, a byte each.
BUCKETS = 512
#: Bytes of sketches or of texts that are sent for pairs at a time: this share of all texts, or this many if that is more.
SHARE, ROOM = 0.5, 64 << 20


def prefix(shingles: np.ndarray, least: float, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of the set in the common order: those not in ``last`` (sorted) by value, then by ``rank``."""
    n = len(shingles)
    weight = np.zeros(n, np.int64)
    if len(last):
        at = np.minimum(np.searchsorted(last, shingles), len(last) - 1)
        weight = np.where(last[at] == shingles, rank[at], 0)
    return shingles[np.lexsort((shingles, weight))[: n - math.ceil(least * n - EPS) + 1]]


def possible(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray, least: float) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles can be similar if the first that they share are at ``at`` and ``to``."""
    return np.minimum(n - at, m - to) >= least / (1 + least) * (n + m) - EPS


def group_pairs(node, n, at, comp, low: int, high: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group's members ``low`` to ``high - 1`` places apart that can be similar and are not joined yet."""
    size = len(node)
    _, inverse, count = np.unique(comp, return_inverse=True, return_counts=True)
    main = inverse == np.argmax(count)
    rest = np.flatnonzero(~main)
    for s in range(0, len(rest), BLOCK):
        i = rest[s : s + BLOCK]
        top = min(size, int(i[-1]) + high)
        for a in range(max(0, int(i[0]) - high + 1), top, 1 << 14):
            j = np.arange(a, min(top, a + (1 << 14)))
            far = np.abs(i[:, None] - j)
            # two outside the largest component meet once, from the first of them
            ok = (far >= low) & (far < high) & (comp[i][:, None] != comp[j]) & (main[j] | (i[:, None] < j))
            ok &= possible(n[i][:, None], at[i][:, None], n[j], at[j], least)
            x, y = np.nonzero(ok)
            if len(x):
                yield node[i[x]], node[j[y]]


def candidates(rows: DataFrame, low: int, high: int, least: float) -> DataFrame:
    """``a, b`` of groups of ``key, node, n, at, comp``; the first round also gives rows of groups that reach further.

    Those come as ``key, a: node, b: null, n, at``.
    """
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])

    def give(a, b):
        for k in range(0, len(a), GIVE):
            x, y = a[k : k + GIVE], b[k : k + GIVE]
            none = pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int32())
            yield pa.RecordBatch.from_arrays([none[0], pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), none[1], none[1]], schema=schema)

    def solve(key, node, n, at, comp):
        fresh = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node, n, at, comp = (x[fresh] for x in (key, node, n, at, comp))
        edge = np.flatnonzero(key[1:] != key[:-1]) + 1
        starts, ends = np.append(0, edge), np.append(edge, len(key))
        if low == 1:
            for d in range(1, high):
                i = np.flatnonzero(key[d:] == key[:-d])
                i = i[possible(n[i], at[i], n[i + d], at[i + d], least)]
                yield from give(node[i], node[i + d])
            wide = np.repeat(ends - starts > high, ends - starts)
            k = np.flatnonzero(wide)
            yield pa.RecordBatch.from_arrays([pa.array(key[k]), pa.array(node[k]), pa.nulls(len(k), pa.int64()), pa.array(n[k]), pa.array(at[k])], schema=schema)
            return
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > low:
                for a, b in group_pairs(node[s:e], n[s:e], at[s:e], comp[s:e], low, high, least):
                    yield from give(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, parts = [], 0, ("key", "node", "n", "at", "comp")
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in parts])
            count += batch.num_rows
            if count < WINDOW:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            last = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            if last:
                yield from solve(*(c[:last] for c in cols))
            held, count = [[c[last:] for c in cols]], 0
        if held:
            cols = [np.concatenate(c) for c in zip(*held)]
            if len(cols[0]):
                yield from solve(*cols)

    return rows.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(run, "key long, a long, b long, n int, at int")


def sketches(texts: DataFrame, size: int) -> DataFrame:
    """``node, n, bytes, counts`` of texts: shingles, length, and the shingles whose hashes end in each value, 255 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shingle_sets(batch.column(1), size)
            counts = [np.minimum(np.bincount((x % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes() for x in got]
            cols = pa.array([len(x) for x in got], pa.int32()), batch.column(2), pa.array(counts, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["node", "n", "bytes", "counts"])

    return texts.select("node", "text", F.length("text").cast("long").alias("bytes")).mapInArrow(run, "node long, n int, bytes long, counts binary")


def in_parts(pairs: DataFrame, sent: float, marks: DataFrame) -> list[DataFrame]:
    """The pairs dealt out so that each part sends no more of the ``sent`` bytes than there is room for."""
    room = max(ROOM, SHARE * (marks.agg(F.sum("bytes")).first()[0] or 0))
    parts = max(1, math.ceil(sent / room))
    return [pairs] if parts == 1 else [pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == k) for k in range(parts)]


def still_open(pairs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """``a, b, bytes`` of the pairs whose sketches leave it open that their texts are similar, with the length of both."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for c in ("of_a", "of_b"))
            differ = np.abs(x - y).sum(axis=1)
            most = batch.column("n").to_numpy() * (1 - least) / (1 + least)
            yield batch.select(["a", "b", "bytes"]).filter(pa.array(differ <= most + EPS))

    left, right = (marks.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bytes").alias(f"bytes_{c}"), F.col("counts").alias(f"of_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", (F.col("bytes_a") + F.col("bytes_b")).alias("bytes"), (F.col("n_a") + F.col("n_b")).alias("n"), "of_a", "of_b")
    return both.mapInArrow(check, "a long, b long, bytes long")


def similar(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Those of the pairs of nodes whose texts are similar. Texts travel, as they are smaller than their sets, once for each pair;
    where few nodes are in pairs, only theirs do."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if nodes.count() <= PICKED:
        texts = texts.join(F.broadcast(nodes), "node", "left_semi")

    def solve(rows: pa.Table) -> pa.RecordBatch:
        # two rows a pair, but where texts repeat
        a, b, node = (rows.column(c).to_numpy() for c in ("a", "b", "node"))
        at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (node[1:] != node[:-1])))
        sets, keep = shingle_sets(rows.column("text").take(at).combine_chunks(), size), []
        for x, y in zip(sets[::2], sets[1::2]):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= least * (len(x) + len(y) - both) - EPS)
        keep = at[::2][np.array(keep, bool)]
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            a, b = (rows.column(c).to_numpy() for c in "ab")
            last = int(np.argmax((a == a[-1]) & (b == b[-1])))
            if last:
                yield solve(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield solve(held)

    sent = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(texts, "node").select("a", "b", "node", "text")
    return sent.repartition("a", "b").sortWithinPartitions("a", "b", "node").mapInArrow(check, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, marks: DataFrame, scratch: Scratch, size: int, least: float) -> DataFrame:
    """Those of the (written) pairs of nodes whose texts are similar, all of them, in turns that send a bounded part each."""
    found, links = [], []
    for part in in_parts(pairs, 2 * BUCKETS * pairs.count(), marks):
        found.append(scratch.write(still_open(part, marks, least), "open"))
        scratch.sweep()
    left = union(found)
    for part in in_parts(left, left.agg(F.sum("bytes")).first()[0] or 0, marks):
        links.append(scratch.write(similar(part, texts, size, least), "links"))
        scratch.sweep()
    scratch.drop(*found)
    return union(links)


def union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionAll(more)
    return out


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of the pairs that ``roots`` do not join."""
    for c in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def joined(texts: DataFrame, near: DataFrame, scratch: Scratch, size: int, least: float) -> DataFrame:
    """``node, root`` of the components of all similar pairs of ``node, text`` (binary) by shingles of ``size`` words.

    ``near`` are (written) pairs ``a, b`` that are checked first. Those that they miss are found by the prefix filter.
    """
    marks = scratch.write(sketches(texts, size), "sketches")
    scratch.sweep()
    links = verified(near, texts, marks, scratch, size, least)
    roots = components(links, scratch)
    every = max(1, texts.count() // SAMPLE)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shingle_sets(batch.column(0), size)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).astype(np.int64))], names=["v"])

    counted = texts.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).select("text").mapInArrow(values, "v long").groupBy("v").count()
    top = counted.where("count > 2").orderBy(F.desc("count"), "v").limit(FREQUENT).toArrow()
    last, rank = top.column("v").to_numpy().astype(np.uint64), top.column("count").to_numpy()
    order = np.argsort(last)
    last, rank = last[order], rank[order]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shingle_sets(batch.column(1), size)
            if not got:
                continue
            first = [prefix(x, least, last, rank) for x in got]
            sizes = [len(x) for x in first]
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            n, at = np.repeat(np.array([len(x) for x in got], np.int32), sizes), np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
            yield pa.RecordBatch.from_arrays([*map(pa.array, (np.concatenate(first).astype(np.int64), node, n, at, node))], names=["key", "node", "n", "at", "comp"])

    rows = texts.select("node", "text").mapInArrow(index, "key long, node long, n int, at int, comp long")
    found = scratch.write(candidates(rows, 1, REACH, least), "candidates")
    scratch.sweep()
    pairs = scratch.write(apart(found.where("b is not null").select("a", "b").distinct(), roots), "pairs")
    links = links.unionAll(verified(pairs, texts, marks, scratch, size, least))
    scratch.drop(pairs)
    wide = found.where("b is null").select("key", F.col("a").alias("node"), "n", "at")
    largest = wide.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    roots, low = components(links, scratch), REACH
    while low < largest:
        labelled = wide.join(roots, "node", "left").select("key", "node", "n", "at", F.coalesce("root", "node").alias("comp"))
        pairs = scratch.write(candidates(labelled, low, low * REACH, least).select("a", "b").distinct(), "candidates")
        links = links.unionAll(verified(pairs, texts, marks, scratch, size, least))
        scratch.drop(pairs)
        roots, low = components(links, scratch), low * REACH
    return roots

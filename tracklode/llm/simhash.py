"""SimHash near-duplicates (op 9): deletion-variant signatures.

Documents first collapse to distinct fingerprints. A fingerprint is cut into so few segments that of any two within
the allowed distance, one segment differs by at most one bit; so both share a variant of that segment with one bit
left out. Variants are indexed, brought together by equality, and every candidate is verified on whole fingerprints.

Groups of one variant are read as sorted streams. A group links each member to members found so far, and gives only
links that join parts not yet joined: fewer links than members, whatever the size of the group. A group larger than
``GROUP`` is dealt out again by further exact keys, segments of the bits that its key has not fixed yet, as often as it
takes; with 13 bits left no group is too large. So no task gathers one whole.
Exact copies never meet: they share a fingerprint, which is counted before any shuffle of variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklode.llm import jaccard
from tracklode.llm.common import Scratch, components, forest, map_rows

#: Members of one variant's group that are compared in one place.
GROUP = 20_000
#: Free bits at which groups are compared whatever their size: with the one left out, two to the power of one more.
FEW = 13
#: Fingerprints compared at a time.
BLOCK = 512


def word_shingles(data: bytes, size: int) -> list[bytes]:
    """Shingles of ASCII-lower-cased words between ASCII white space, repeats included; fewer words: one shingle."""
    words = data.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(size)))))


def fingerprint(data: bytes, size: int = 3) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64 (seed 42); no words: zero."""
    shingles = word_shingles(data, size)
    if not shingles:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], dtype="<u8")
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        total += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text, as a signed long. Null texts count as empty."""

    def kernel():
        return lambda ids, texts: ((i, signed(fingerprint(t or b"", size))) for i, t in zip(ids, texts))

    return map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("text")), ["doc_id", "text"], "doc_id long, fp long", kernel)


def text_id(data: bytes) -> int:
    """A hash of the sequence of ASCII-lower-cased words, as a signed long."""
    return signed(xxhash.xxh3_64_intdigest(b" ".join(data.lower().split())))


def segments(bits: int) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of the fewest segments of 64 bits of which one differs by at most one bit."""
    n = bits // 2 + 1 if bits else 1
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one-wildcard variants, and the fingerprint of each: a key names segment, wildcard and other bits.

    Keys are mixed to 64 bits; two variants that share a key by chance cost a comparison and nothing else.
    """
    keys, owner = [], []
    for k, (low, width) in enumerate(segments(bits)):
        part = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
        for at in range(width):
            rest = part & ~np.uint64(1 << at)
            key = (rest ^ np.uint64((k * 64 + at) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            keys.append(key ^ (key >> np.uint64(32)))
            owner.append(fps)
    return np.concatenate(keys), np.concatenate(owner)


def spanning(n: int, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Indices of links that join the vertices 0..n-1 as all links ``i - j`` do, the nearest ones, without a loop."""
    order = np.lexsort((j, i, far))
    i, j, label, chosen = i[order], j[order], np.arange(n), []
    alive = np.arange(len(i))
    while len(alive):
        x, y = label[i[alive]], label[j[alive]]
        apart = x != y
        alive, x, y = alive[apart], x[apart], y[apart]
        if not len(alive):
            break
        first = np.full(n, len(i))
        np.minimum.at(first, x, alive)
        np.minimum.at(first, y, alive)
        take = np.unique(first[first < len(i)])
        chosen.append(take)
        node, root = forest(label[i[take]], label[j[take]])
        move = np.arange(n)
        move[node] = root
        label = move[label]
    return order[np.concatenate(chosen)] if chosen else np.zeros(0, np.int64)


def near_links(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``bits`` that join the distinct fingerprints as all such links would, fewer than there are members.

    A block is compared with what came before, part by part: of each part joined so far only the nearest counts.
    """
    n = len(fps)
    label, ti, tj, tf = np.arange(n), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a in range(0, n, BLOCK):
        e = min(n, a + BLOCK)
        within = np.bitwise_count(fps[a:e, None] ^ fps[None, a:e])
        i, j = np.nonzero(np.triu(within <= bits, 1))
        far = within[i, j].astype(np.int64)
        i, j = i + a, j + a
        if a:
            by = np.argsort(label[:a], kind="stable")
            starts = np.flatnonzero(np.append(True, label[by][1:] != label[by][:-1]))
            dist = np.bitwise_count(fps[a:e, None] ^ fps[None, by]).astype(np.int64) * a + np.arange(a)
            best = np.minimum.reduceat(dist, starts, axis=1)
            r, c = np.nonzero(best // a <= bits)
            got = best[r, c]
            i, j, far = np.append(i, r + a), np.append(j, by[got % a]), np.append(far, got // a)
        i, j, far = np.append(ti, i), np.append(tj, j), np.append(tf, far)
        if len(i):
            take = spanning(e, i, j, far)
            ti, tj, tf = i[take], j[take], far[take]
            node, root = forest(ti, tj)
            label[node] = root
    return ti, tj


def small_links(keys: np.ndarray, fps: np.ndarray, bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of sorted groups of at most ``most`` members, all groups at once, thinned to a forest."""
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for d in range(1, most):
        at = np.flatnonzero((keys[d:] == keys[:-d]) & (np.bitwise_count(fps[d:] ^ fps[:-d]) <= bits) & (fps[d:] != fps[:-d]))
        a.append(fps[at])
        b.append(fps[at + d])
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
        take = spanning(len(nodes), flat[: len(a)], flat[len(a) :], np.bitwise_count(a ^ b).astype(np.int64))
        a, b = a[take], b[take]
    return a, b


#: Groups up to this size are compared all at once.
SMALL = 16
#: Rows of an index partition that are looked at together.
WINDOW = 1 << 17


def _links(rows: DataFrame, bits: int, cap: int) -> DataFrame:
    """Links of the groups of ``key, fp``; members of groups over ``cap`` come back as ``key, null, fp``."""
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def give(key, a, b):
        cols = (pa.nulls(len(b), pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (key, a, b))
        return pa.RecordBatch.from_arrays([*cols], schema=schema)

    def solve(keys, fps):
        edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts, ends = np.append(0, edge), np.append(edge, len(keys))
        size = ends - starts
        small = np.repeat((size > 1) & (size <= SMALL), size)
        yield give(None, *small_links(keys[small], fps[small], bits, SMALL))
        for s, e in zip(starts[size > SMALL].tolist(), ends[size > SMALL].tolist()):
            group = np.unique(fps[s:e])
            if len(group) > cap:
                yield give(np.repeat(keys[s], len(group)), None, group)
            else:
                i, j = near_links(group, bits)
                yield give(None, group[i], group[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, spill = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)))
            if sum(len(k) for k, _ in held) < WINDOW:
                continue
            keys, fps = (np.concatenate([x, *more]) for x, more in zip((keys, fps), zip(*held)))
            held = []
            if spill is not None:  # the rest of a group over the cap
                more = int(np.searchsorted(keys, spill, "right")) if keys[0] == spill else 0
                if more:
                    yield give(keys[:more], None, fps[:more])
                    keys, fps = keys[more:], fps[more:]
            if len(keys):
                last = int(np.searchsorted(keys, keys[-1], "left"))
                if last:
                    yield from solve(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
                if len(keys) > max(cap, WINDOW):
                    spill = keys[0]
                    yield give(keys, None, fps)
                    keys, fps = keys[:0], fps[:0]
        if held:
            keys, fps = (np.concatenate([x, *more]) for x, more in zip((keys, fps), zip(*held)))
        if spill is not None and len(keys) and keys[0] == spill:
            more = int(np.searchsorted(keys, spill, "right"))
            yield give(keys[:more], None, fps[:more])
            keys, fps = keys[more:], fps[more:]
        if len(keys):
            yield from solve(keys, fps)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, a long, b long")


def mixed(keys: np.ndarray, parts: np.ndarray, k: int) -> np.ndarray:
    v = (keys + parts * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)) * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(29))


def free_segments(fixed: int, bits: int) -> list[int]:
    """Masks of ``bits + 1`` parts of the bits that are not fixed; of two within ``bits``, one part agrees."""
    free = [b for b in range(64) if not fixed >> b & 1]
    cut = [len(free) * k // (bits + 1) for k in range(bits + 2)]
    return [sum(1 << b for b in free[i:j]) for i, j in zip(cut, cut[1:])]


def dealt_again(large: DataFrame, bits: int, turn: int) -> DataFrame:
    """``key, fp`` of the groups' members by further segments. In the first turn the bits that a group has fixed are those of its
    variant, found by making the variants of its members again; later they are those of the turns before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.uint64) for k in (0, 1))
            path = batch.column(2).to_numpy(zero_copy_only=False)
            if not turn:
                made, _ = variants(fps, bits)
                place = (made.reshape(-1, len(fps)) == keys).argmax(axis=0)
                ends = np.cumsum([w for _, w in segments(bits)])
                path = np.searchsorted(ends, place, "right")
            out = []
            for p in np.unique(path).tolist():
                at = np.flatnonzero(path == p)
                for k, mask in enumerate(free_segments(fixed_bits(p, bits, turn), bits)):
                    out.append((mixed(keys[at], fps[at] & np.uint64(mask), k), fps[at], np.full(len(at), p * (bits + 1) + k)))
            cols = [np.concatenate(c) if out else np.zeros(0) for c in zip(*out)] or [np.zeros(0)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["key", "fp", "path"])

    return large.mapInArrow(run, "key long, fp long, path long")


def fixed_bits(path: int, bits: int, turn: int) -> int:
    """Mask of the bits that are fixed along a path: the variant's segment, then a part of the rest in each turn."""
    steps = []
    for _ in range(turn):
        path, k = divmod(path, bits + 1)
        steps.append(k)
    low, width = segments(bits)[path]
    fixed = ((1 << width) - 1) << low
    for k in reversed(steps):
        fixed |= free_segments(fixed, bits)[k]
    return fixed


def link(prints: DataFrame, scratch: Scratch, bits: int = 2, cap: int = GROUP) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that join just those which chains of near ones join."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            keys, owner = variants(fps, bits)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(owner.astype(np.int64))], names=["key", "fp"])

    found = scratch.write(_links(prints.select("fp").mapInArrow(index, "key long, fp long"), bits, cap), "links")
    links, turn, free = [found.where("key is null").select("a", "b")], 0, 64 - min(w for _, w in segments(bits))
    large = found.where("key is not null").select("key", F.col("b").alias("fp"), F.lit(0).cast("long").alias("path"))
    while not large.isEmpty():
        rows = scratch.write(dealt_again(large, bits, turn), "dealt")
        free -= free // (bits + 1)
        found = scratch.write(_links(rows.select("key", "fp"), bits, cap if free > FEW else 4 << FEW), "links")
        links.append(found.where("key is null").select("a", "b"))
        path = rows.select("key", "path").distinct()
        large = found.where("key is not null").select("key", F.col("b").alias("fp")).join(path, "key")
        turn += 1
    out = links[0]
    for more in links[1:]:
        out = out.unionAll(more)
    return out


def _labelled(prints: DataFrame, distinct: DataFrame, root: DataFrame, scratch: Scratch) -> DataFrame:
    rooted = distinct.join(root.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = scratch.write(rooted, "roots")
    least = scratch.write(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    labelled = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(labelled, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, scratch: Scratch, size: int = 3, bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest document id that a chain of fingerprints within ``bits`` reaches.

    Documents without words have fingerprint zero and are linked like others. A null id stays in its component and
    counts only if all ids there are null. Repeated rows stay repeated.
    """
    prints = scratch.write(fingerprints(docs, size), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    return _labelled(prints, distinct, components(link(distinct, scratch, bits), scratch), scratch)


def distinct_texts(docs: DataFrame, distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, text``: the lower-cased words of one text for each ``fp`` of ``distinct``."""

    def kernel():
        def rows(texts, wanted):
            for text, want in zip(texts, wanted):
                node = text_id(text)
                if want is None or node == want:
                    yield node, b" ".join(text.lower().split())

        return rows

    # of rows that share an id, those that have the text; texts that only rows without id have come last
    named = docs.join(distinct.where("low is not null").select(F.col("low").alias("doc_id"), F.col("fp").alias("want")), "doc_id")
    nameless = docs.where("doc_id is null").withColumn("want", F.lit(None).cast("long"))
    named, nameless = (map_rows(x.select("text", "want"), ["text", "want"], "node long, text binary", kernel) for x in (named, nameless))
    only = distinct.where("low is null").select(F.col("fp").alias("node"))
    return scratch.write(named.unionAll(nameless.join(only, "node", "left_semi").dropDuplicates(["node"])), "words")


def near_pairs(words: DataFrame, scratch: Scratch, bits: int, size: int = 3) -> DataFrame:
    """Pairs ``a, b`` of ``node, text`` that join the nodes whose fingerprints chains of near ones join; nothing is checked here."""
    prints = scratch.write(fingerprints(words.select(F.col("node").alias("doc_id"), "text"), size), "fingerprints")
    first = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "first")
    same = prints.join(first, "fp").where("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    across = link(first, scratch, bits)
    for c in "ab":
        across = across.join(first.select(F.col("fp").alias(c), F.col("low").alias(f"low_{c}")), c)
    across = across.select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    pairs = scratch.write(same.unionAll(across).distinct(), "near")
    scratch.sweep()
    return pairs


def keep_one(docs: DataFrame, scratch: Scratch, shingle: int = 5, least: float = 0.8, bits: int = 5) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, with its columns.

    Candidates are texts whose fingerprints differ by at most ``bits``, by the deletion variants of this module. They are linked
    if their word shingles have a similarity of ``least`` or more. Similar pairs whose fingerprints lie further apart, or that
    the forest of fingerprints leaves out, are then found and checked by ``jaccard``, so no link is lost. Only texts of the same words in the same order are copies without a check. Rows without words or without an id are all kept.
    """
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    texts = docs.where(worded).select("doc_id", F.col("text").cast("binary").alias("text"))

    def kernel():
        return lambda ids, texts: ((i, text_id(t)) for i, t in zip(ids, texts))

    prints = scratch.write(map_rows(texts, ["doc_id", "text"], "doc_id long, fp long", kernel), "texts")
    distinct = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    words = distinct_texts(texts, distinct, scratch)
    scratch.sweep()
    root = jaccard.joined(words, near_pairs(words, scratch, bits), scratch, shingle, least)
    found = _labelled(prints, distinct, root, scratch)
    doubles = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(doubles, "doc_id", "left_anti")

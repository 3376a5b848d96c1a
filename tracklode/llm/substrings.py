"""Substring dedup (op 4): level-wise doubling over word windows.

Levels are lengths that double up to the window: 5, 10 and 20 words for windows of 20. At each level a window is known
by a core, a range of that many words inside it: at the first level the one whose hash comes first in a fixed order
(its anchor), later the one of twice the length that holds the core before. Equal windows have equal cores, so a window
can repeat only if its core does. The cores of a level are counted over all documents, those that occur once end
there, and only windows of the others are extended; the loop ends when no candidate survives or at the full length.

Extension goes by runs: consecutive windows with one core form a block. Equal blocks have equal windows throughout, so
of each class of blocks only the earliest needs a look at single windows, and only if its core has other classes.
Copies thus never multiply: a passage in a million documents is one class.

Between levels, repeated hashes go out as a bit table of a fixed 16 MB if they are few enough for it (``sieve``), so
that other windows are dropped before any shuffle; hashes that meet by chance in the table fall out at the next level.
Beyond that number an equality join does the same. All else is counted or reduced by minimum before shuffles, joined
by equality (AQE splits hot keys), and written to the shared folder. Cores and whole windows are told apart by hashes
of two families with nothing in common, 128 bits together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.llm.common import Scratch, small_batches
from tracklode.llm.windows import Words, blocks, ranges, sliced

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bits of a sieve, and repeated hashes that are put in one at most.
SIEVE_BITS, SIEVE_MOST = 27, 1 << 25
#: Bits of a sieve that one row of its table holds.
SIEVE_PART = 21
#: Documents whose ids are broadcast at most, to pick their texts before a join.
PICKED = 200_000


#: Words of the first level's core at least; shorter windows have one level.
LEAST = 3
#: Sets the cores that grew to the left apart from those that grew to the right.
LEFT = np.uint64(0x2545F4914F6CDD1D)


def lengths(window: int) -> list[int]:
    """Lengths of the levels: halves of halves of the window, rounded up, and the window itself."""
    out = [window]
    while out[0] >= 2 * LEAST:
        out.insert(0, -(-out[0] // 2))
    return out


def longer(place: np.ndarray, first: np.ndarray, count: np.ndarray, window: int, core: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks by longer cores: ``block, place, first, count``, those that grew to the left first.

    The core grows to the right in windows that have room there, else to the left; so a block falls in two parts.
    """
    split = np.clip(place + to - window, first, first + count)
    block = np.tile(np.arange(len(place)), 2)
    at, start, n = np.concatenate([place + core - to, place]), np.concatenate([first, split]), np.concatenate([split - first, first + count - split])
    keep = n > 0
    return block[keep], at[keep], start[keep], n[keep]


def in_sieve(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - SIEVE_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def sieve(repeated: DataFrame) -> np.ndarray | None:
    """A table of 2**27 bits in which those of all hashes ``h`` are set; none if there are too many hashes for it."""
    if repeated.count() > SIEVE_MOST:
        return None
    parts = 1 << SIEVE_BITS - SIEVE_PART

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64) >> np.uint64(64 - SIEVE_BITS)
            part = (at >> np.uint64(SIEVE_PART)).astype(np.int64)
            for p in np.unique(part).tolist():
                bits = held.setdefault(p, np.zeros(1 << SIEVE_PART - 3, np.uint8))
                low = at[part == p] & np.uint64((1 << SIEVE_PART) - 1)
                np.bitwise_or.at(bits, (low >> np.uint64(3)).astype(np.int64), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
        for p, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])

    by = F.shiftrightunsigned("h", 64 - SIEVE_BITS + SIEVE_PART)
    table = np.zeros((parts, 1 << SIEVE_PART - 3), np.uint8)
    got = repeated.select("h").repartition(16, by).mapInArrow(fill, "part int, bits binary").toArrow()
    for p, bits in zip(got.column(0).to_pylist(), got.column(1)):
        table[p] |= np.frombuffer(bits.as_buffer(), np.uint8)
    return table.reshape(-1)


def keyed(docs: DataFrame) -> DataFrame:
    """``k, v, text`` next to ``doc_id``: null ids come before all others; differing texts of one id get numbers."""
    k = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    base = docs.select("doc_id", k.alias("k"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    seen = base.select("k", F.xxhash64("text").alias("h")).distinct().groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    if seen.isEmpty():
        return base.withColumn("v", F.lit(0))
    many = base.join(seen.select("k"), "k", "left_semi").select("k", F.sha2("text", 256).alias("h")).distinct()
    number = many.withColumn("v", F.row_number().over(Window.partitionBy("k").orderBy("h")))
    named = base.withColumn("h", F.sha2("text", 256)).join(number, ["k", "h"], "left")
    return named.select("doc_id", "k", "text", F.coalesce("v", F.lit(0)).alias("v"))


KINDS = {"long": pa.int64(), "int": pa.int32()}


def _arrow(schema: str, columns: list) -> pa.RecordBatch:
    names, types = zip(*(part.split() for part in schema.split(", ")))
    made = [pa.array(c.astype(np.int64) if t == "long" else c.astype(np.int32), KINDS[t]) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(made, names=names)


def picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with an id ``k, v`` among ``ids`` if those are few, else all: saves a join of texts the others."""
    return docs.join(F.broadcast(ids), ["k", "v"], "left_semi") if ids.count() <= PICKED else docs


class Levels:
    """What texts give at each level, with the sieves of the levels before."""

    def __init__(self, window: int):
        self.window, self.cores = window, lengths(window)[:-1] or [window]

    def parts(self, words: Words, level: int, sieves: list) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the cores of all levels up to this one, ``place, first, count`` of the blocks that came so far."""
        hashes = words.hashes(0)
        anchor, place, first, count = blocks(words, hashes, self.window, self.cores[0])
        known = [anchor]
        for n in range(level + 1):
            if n:
                known_place = place
                block, place, first, count = longer(place, first, count, self.window, self.cores[n - 1], self.cores[n])
                left = np.where(place < known_place[block], LEFT, np.uint64(0))
                known = [*(x[block] for x in known), ranges(hashes, place, place + self.cores[n], 0) ^ left]
            if n < level and sieves[n] is not None:
                keep = in_sieve(sieves[n].value, known[n])
                known, place, first, count = [x[keep] for x in known], place[keep], first[keep], count[keep]
        return known, place, first, count

    def counted(self, docs: DataFrame, level: int, sieves: list) -> DataFrame:
        """``h0, ..., n``: cores of the level with those before that no sieve has tested, and how often they occur."""
        open_ = [n for n in range(level) if sieves[n] is None] + [level]
        form = ", ".join([*(f"h{n} long" for n in open_), "n long"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words in sliced(batch.column(0)):
                    known = self.parts(words, level, sieves)[0]
                    if len(open_) > 1:
                        rows, n = np.unique(np.stack([known[i] for i in open_]), axis=1, return_counts=True)
                    else:
                        rows, n = np.unique(known[level], return_counts=True)
                        rows = [rows]
                    yield _arrow(form, [*rows, n])

        rows = docs.select("text").mapInArrow(run, form)
        return rows.groupBy(*(f"h{n}" for n in open_)).agg(F.sum("n").alias("n"))

    def blocks(self, docs: DataFrame, sieves: list) -> DataFrame:
        """``h, b, m, o, k, v, s`` of all blocks of the last level: core, body, windows, place of the core, first window;
        and ``h0, ...`` of the levels that have no sieve."""
        last = len(self.cores) - 1
        open_ = [n for n in range(last) if sieves[n] is None]
        form = ", ".join(["h long, b long, m int, o int, k long, v int, s int", *(f"h{n} long" for n in open_)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for words in sliced(batch.column(2)):
                    known, place, first, m = self.parts(words, last, sieves)
                    body = ranges(words.hashes(1), first, first + m + self.window - 1, 1)
                    row = words.row_of(first)
                    at = words.first + row
                    yield _arrow(form, [known[last], body, m, place - first, k[at], v[at], first - words.row_start[row], *(known[n] for n in open_)])

        return docs.select("k", "v", "text").mapInArrow(run, form)


def repeated_spans(docs: DataFrame, scratch: Scratch, window: int = 20) -> DataFrame:
    """``k, v, spans``: for each document of ``keyed`` with any, the word ranges ``[start, end)`` of windows that also
    start earlier. Spans of one document may overlap."""
    spark = scratch.spark
    small_batches(spark)
    levels, sieves, sets = Levels(window), [], []

    def settled(counts: DataFrame) -> DataFrame:
        """The repeated cores of a level, and the next sieve."""
        found = scratch.write(counts.where("n > 1").select("h"), "cores")
        bits = sieve(found)
        sieves.append(None if bits is None else spark.sparkContext.broadcast(bits))
        sets.append(found)
        scratch.sweep()
        return found

    def joined(rows: DataFrame, upto: int) -> DataFrame:
        for n in range(upto):
            if sieves[n] is None:
                rows = rows.join(sets[n].withColumnRenamed("h", f"h{n}"), f"h{n}", "left_semi")
        return rows

    none = spark.createDataFrame([], "k long, v int, spans array<struct<a:int,e:int>>")
    for level in range(len(levels.cores) - 1):
        counts = joined(levels.counted(docs, level, sieves), level).groupBy(F.col(f"h{level}").alias("h")).agg(F.sum("n").alias("n"))
        if settled(counts).isEmpty():
            return none
    last = len(levels.cores) - 1
    held = scratch.write(joined(levels.blocks(docs, sieves), last).select("h", "b", "m", "o", "k", "v", "s"), "blocks")
    repeated = settled(held.groupBy("h").agg(F.count("*").alias("n")))
    if sieves[last] is not None:
        bits = sieves[last]

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = in_sieve(bits.value, batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
                yield batch.filter(pa.array(keep))

        alive = held.mapInArrow(sift, held.schema)
    else:
        alive = held.join(repeated, "h", "left_semi")
    named = ["h", "b", "m", "o"]
    first = F.min(F.struct("k", "v", "s")).alias("first")
    classes = scratch.write(alive.groupBy(*named).agg(first, F.count("*").alias("n")), "classes")
    later = alive.join(classes.where("n > 1").drop("n"), named).where(F.struct("k", "v", "s") > F.col("first"))
    spans = later.select("k", "v", F.col("s").alias("a"), (F.col("s") + F.col("m") + (window - 1)).alias("e"))
    spans = scratch.write(spans, "block-spans")

    # written, so that both sides of the joins are plain exchanges, whose hot keys can be split
    several = scratch.write(classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "several")
    single = classes.join(several, "h", "left_semi").select("h", "m", "first.*")
    asked = scratch.write(single.groupBy("k", "v").agg(F.collect_list(F.struct("h", "s", "m")).alias("asked")), "asked")
    scratch.drop(held, classes, several, *sets)
    scratch.sweep()
    form = "h long, w long, k long, v int, s int"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = batch.column(3)
            flat, ends = lists.flatten(), np.append(0, np.cumsum([len(x) for x in lists]))
            h, s, m = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            for words in sliced(batch.column(2)):
                a, b = ends[words.first], ends[words.first + len(words.row_end)]
                each, of = m[a:b].astype(np.int64), row[a:b]
                start = np.repeat(s[a:b].astype(np.int64), each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                of = np.repeat(of, each)
                at = start + words.row_start[of - words.first]
                w = ranges(words.hashes(1), at, at + window, 1)
                yield _arrow(form, [np.repeat(h[a:b], each), w, k[of], v[of], start])

    texts = picked(docs.select("k", "v", "text"), asked.select("k", "v"))
    held = scratch.write(texts.join(asked, ["k", "v"]).mapInArrow(windows, form), "windows")
    firsts = held.groupBy("h", "w").agg(first, F.count("*").alias("n")).where("n > 1").select("h", "w", "first")
    firsts = scratch.write(firsts, "firsts")
    rest = held.join(firsts, ["h", "w"]).where(F.struct("k", "v", "s") > F.col("first"))
    both = spans.unionAll(rest.select("k", "v", F.col("s").alias("a"), (F.col("s") + window).alias("e")))
    out = scratch.write(both.groupBy("k", "v").agg(F.collect_list(F.struct("a", "e")).alias("spans")), "spans")
    scratch.drop(held, firsts, spans, asked)
    for bits in sieves:
        if bits is not None:
            bits.destroy()
    scratch.sweep()
    return out


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in one of the ranges."""
    return np.cumsum(np.bincount(start, minlength=n + 1)[:n] - np.bincount(end, minlength=n + 1)[:n]) > 0


def _spans(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Starts and ends of each row's ranges; none for null."""
    flat, ends = column.flatten(), np.append(0, np.cumsum([len(x) if x.is_valid else 0 for x in column]))
    a, e = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    return [(a[i:j], e[i:j]) if j > i else None for i, j in zip(ends.tolist(), ends[1:].tolist())]


def _with_spans(docs: DataFrame, scratch: Scratch, window: int) -> DataFrame:
    base = keyed(docs)
    spans = repeated_spans(base, scratch, window)
    ids = spans.select("k", "v")
    if ids.count() > PICKED:
        return base.join(spans, ["k", "v"], "left").select("doc_id", "text", "spans")
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    rest = base.join(F.broadcast(ids), ["k", "v"], "left_anti").select("doc_id", "text", none)
    return rest.unionAll(picked(base, ids).join(spans, ["k", "v"]).select("doc_id", "text", "spans"))


def digests(docs: DataFrame, scratch: Scratch, window: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document.

    Words are whatever stands between ASCII white space, in UTF-8 bytes. Null and empty texts have no words; texts of
    fewer words than a window lose none. Rows with one id and one text are one document, of which each row shows the
    result; texts that share an id count as documents in the order of their digests; null ids come first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, spans in zip(*(batch.column(c).to_pylist() for c in range(2)), _spans(batch.column(2))):
                words = text.split()
                if spans:
                    gone = covered(len(words), *spans)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                rows.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_spans(docs, scratch, window).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut_text(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """The text without the covered words and the white space after each; white space elsewhere stays as it is."""
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    gone, out, at = covered(len(places), start, end), [], 0
    for n, (first, _) in enumerate(places):
        if gone[n]:
            out.append(text[at:first])
            at = places[n + 1][0] if n + 1 < len(places) else len(text)
    return b"".join([*out, text[at:]])


def cut(docs: DataFrame, scratch: Scratch, window: int = 20) -> DataFrame:
    """``docs`` with repeated windows cut from ``text`` and ``n_chars`` set anew; texts without any stay as they are."""
    base = keyed(docs)
    spans = repeated_spans(base, scratch, window)
    k = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    if dict(base.dtypes)["v"] == "int" and spans.where("v > 0").isEmpty():
        keys = docs.withColumns({"__k": k, "__v": F.lit(0)})
    else:
        numbers = base.select(F.col("k").alias("__k"), F.sha2("text", 256).alias("__h"), F.col("v").alias("__v")).distinct()
        keys = docs.withColumns({"__k": k, "__h": F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)}).join(numbers, ["__k", "__h"])
    named = spans.select(F.col("k").alias("__k"), F.col("v").alias("__v"), F.col("spans").alias("__spans"))
    ids = named.select("__k", "__v")
    if ids.count() <= PICKED:
        clean = keys.join(F.broadcast(ids), ["__k", "__v"], "left_anti").select(*docs.columns)
        marked = keys.join(F.broadcast(ids), ["__k", "__v"], "left_semi").join(named, ["__k", "__v"])
    else:
        both = keys.join(named, ["__k", "__v"], "left")
        clean, marked = both.where(F.col("__spans").isNull()).select(*docs.columns), both.where(F.col("__spans").isNotNull())
    marked = marked.select(*docs.columns, "__spans")
    at = docs.columns.index("text")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [cut_text(t.encode(), *s).decode() if s else t for t, s in zip(batch.column(at).to_pylist(), _spans(batch.column(batch.num_columns - 1)))]
            columns = [*batch.columns[:at], pa.array(got, pa.string()), *batch.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    touched = marked.mapInArrow(shorten, docs.schema)
    if "n_chars" in docs.columns:
        touched = touched.withColumn("n_chars", F.length("text").cast("long"))
    return clean.unionAll(touched.select(*docs.columns))

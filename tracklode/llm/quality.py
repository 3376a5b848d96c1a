"""Quality classifier (op 2): naive Bayes support vectors.

A text's features are indicators of n-grams: words, word pairs, and runs of one to three word shapes, hashed to
2**18 buckets. A bucket's indicator is scaled by the log-count ratio of the two classes, each row is brought to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent. Margins of held-out folds of the fitting
rows give a logistic curve, which turns margins into scores.

Class counts cover every labelled training row; only the fit takes a bounded sample (``max_fit_rows`` and
``max_fit_features``). Counts are added up by bucket before and after one shuffle; what the driver gets is bounded by
the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklode.llm.common import only, release, small_batches

BITS = 18
SIZE = 1 << BITS
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Labels to be broadcast at most, 16 bytes each; beyond that the texts are joined with them by a shuffle.
BROADCAST_LABELS = 1_000_000

_UPPER, _LOWER, _DIGIT = regex.compile(r"\p{Lu}+"), regex.compile(r"[^\W\d_A]+"), regex.compile(r"\p{N}+")


def shape(word: str) -> str:
    """The word with runs of capitals as A, of other letters as a, of digits as 0; long runs of marks are cut."""
    return _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", word)))[:24]


class Grams(dict):
    """Distinct feature buckets of a text. Words map to rows of ``codes``, the hashes of word and shape."""

    def __init__(self, limit: int = 600_000):
        only("quality")
        self.codes = np.zeros((limit, 2), np.uint64)
        self.shapes: dict[str, int] = {}

    def __missing__(self, w: str) -> int:
        at = self[w] = len(self)
        form = "a" if w.isalpha() and w.islower() and w.isascii() else shape(w)
        code = self.shapes.get(form)
        if code is None:
            if len(self.shapes) > 100_000:
                self.shapes.clear()
            code = self.shapes[form] = xxhash.xxh64_intdigest(form, 2)
        self.codes[at] = xxhash.xxh64_intdigest(w.lower(), 1), code
        return at

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.zeros(0, np.int64)
        if len(self) + len(words) > len(self.codes):
            self.clear()
            if len(words) > len(self.codes):
                self.codes = np.zeros((len(words), 2), np.uint64)
        w, s = self.codes[np.array([self[x] for x in words], dtype=np.int32)].T
        s2 = s[:-1] * MIX + s[1:]
        codes = np.concatenate([s, s2 + np.uint64(5), s2[:-1] * MIX + s[2:] + np.uint64(7), w, w[:-1] * MIX + w[1:] + np.uint64(3)])
        found = np.sort((codes * MIX >> np.uint64(64 - BITS)).astype(np.int32))
        return found[np.append(True, found[1:] != found[:-1])].astype(np.int64)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_hinge(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, size: int, passes: int = 12, seed: int = 1) -> np.ndarray:
    """Weights of the linear hinge-loss model by dual coordinate descent; the last weight is the bias.

    ``cost[i]`` bounds the dual variable of row i. Each step solves one variable exactly and keeps
    ``w = sum(alpha_i * y_i * x_i)`` up to date; rows at a bound that want to stay there are passed over.
    """
    w, alpha, rng = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    square = [float(v @ v) + 1.0 for v in values]
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, x, sign = rows[i], values[i], y[i]
            slope = sign * (w[at] @ x + w[-1]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[at] += step * sign * x
                w[-1] += step * sign
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w


def fit_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton steps on a smoothed likelihood."""
    pos, neg = max(1, (y > 0).sum()), max(1, (y <= 0).sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 2.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g, h = p - target, p * (1 - p) + 1e-9
        ga, gb = (g * margin).sum() + 1e-3 * a, g.sum()
        aa, ab, bb = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum()
        det = aa * bb - ab * ab
        if det <= 1e-12:
            break
        da, db = (bb * ga - ab * gb) / det, (aa * gb - ab * ga) / det
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
        if abs(da) + abs(db) < 1e-7:
            break
    return float(max(a, 1e-3)), float(b)


@dataclass
class Model:
    """``scaled`` is weight times ratio by bucket, ``square`` the ratio's square; both have the fixed size 2**18."""

    scaled: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, buckets: np.ndarray) -> float:
        length = float(np.sqrt(self.square[buckets].sum())) if len(buckets) else 0.0
        return self.bias + (float(self.scaled[buckets].sum()) / length if length else 0.0)

    def score(self, buckets: np.ndarray) -> float:
        z = self.slope * self.margin(buckets) + self.offset
        return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))


def training_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """One label a document: ``doc_id, y``. Null ids and labels are left out; of differing labels the more frequent
    counts, 1 on a tie. Rows of the held-out fold are never read."""
    kept = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
    return kept.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_fit_rows: int = 12_000, max_fit_features: int = 24_000_000, smoothing: float = 1.0, cost: float = 1.0
) -> Model:
    """Fits the model. Without labelled rows of both classes, all texts get the share of label 1 (0.5 if none).

    The fit takes a sample of the labelled rows by the hash of their ids: all, or the share that leaves about
    ``max_fit_rows`` rows and ``max_fit_features`` indicators, whichever is less. It runs in one executor's task, so
    the driver sees tables of 2**18 numbers alone.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = training_labels(labels, label)
    if marked.count() <= BROADCAST_LABELS:
        marked = F.broadcast(marked)
    rows = docs.select("doc_id", "text").join(marked, "doc_id")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(), np.zeros((2, SIZE), np.int64)
        n = [0, 0]
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                total[y, grams(text)] += 1
                n[y] += 1
        at = np.nonzero(total.any(axis=0))[0]
        bucket = np.append(at, -1)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.append(total[0, at], n[0])), pa.array(np.append(total[1, at], n[1]))], names=["bucket", "neg", "pos"])

    added = rows.mapInArrow(counts, "bucket long, neg long, pos long").groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toArrow()
    bucket, neg, pos = (added.column(c).to_numpy() for c in ("bucket", "neg", "pos"))
    held = bucket >= 0
    n_neg, n_pos = int(neg[~held].sum()), int(pos[~held].sum())
    if not n_neg or not n_pos:
        share = n_pos / (n_neg + n_pos) if n_neg + n_pos else 0.5
        z = 40.0 if share == 1 else -40.0 if share == 0 else 0.0
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 1.0, z)
    p, q = np.full(SIZE, smoothing), np.full(SIZE, smoothing)
    p[bucket[held]] += pos[held]
    q[bucket[held]] += neg[held]
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    features_in_all = int(neg[held].sum() + pos[held].sum())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            got = [grams(t).astype(np.int32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.binary())], names=["doc_id", "y", "buckets"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        table = pa.Table.from_batches(got, got[0].schema if got else pa.schema({"doc_id": pa.int64(), "y": pa.int32(), "buckets": pa.binary()}))
        table = table.sort_by([("doc_id", "ascending"), ("buckets", "ascending"), ("y", "ascending")]).combine_chunks()
        del got
        sizes = np.array(pc.binary_length(table["buckets"])) // 4
        flat = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(x.as_buffer(), np.int32) for x in table["buckets"])])
        label = table["y"].to_numpy().astype(np.int64)
        del table
        model = fit_rows(flat, np.append(0, np.cumsum(sizes)).astype(np.int64), label, ratio, cost)
        del flat
        release()
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (model.scaled, model.square, np.array([model.bias, model.slope, model.offset]))], names=["scaled", "square", "rest"])

    share = min(1.0, max_fit_rows / (n_neg + n_pos), max_fit_features / max(1, features_in_all))
    sampled = rows if share == 1 else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000)))
    made = sampled.mapInArrow(features, "doc_id long, y int, buckets binary").repartition(1).mapInArrow(fit, "scaled binary, square binary, rest binary").toArrow()
    scaled, square, rest = (np.frombuffer(made.column(c)[0].as_py(), np.float64) for c in ("scaled", "square", "rest"))
    return Model(scaled, square, *map(float, rest))


def fit_rows(flat: np.ndarray, ends: np.ndarray, label: np.ndarray, ratio: np.ndarray, cost: float) -> Model:
    """The model of rows of distinct buckets, ``flat[ends[i] : ends[i + 1]]`` of row i, in the order given, with labels 0 or 1.

    Each class has the same total cost. Three folds give the margins that the logistic curve goes through.
    """
    y = np.where(label == 1, 1.0, -1.0)
    scaled = ratio[flat]
    at = [flat[a:b] for a, b in zip(ends, ends[1:])]
    values = [scaled[a:b] for a, b in zip(ends, ends[1:])]
    for v in values:
        v /= max(1e-12, np.sqrt((v**2).sum()))
    weight = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    fold, margin = np.arange(len(y)) % 3, np.zeros(len(y))
    for k in range(3):
        take = np.nonzero(fold != k)[0]
        w = fit_hinge([at[i] for i in take], [values[i] for i in take], y[take], weight[take], len(ratio))
        for i in np.nonzero(fold == k)[0]:
            margin[i] = w[at[i]] @ values[i] + w[-1]
    slope, offset = fit_curve(margin, y)
    w = fit_hinge(at, values, y, weight, len(ratio))
    return Model(w[:-1] * ratio, ratio**2, float(w[-1]), slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, 0 to 1, higher where label 1 is likelier. Null texts count as empty, and an empty text
    gets the score of the bias alone. A column ``score`` of the input is replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.drop("score")
    shared = spark.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{n}` {t}" for n, t in base.dtypes), "score double"])
    at = base.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(), shared.value
        for batch in batches:
            got = pa.array([held.score(grams(t)) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], schema=batch.schema.append(pa.field("score", pa.float64())))

    return base.mapInArrow(run, schema)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    return score(docs, train(docs, labels, **options)).where(F.col("score") >= threshold).select(*docs.columns)

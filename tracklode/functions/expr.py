"""Column builders: casts that cannot fail, label and reason helpers, array arithmetic, ranks.

All are built-in expressions; nothing here starts a job or calls Python for a row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    """The value as text, '' for null and NaN."""
    c = col(c)
    return F.when(F.lower(c.cast("string")) == "nan", "").otherwise(F.coalesce(c.cast("string"), F.lit("")))


def truthy(c: Column | str) -> Column:
    return F.coalesce(F.lower(col(c).cast("string")) == "true", F.lit(False))


def truthy_wide(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin("true", "1", "yes", "y"), F.lit(False))


def number(c: Column | str) -> Column:
    """The value as a double; null if it is no number."""
    return col(c).try_cast("double")


def safe_float(c: Column | str, default: float | None = 0.0) -> Column:
    v = number(c)
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(default).cast("double")).otherwise(v)


def finite(c: Column | str) -> Column:
    return safe_float(c, None)


def clamp(c: Column | str, low: Column | float = 0.0, high: Column | float = 1.0) -> Column:
    """Between low and high; NaN becomes high, null stays null (least and greatest alone pass nulls over)."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(col(c).isNotNull(), F.greatest(low, F.least(high, col(c))))


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded; NaN and infinities become null."""
    return F.round(finite(c), digits)


def either(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty; empty text if there is none."""
    return F.coalesce(*(F.nullif(col(c).cast("string"), F.lit("")) for c in columns), F.lit(""))


def either_number(*columns: Column | str) -> Column:
    """The first value that is neither null nor 0."""
    return F.coalesce(*(F.nullif(number(c), F.lit(0.0)) for c in columns))


def first_match(cases: list[tuple[Column, Column | str | float]], default: Column | str | float | None) -> Column:
    """The value of the first condition that holds; a null condition does not hold."""
    out = F
    for condition, value in cases:
        out = out.when(condition, value)
    return out.otherwise(default) if cases else F.lit(default)


def reasons(*cases: tuple[Column, str], sep: str = ";") -> Column:
    """Names of the conditions that hold, in order."""
    return F.concat_ws(sep, *(F.when(condition, F.lit(name)) for condition, name in cases))


def items(c: Column | str, pattern: str = ";") -> Column:
    """The non-empty parts of a delimited text, as an array; null gives an empty one."""
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), pattern), lambda x: F.trim(x)), lambda x: x != "")


def joined(c: Column | str, sep: str = ";") -> Column:
    return F.array_join(col(c), sep)


def unique_in_order(c: Column | str) -> Column:
    return F.array_distinct(F.filter(F.transform(col(c), lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared part of two sets: 1 if both are empty, 0 if one is."""
    a, b = F.array_distinct(col(a)), F.array_distinct(col(b))
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / F.greatest(union, F.lit(1)))


def overlaps(a: Column | str, b: Column | str) -> Column:
    return F.size(F.array_intersect(col(a), col(b))) > 0


def minus(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(col(a), col(b), lambda x, y: x.cast("double") - y.cast("double"))


def l2(a: Column | str, clean: bool = True) -> Column:
    """Euclidean length of an array; components that are null or not finite count as 0."""
    take = (lambda x: safe_float(x)) if clean else (lambda x: x)
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda s, x: s + take(x) * take(x)))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays; null if one has length 0."""
    length = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(length > 0, dot(a, b) / length)


def array_mean(a: Column | str) -> Column:
    a = col(a)
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.nullif(F.size(a), F.lit(0))


def quaternion_norm(pose: Column | str) -> Column:
    """Length of components 4 to 7 of a pose (x, y, z, then the quaternion)."""
    return l2(F.slice(col(pose), 4, 4), clean=False)


def ee16(left_pose: str, left_grip: str, right_pose: str, right_grip: str) -> Column:
    return F.concat(left_pose, F.array(left_grip), right_pose, F.array(right_grip))


def ratio_consistency(action: Column | str, visual: Column | str) -> Column:
    """Agreement of action and visual energy: 1 less the distance of their log-scaled sizes."""
    a = clamp(F.log1p(100 * col(action)) / F.log1p(F.lit(8.0)))
    v = clamp(F.log1p(col(visual) / 4) / F.log1p(F.lit(4.0)))
    return 1 - F.abs(a - v)


def feature_distance(b: Column, e: Column, h: Column) -> Column:
    return F.sqrt(b * b + 10_000.0 * e * e + h * h)


def length_ratio_ok(video: Column | str, action: Column | str) -> Column:
    r = col(video) / F.nullif(col(action), F.lit(0))
    return F.coalesce((r >= 0.1) & (r <= 10), F.lit(False))


def average_hash(a: Column | str) -> Column:
    """'1' where a component is over the mean, else '0'."""
    a = col(a)
    mean = array_mean(a)
    return F.array_join(F.transform(a, lambda x: F.when(x.cast("double") > mean, "1").otherwise("0")), "")


def hamming(a: Column | str, b: Column | str) -> Column:
    """Differing characters of two texts of one length."""
    x, y = F.split(col(a), ""), F.split(col(b), "")
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p != q).cast("int")), F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))


def half_even(c: Column | str) -> Column:
    return F.bround(col(c)).cast("long")


def even_indices(count: Column | str, n: int) -> Column:
    """``n`` indices spread evenly over 0..count-1, halves to the even neighbour, each once."""
    c = col(count)
    step = (c - 1) / max(1, n - 1)
    spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: half_even(i * step))
    return F.when(c <= 0, F.array().cast("array<bigint>")).when(c <= n, F.sequence(F.lit(0).cast("long"), c.cast("long") - 1)).otherwise(F.array_distinct(spread))


def quantile_bin(rank: Column, n: Column, bins: int) -> Column:
    """Bin of a first-come rank (from 1) among n rows, as cutting the ranks at their quantiles gives it."""
    return F.when(n <= 1, F.lit(0)).otherwise((F.greatest(F.ceil((rank - 1) * bins / (n - 1)), F.lit(1)) - 1).cast("int"))


def arithmetic_hash(c: Column | str, modulus: int = 1_000_003) -> Column:
    """A spread of integer ids that any SQL engine gives alike."""
    return F.pmod(col(c).cast("long") * F.lit(2_654_435_761).cast("long"), F.lit(modulus).cast("long"))


def base_name(c: Column | str) -> Column:
    return F.substring_index(col(c), "__job_", 1)


def episode_number(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"episode(\d+)", 1).try_cast("int")


def safe_name(c: Column | str) -> Column:
    return F.translate(col(c), "-+", "__")


def absolute_path(root: Column | str, path: Column | str) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.when(F.startswith(col(path), F.lit("/")), col(path)).otherwise(F.concat_ws("/", root, col(path)))


def relative_path(path: Column | str, root: str) -> Column:
    cut = root.rstrip("/") + "/"
    return F.when(F.startswith(col(path), F.lit(cut)), F.substring(col(path), len(cut) + 1, 1 << 20)).otherwise(col(path))


def target_count(c: Column | str) -> Column:
    return F.coalesce(col(c).try_cast("int"), F.lit(0))


def clock(seconds: Column | str) -> Column:
    """Whole seconds as hours, minutes and seconds."""
    s = F.greatest(col(seconds), F.lit(0)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def bar(done: Column | str, total: Column | str, width: int = 30) -> Column:
    """A progress bar of fixed width."""
    share = clamp(col(done) / F.greatest(col(total), F.lit(1)))
    n = F.floor(share * width).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("#"), n), F.repeat(F.lit("-"), F.lit(width) - n), F.lit("]"))


def set_split(name: Column | str) -> tuple[Column, Column]:
    """``split`` and ``prompt_set`` of a video set's name."""
    name = col(name)
    split = F.when(F.contains(name, F.lit("val")), "val").otherwise("test")
    return split, first_match([(F.endswith(name, F.lit("_1")), "variant_1"), (F.endswith(name, F.lit("_2")), "variant_2")], "base")

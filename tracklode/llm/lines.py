"""Line dedup (op 8), DataFrame functions only: lines that much of a site repeats.

For each host, the pages that contain a line are divided by the pages of the host; a line over the ratio is
boilerplate. Lines are counted once a page, by 128-bit digest, with sums before the shuffle. A host cannot have more
boilerplate lines than its lines a page divided by the ratio, so each host's set is a small array. The sets are written
to the shared folder and join the pages on the host as a plain exchange, so that AQE splits a hot host; pages drop lines
in place without being taken apart and put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklode.llm.common import Scratch


#: Elements whose content is no text, and elements that begin and end lines.
HIDDEN = ("script", "style", "noscript", "template")
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "legend", "li", "main", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
)

INVISIBLE = rf"(?is)<!--.*?-->|<(?:{'|'.join(HIDDEN)})\b[^>]*>.*?</(?:{'|'.join(HIDDEN)})\s*>"
BLOCK = rf"(?i)</?(?:{'|'.join(BLOCKS)})\b[^>]*>"


def page_host(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def page_text(html: Column) -> Column:
    """The lines of a page: what stands between block elements and line breaks, without other tags, comments and hidden elements.

    A hidden element lasts to the next end tag of a hidden element. Lines are trimmed, and empty ones left out. A page
    without text gives an empty text, a null page null.
    """
    shown = F.regexp_replace(F.regexp_replace(html, INVISIBLE, ""), BLOCK, "\n")
    lines = F.split(F.regexp_replace(shown, "<[^>]*>", ""), "[\n\r]")
    return F.array_join(F.filter(F.transform(lines, lambda x: F.btrim(x)), lambda x: x != ""), "\n")


def site_pages(pages: DataFrame) -> DataFrame:
    """``page_id, host, text`` of raw pages ``page_id, url, html``."""
    return pages.select("page_id", page_host(F.col("url")).alias("host"), page_text(F.col("html")).alias("text"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def boilerplate(pages: DataFrame, scratch: Scratch, host: str, text: str, ratio: float, min_pages: int, copies_once: bool = False) -> DataFrame:
    """``host, lines``: digests of the host's lines that are on more than ``ratio`` of its pages and on ``min_pages``.

    Lines are compared without the spaces at their ends; blank lines never count. ``copies_once`` counts the pages of
    a host that have one text as one page.
    """
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda x: F.btrim(x))
    once = F.array_distinct(F.filter(trimmed, lambda x: x != ""))
    page = pages.select(F.col(host).alias("host"), F.col(text)).where(F.col("host").isNotNull())
    page = page.withColumn("page", _digest(F.col(text)) if copies_once else F.lit(None).cast("binary"))
    each = page.where(F.col(text).isNotNull()).select("host", "page", F.explode(once).alias("line")).select("host", "page", _digest(F.col("line")).alias("line"))
    if copies_once:
        each, page = each.distinct(), page.select("host", "page").distinct()
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = scratch.write(page.groupBy("host").agg(F.count("*").alias("pages")), "pages-of-host")
    over = counts.join(totals, "host").where(F.col("n") > F.col("pages") * ratio)
    return scratch.write(over.groupBy("host").agg(F.collect_set("line").alias("lines")), "boilerplate")


def drop_boilerplate(pages: DataFrame, scratch: Scratch, host: str = "source", text: str = "text", ratio: float = 0.03, min_pages: int = 5, copies_once: bool = False) -> DataFrame:
    """``pages`` with boilerplate lines cut from ``text``, and ``n_lines`` and ``n_dropped`` (0 for a null text).

    Every row of ``pages`` counts as a page, repeated rows too, unless ``copies_once`` is set. Pages without a host, and texts without such lines, stay
    as they are. Columns ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    base = pages.drop("n_lines", "n_dropped")
    sets = boilerplate(base, scratch, host, text, ratio, min_pages, copies_once).select(F.col("host").alias("__host"), F.col("lines").alias("__set"))
    both = base.join(sets, F.col(host) == F.col("__host"), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: (F.btrim(x) == "") | ~F.array_contains(F.col("__set"), _digest(F.btrim(x))))
    out = both.withColumn("__lines", lines).withColumn("__kept", F.when(F.col("__set").isNotNull(), kept).otherwise(F.col("__lines")))
    n, left = (F.coalesce(F.size(c), F.lit(0)) for c in ("__lines", "__kept"))
    count = {"n_lines": F.greatest(n, F.lit(0)).cast("long"), "n_dropped": F.greatest(n - left, F.lit(0)).cast("long")}
    shorter = F.when(F.size("__kept") < F.size("__lines"), F.array_join("__kept", "\n")).otherwise(F.col(text))
    return out.withColumns(count | {text: shorter}).select(*base.columns, "n_lines", "n_dropped")

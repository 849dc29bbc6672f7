"""Line deduplication by frequency within a site, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, written

#: A line on more than this share of a host's pages is boilerplate ...
RATIO = 0.05
#: ... if it is on so many pages at least: a line that is on one page is no repetition.
MIN_PAGES = 2
#: Boilerplate lines, of 16 bytes each, up to which their lists are broadcast.
BROADCAST_LINES = 500_000


def _lines(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of a line, as two longs."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _keys(text: str) -> Column:
    """Keys of the lines of a text that have more than white space."""
    return F.transform(F.filter(_lines(F.col(text)), lambda x: F.trim(x) != ""), _key)


def boilerplate_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = True, host: str = "source", text: str = "text") -> DataFrame:
    """host and key of each line on more than ratio of the host's pages, with the counts: host, a, b, pages, host_pages.

    Every row is a page; without copies, rows of a host with the same text are one page. A page counts once for a line
    that it repeats. Keys of lines, not lines, are shuffled, and counted on the map side first: a host or line with a
    third of all pages sends one row per task.
    """
    sited = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).where(F.col("host").isNotNull())
    if copies:
        totals, pages = sited.select("host"), sited.select("host", _keys("text").alias("keys"))
    else:
        page = ["host", F.xxhash64("text").alias("ta"), F.xxhash64(F.lit(1), "text").alias("tb")]
        totals = sited.select(*page).distinct()
        pages = sited.select(*page, _keys("text").alias("keys")).groupBy("host", "ta", "tb").agg(F.first("keys").alias("keys"))
    sizes = totals.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("host_pages"))
    lines = pages.select("host", F.explode(F.array_distinct("keys")).alias("key"))
    counts = lines.groupBy("host", F.col("key.a").alias("a"), F.col("key.b").alias("b")).agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    return counts.join(sizes, F.col("host") == F.col("of")).where(F.col("pages") > F.col("host_pages") * ratio).select("host", "a", "b", "pages", "host_pages")


def drop_boilerplate_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = True, host: str = "source", text: str = "text") -> DataFrame:
    """docs with boilerplate lines taken out of their texts; all columns, of any names, and all rows are kept.

    Lines are split at line feeds. A line is dropped, each time that it occurs, if more than ratio of the pages of its
    host hold it, and at least min_pages do. Blank lines count for nothing and stay. A page with so many exact copies
    loses all its lines, unless copies is false: then pages of a host with the same text are one.

    A host has at most (mean lines of its pages) / ratio such lines, so its list fits a row; the lists are joined to
    the pages by host. They are counted first: up to BROADCAST_LINES lines are broadcast and pages stay where they
    are; beyond that pages are shuffled by host, and Spark splits those of a hot host (AQE skew join).

    Defined cases: a null text stays null and is a page without lines; a null host is no site, its pages stay as they
    are; a text of boilerplate only becomes empty; repeated rows are all kept; an empty table gives an empty one.
    """
    site, drop, here = (free_name(docs, n) for n in ("site", "drop", "here"))
    found = written(boilerplate_lines(docs, ratio, min_pages, copies, host, text).select("host", "a", "b"), "boilerplate")
    lists = found.groupBy(F.col("host").alias(site)).agg(F.collect_list(F.struct("a", "b")).alias(drop))
    lists = F.broadcast(lists) if found.count() <= BROADCAST_LINES else lists
    marked = docs.join(lists, F.col(host) == F.col(site), "left").withColumn(here, F.array_intersect(_keys(text), F.col(drop)))
    kept = F.array_join(F.filter(_lines(F.col(text)), lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(here), _key(x))), "\n")
    cleaned = F.when(F.size(F.col(here)) > 0, kept).otherwise(F.col(text))
    return marked.withColumn(text, cleaned).select(*[F.col(f"`{c}`") for c in docs.columns])

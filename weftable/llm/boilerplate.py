"""Line dedup by site-relative frequency.

A line of a page is boilerplate if more than ``ratio`` of its host's pages contain it. A line of ``LONG`` characters or more, which
chance hardly repeats, is also boilerplate if it lies in more than ``long_ratio`` of the host's pages, where pages with the same longest
line count as one: copies of a page share all their lines, and are not to lose them. Either way it must lie in ``min_pages`` pages.
Such lines are dropped from every page of the host; all other lines, blank ones included, stay in their order.

Defined cases: a null text is an empty text; a null host is a host of its own; a line repeated in one
page counts once; lines of nothing but spaces, tabs, carriage returns, form feeds and vertical tabs are blank and never
boilerplate; hosts with fewer than ``min_pages`` pages having a line keep it; an empty table gives an empty table. All columns of the
input come through, whatever their names, ``text`` with the kept lines only; counts take the place of input columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

RATIO = 0.1
LONG_RATIO = 0.01
MIN_PAGES = 5
LONG = 20
BLANK = " \t\r\f\v"
COUNTS = ("n_lines", "n_dropped")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """Two independent hashes, 96 bits: what is shuffled in place of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _longest(lines: Column) -> Column:
    """Hash of the longest line, of equally long ones the last in order."""
    return F.xxhash64(F.array_max(F.transform(lines, lambda x: F.struct(F.length(x).alias("n"), x.alias("line")))))


def boilerplate_lines(
    pages: DataFrame,
    host: str,
    text: str,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    long_ratio: float | None = LONG_RATIO,
) -> DataFrame:
    """One row per host that has boilerplate: ``host``, ``keys`` (hash pairs of its boilerplate lines).

    Each boilerplate line takes more than ``ratio`` (or ``long_ratio``) of the host's pages, so a host has fewer than
    1/``ratio`` times the mean number of lines of its pages. Lines are hashed within their page; only hashes are unfolded.
    """
    own = pages.select(F.col(f"`{host}`").alias("host"), _lines(F.col(f"`{text}`")).alias("lines"))
    totals = own.groupBy("host").agg(F.count("*").alias("pages"))
    texts = F.filter(F.array_distinct("lines"), lambda x: F.trim(x, F.lit(BLANK)) != "")
    keys = F.transform(texts, lambda x: F.struct(_key(x).alias("key"), (F.length(x) >= LONG).alias("long")))
    page = F.lit(None).cast("bigint") if long_ratio is None else _longest(F.col("lines"))
    of_page = own.select("host", page.alias("page"), keys.alias("keys")).select("host", "page", F.explode("keys").alias("line"))
    keyed = of_page.select("host", "line.key.a", "line.key.b", F.when(F.col("line.long"), F.col("page")).alias("page"))
    if long_ratio is None:
        counts = keyed.groupBy("host", "a", "b").agg(F.count("*").alias("n"))
    else:
        per_page = keyed.groupBy("host", "a", "b", "page").agg(F.count("*").alias("n"))
        counts = per_page.groupBy("host", "a", "b").agg(F.sum("n").alias("n"), F.count("page").alias("different"))
    counts = counts.filter(F.col("n") >= min_pages)
    often = F.col("n") > F.lit(ratio) * F.col("pages")
    if long_ratio is not None:
        often |= (F.col("different") >= min_pages) & (F.col("different") > F.lit(long_ratio) * F.col("pages"))
    total = totals.select(F.col("host").alias("of"), "pages")
    return (
        counts.join(total, F.col("host").eqNullSafe(F.col("of")))
        .filter(often)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("keys"))
    )


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = False,
    long_ratio: float | None = LONG_RATIO,
) -> DataFrame:
    """``pages`` without boilerplate lines; with ``counts`` also ``n_lines`` and ``n_dropped``.

    The boilerplate of all hosts is written first, so the join with the pages is a broadcast exactly
    when its size allows; else it is a shuffle by host, whose hot partitions Spark splits.
    """
    found = written(boilerplate_lines(pages, host, text, ratio, min_pages, long_ratio), "boilerplate")
    found = found.select(F.struct(F.col("host"), F.col("keys")).alias("__found"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("__row"))
    row = F.col("__row")
    joined = rows.join(found, row[host].eqNullSafe(F.col("__found.host")), "left").select(
        "__row", F.col("__found.keys").alias("__keys"), _lines(row[text]).alias("__lines")
    )
    # the first hashes of a page's lines meet those of the host as sets; most pages have none of them
    here = F.array_intersect(F.transform("__lines", lambda x: F.xxhash64(x)), F.transform("__keys", lambda k: k["a"]))
    near = F.when(F.col("__keys").isNotNull(), F.filter("__keys", lambda k: F.array_contains("__here", k["a"])))
    met = joined.select("__row", "__lines", "__keys", F.when(F.col("__keys").isNotNull(), here).alias("__here"))
    met = met.select("__row", "__lines", F.when(F.size("__here") > 0, near).alias("__near"))
    left = F.filter("__lines", lambda x: ~F.array_contains("__near", _key(x)))
    kept = met.select("__row", "__lines", F.when(F.col("__near").isNull(), F.col("__lines")).otherwise(left).alias("__kept"))
    names = [c for c in pages.columns if not (counts and c in COUNTS)]
    columns = [F.array_join("__kept", "\n").alias(c) if c == text else row[c].alias(c) for c in names]
    if counts:
        sizes = (F.size("__lines"), F.size("__lines") - F.size("__kept"))
        columns += [n.cast("long").alias(c) for n, c in zip(sizes, COUNTS)]
    return kept.select(*columns)

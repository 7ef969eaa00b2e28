"""Line dedup by site-relative frequency.

A line is boilerplate on a host if more than ``max_ratio`` of the host's pages contain it.  Pages are counted per host
and per (host, line), both pre-aggregated in every task, so a hot host or line costs one row per task.  The boilerplate
lines of a host are few by arithmetic: they number at most (distinct lines of its average page) / ``max_ratio``.
That bounded list per host is joined back to the pages; Catalyst broadcasts it only if its files are
small, and otherwise splits the hot host of the shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm.frames import staged

MAX_RATIO = 0.1
MIN_HOST_PAGES = 20


def boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                      min_host_pages: int = MIN_HOST_PAGES) -> DataFrame:
    """``host, lines``: the hashes of every host's boilerplate lines, for hosts that have any.

    Every row is a page.  A line counts once per page, compared without spaces around it.  Blank lines are never
    boilerplate.  Hosts of fewer than ``min_host_pages`` pages are not judged, nor are pages without a host.
    """
    known = pages.select(F.col(host).alias("host"), F.col(text).alias("body")).where(F.col("host").isNotNull())
    hashed = known.select("host", F.array_distinct(F.transform(F.filter(_lines(F.col("body")), _said), _key)).alias("keys"))
    # One pass counts pages (key NULL) and lines: both are sums over the same rows.
    counted = (
        hashed.select("host", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), F.coalesce("keys", F.array())))
                      .alias("key"))
        .groupBy("host", "key").agg(F.count("*").alias("n"))
    )
    counted = staged(counted.where((F.col("n") >= 2) | F.col("key").isNull()), "line-counts")
    totals = counted.where(F.col("key").isNull() & (F.col("n") >= min_host_pages)).select("host", F.col("n").alias("pages"))
    frequent = counted.where(F.col("key").isNotNull()).join(totals, "host").where(F.col("n") > max_ratio * F.col("pages"))
    return frequent.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("lines"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                     min_host_pages: int = MIN_HOST_PAGES, counts: tuple[str, str] | None = None) -> DataFrame:
    """``pages`` with the boilerplate lines of their host taken out of ``text``; every row stays.

    counts: names of two optional output columns, lines before and lines dropped (they replace columns of that name).
    A null text stays null and has no lines; an empty text has one blank line; a page that consisted of boilerplate
    only becomes empty.  Pages without a host stay as they are.  Other columns pass through untouched, whatever their names.
    """
    lines = staged(boilerplate_lines(pages, host, text, max_ratio, min_host_pages), "boilerplate")
    rows = pages.select(F.struct("*").alias("row"), F.col(host).alias("host"))
    joined = rows.join(lines, "host", "left")
    before = _lines(F.col(f"row.`{text}`"))
    kept = F.when(F.col("lines").isNull(), before).otherwise(
        F.filter(before, lambda x: ~(_said(x) & F.array_contains("lines", _key(x)))))
    cut = joined.select("row", before.alias("before"), kept.alias("kept"))
    names = dict(zip(counts, (F.coalesce(F.size("before"), F.lit(0)), F.coalesce(F.size("before") - F.size("kept"), F.lit(0))),
                     strict=True)) if counts else {}
    new = {text: F.array_join("kept", "\n"), **{n: c.cast("bigint") for n, c in names.items()}}
    passed = [new.pop(c).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in pages.columns]
    return cut.select(*passed, *[c.alias(n) for n, c in new.items()])


def _lines(body: Column) -> Column:
    return F.split(body, "\n", -1)


def _said(line: Column) -> Column:
    return F.trim(line) != ""


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))

"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of a host if the share of the host's pages that contain it exceeds `ratio` and at least `least_pages` pages of
the host contain it: on a small host a share alone says nothing, as a line of one page is above a tenth of nine. The rule is the same
for hosts of any size; a host of fewer pages than that keeps all lines. Lines are compared whole, after trimming spaces. Each page counts a line once; pages are counted per host and line with sums before the shuffle, on a pair of
64-bit hashes instead of the text. A host has at most (lines per page) / ratio such lines, so a host's list is one short row; pages
meet it by host, where Spark broadcasts a small table and otherwise splits a hot host at run time.

Defined cases: blank lines are kept and not counted; a null text is empty; a null host is a host of its own (""). Rows with equal
ids are pages of their own. An empty table gives an empty result. A very long page is one row, as any other; markup that is opened
and never closed is no script, style or comment, only its tags go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import materialize

RATIO, LEAST_PAGES = 0.1, 3
#: what stands between the lines of a web page: scripts, styles, comments and all tags
MARKUP = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)"


def page_text(html: str) -> Column:
    """The text between tags, one line each."""
    return F.regexp_replace(F.coalesce(F.col(html), F.lit("")), MARKUP, "\n")


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))


def lines_of(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line))


def key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.reverse(line), line).alias("b"))


def boilerplate(lines: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """lines: host, lines. One row per host with boilerplate: host_key and the keys of its lines."""
    distinct = F.array_distinct(F.filter("lines", lambda line: line != ""))
    counts = (
        lines.select("host", F.explode(F.transform(distinct, key)).alias("key"))
        .groupBy("host", "key").agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_pages)
    )
    totals = lines.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("pages"))
    return (
        counts.join(totals, counts["host"] == totals["of"])
        .where(F.col("n") > ratio * F.col("pages"))
        .groupBy(F.col("host").alias("host_key")).agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(pages: DataFrame, page_id: str, host: Column, text: Column, ratio: float = RATIO,
                     least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, host, n_lines, n_dropped (lines with text, and those of them dropped) and the text that stays."""
    lines = pages.select(
        F.col(page_id).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), lines_of(text).alias("lines")
    )
    known = materialize(boilerplate(lines.select("host", "lines"), ratio, least_pages))
    joined = lines.join(known, lines["host"] == known["host_key"], "left")
    kept = F.when(F.col("keys").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("keys", key(line)))
    )
    with_text = lambda column: F.size(F.filter(column, lambda line: line != "")).cast("long")
    return joined.withColumn("kept", kept).select(
        "page_id", "host", with_text("lines").alias("n_lines"), (with_text("lines") - with_text("kept")).alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )

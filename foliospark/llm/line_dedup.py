"""Site-relative line frequency: drop lines that stand on too large a share of a host's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Staged, narrow

#: What of a page is not text, and the tags that end a line.
NOT_TEXT = (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->")
BLOCK_TAG = r"(?i)</?(p|div|br|li|ul|ol|dl|dt|dd|nav|h[1-6]|article|footer|header|section|table|tr|td|th|title|head|body|html|blockquote|pre|hr|main|aside|form)([ \t\r\n/][^>]*)?>"
ANY_TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)"


def page_lines(html: Column) -> Column:
    """The lines of a page's text: trimmed of ASCII white space, empty ones left out."""
    t = html
    for p in NOT_TEXT:
        t = F.regexp_replace(t, p, "")
    t = F.regexp_replace(F.regexp_replace(t, BLOCK_TAG, "\n"), ANY_TAG, "")
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c"))), lambda x: x != "")


def line_dedup(pages: DataFrame, max_percent: int = 30, min_pages: int = 2, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, host, n_lines, n_dropped, lines`` (the lines that stay, in order).

    A line of a host is boilerplate when it stands on more than ``max_percent`` per cent of that host's pages and on
    ``min_pages`` at least (one page alone shows nothing); every occurrence goes. A page counts once for a line it repeats; repeated rows count as
    pages of their own. Null or unusable URLs form the host ``''``; null or empty html has no lines. Lines are compared
    by 64-bit hashes within their host.

    Counts are combined before they are shuffled, so a host or line of any frequency costs one row per task. The
    boilerplate of a host is at most 100 / max_percent times its mean lines per page, and meets the pages in a join on
    (host, line) between written tables, whose hot keys adaptive execution splits.
    """
    st = Staged(pages.sparkSession)
    p = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    p = p.select(
        "page_id",
        F.lower(F.coalesce(F.regexp_extract("url", HOST, 2), F.lit(""))).alias("host"),
        F.coalesce(page_lines(F.col("html")), F.array().cast("array<string>")).alias("lines"),
    )
    p = p.select("page_id", "host", "lines", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"))
    p = st.write(p.withColumn("uid", F.monotonically_increasing_id()), "line-pages")
    keys = p.select("uid", "host", F.explode(F.array_distinct("hashes")).alias("line"))
    seen = keys.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    totals = p.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    boiler = seen.where(F.col("n") >= min_pages).join(totals, "host").where(F.col("n") * 100 > F.col("total") * max_percent)
    boiler = st.write(boiler.select("host", "line"), "line-boilerplate")
    drops = keys.join(boiler, ["host", "line"], "left_semi").groupBy("uid").agg(F.collect_list("line").alias("drop"))
    out = p.join(drops, "uid", "left").withColumn("drop", F.coalesce("drop", F.array().cast("array<bigint>")))
    kept = F.expr("transform(filter(arrays_zip(lines, hashes), z -> not array_contains(drop, z.hashes)), z -> z.lines)")
    out = out.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("lines"))
    return out.select("page_id", "host", "n_lines", (F.col("n_lines") - F.size("lines")).cast("long").alias("n_dropped"), "lines")

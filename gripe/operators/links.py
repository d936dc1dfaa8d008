"""Link bookkeeping of the crawl: admission, new-link anti-join, the seen set,
round summaries and the low-yield stop (P7, J1, U1, U2, X7, T9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as L


def admit_links(df: DataFrame, domain: str = L.CRAWL_DOMAIN, bad_suffix: str = L.BAD_LINK_SUFFIX,
                link: str = "link") -> DataFrame:
    """Not null, contains the site domain, trimmed link not ending in ``bad_suffix``."""
    c = F.col(link)
    return df.filter(c.isNotNull() & c.contains(domain) & ~F.trim(c).endswith(bad_suffix))


def new_links(found: DataFrame, seen: DataFrame, key: str = "link", dedup: bool = True) -> DataFrame:
    """Found links not in the seen set (J1, U1).  ``dedup`` also removes repeats
    within the round (the original crawler kept them)."""
    f = found.dropDuplicates([key]) if dedup else found
    return f.join(seen.select(key).filter(F.col(key).isNotNull()), on=key, how="left_anti")


def add_seen(seen: DataFrame, new: DataFrame, key: str = "link") -> DataFrame:
    """Seen set ∪ new keys."""
    return seen.select(key).unionByName(new.select(key)).dropDuplicates([key])


def round_summary(links: DataFrame, seen: DataFrame, page: str = "page_id", key: str = "link") -> DataFrame:
    """Per page: anchors found, admitted and new (not seen before this round).

    ``links`` must carry an ``admitted`` boolean.  Within-round repeats count
    on every page, as in the original crawl loop.
    """
    # one row per (page, link) before the join, so a link that stands on every page is not one task's work
    per = links.groupBy(page, key, "admitted").agg(F.count(F.lit(1)).alias("_n"))
    known = seen.select(key).filter(F.col(key).isNotNull()).dropDuplicates([key])
    fresh = per.filter("admitted").select(key).dropDuplicates([key]).join(known, on=key, how="left_anti")
    j = per.join(fresh.withColumn("_fresh", F.lit(True)), on=key, how="left")
    return j.groupBy(page).agg(
        F.sum("_n").alias("n_links"),
        F.sum(F.when(F.col("admitted"), F.col("_n")).otherwise(0)).alias("n_admitted"),
        F.sum(F.when(F.col("admitted") & F.col("_fresh"), F.col("_n")).otherwise(0)).alias("n_new"))


def low_yield_stop(log: DataFrame, site: str = "site", page: str = "page_no", new: str = "n_new",
                   after: int = 10, run: int = 10) -> DataFrame:
    """First page where the crawl of a site stops: page > ``after`` and the
    last ``run`` crawled pages (this one included) all without new links (T9).

    ``log`` has one row per crawled (site, page_no).  A page that was not
    crawled neither counts as empty nor ends a run, as in the crawl loop.  Page
    numbers of a site are bounded by the crawl limit, so the windows per site
    are; the log is pre-aggregated to one narrow row per page.  Output: (site,
    n_pages, stop_page) with stop_page null when the crawl ran to its end.
    """
    w = Window.partitionBy(site).orderBy(page)
    last = w.rowsBetween(-(run - 1), 0)
    pages = log.select(site, page, F.col(new).alias("_new")).withColumn(
        "_stop", (F.col(page) > after) & (F.count(F.lit(1)).over(last) == run) & (F.max("_new").over(last) == 0))
    return pages.groupBy(site).agg(F.count(F.lit(1)).alias("n_pages"),
                                   F.min(F.when(F.col("_stop"), F.col(page))).alias("stop_page"))

"""Rescue of hashes by their candidate addresses: each tries its candidates in order until one is had, and an address that turns out to be a page
adds the candidates of that page to the end, for so many pages at most.

What a hash does next depends on what came back, so it goes in rounds. A round's table holds the rows of open hashes alone: each tries its
next candidates, outcomes come by a function of the caller (a join with a table of answers, or a live fetcher), pages are read where an outcome asks for it,
and hashes that are done leave. Rounds end when none is open, or with the first exhausted quota, which leaves the rest open. Tables are written
between rounds; the driver sees counts alone. Joins are sort-merge joins: tables of addresses compress so well that they would pass for small ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import ranking, recovery

#: Outcomes that end a hash, and the one that may be a page (fixed values).
HAD, QUOTA, PAGE = "ok", "quota_exhausted", "invalid_content"
PAGES = 3
ROW = ["hash", "pos", "url", "source_class", "status", "page"]

#: (url) -> (url, status), and (url) -> (url, html) of those that could be read; one row for each url at most.
Fetch = Callable[[DataFrame], DataFrame]


def rescue(candidates: DataFrame, fetch: Fetch, read: Fetch, pages: int = PAGES, ahead: int = 1) -> tuple[DataFrame, DataFrame]:
    """``candidates``: (hash, rank, url, source_class). Returns attempts (hash, rank, url, source_class, status) and, for each hash, its
    ``status``: ok, quota_exhausted, failed, or open if a quota has ended the run before.

    ``ahead`` candidates of a hash are fetched in a round; of these only those up to the first that is had count as attempts. With 1 nothing is
    fetched that isn't needed; more makes fewer rounds where outcomes cost nothing. An address without an outcome failed.
    """
    first = ranking.first_wins(candidates.where("coalesce(url, '') <> ''").select("hash", F.col("rank").cast("bigint").alias("pos"), "url", "source_class"), ["hash", "url"], ["pos", "source_class"])
    open_ = written(first.select("hash", "pos", "url", "source_class", F.lit(None).cast("string").alias("status"), F.lit(False).alias("page")), "open")
    done = []
    while not open_.isEmpty():
        tried = _tried(open_, fetch, ahead)
        now = written(_with_pages(open_, tried, pages), "tried")
        rows = open_.join(now.select("hash", "url", F.col("status").alias("_s"), F.col("page").alias("_p")).hint("merge"), ["hash", "url"], "left").select("hash", "pos", "url", "source_class", F.coalesce("_s", "status").alias("status"), F.coalesce("_p", "page").alias("page"))
        rows = written(rows.unionByName(_found_on(now.where("page"), open_, read)), "rows")
        # a hash is done once it has its image, or nothing is left to try
        ends = rows.groupBy("hash").agg((F.bool_or(F.coalesce(F.col("status").isin(HAD, QUOTA), F.lit(False))) | (F.count_if(F.col("status").isNull()) == 0)).alias("_end"))
        rows = written(rows.join(ends.hint("merge"), "hash"), "round")
        done.append(rows.where("_end").select(ROW))
        open_ = rows.where("not _end").select(ROW)
        if not now.where(F.col("status") == QUOTA).isEmpty():
            done.append(open_)
            break
    every = done[0] if done else open_
    for more in done[1:]:
        every = every.union(more)
    attempts = every.where("status is not null").select("hash", F.row_number().over(Window.partitionBy("hash").orderBy("pos")).cast("bigint").alias("rank"), "url", "source_class", "status")
    had, quota, left = (F.bool_or(F.coalesce(x, F.lit(False))) for x in (F.col("status") == HAD, F.col("status") == QUOTA, F.col("status").isNull()))
    return attempts, every.groupBy("hash").agg(F.when(had, HAD).when(quota, QUOTA).when(left, "open").otherwise("failed").alias("status"))


def _tried(open_: DataFrame, fetch: Fetch, ahead: int) -> DataFrame:
    """The next candidates of each hash with their outcomes, up to the first that ends it."""
    by_hash = Window.partitionBy("hash").orderBy("pos")
    upcoming = open_.where("status is null").withColumn("_k", F.row_number().over(by_hash)).where(F.col("_k") <= ahead)
    upcoming = written(upcoming.select("hash", "pos", "url"), "upcoming")
    outcome = fetch(upcoming.select("url").distinct()).select("url", F.col("status").alias("_s"))
    known = upcoming.join(outcome.hint("merge"), "url", "left").withColumn("status", F.coalesce("_s", F.lit("failed")))
    ended = F.max(F.col("status").isin(HAD, QUOTA).cast("int")).over(by_hash.rowsBetween(Window.unboundedPreceding, -1))
    return known.withColumn("_over", ended).where(F.coalesce(F.col("_over"), F.lit(0)) == 0).select("hash", "pos", "url", "status")


def _with_pages(open_: DataFrame, tried: DataFrame, pages: int) -> DataFrame:
    """Marks attempts whose page is to be read: those that may be one, while the hash has read fewer than it may."""
    read = open_.groupBy("hash").agg(F.count_if("page").alias("_read"))
    rank = F.sum((F.col("status") == PAGE).cast("int")).over(Window.partitionBy("hash").orderBy("pos"))
    return tried.withColumn("_rank", rank).join(read.hint("merge"), "hash").select("hash", "pos", "url", "status", ((F.col("status") == PAGE) & (F.col("_rank") + F.col("_read") <= pages)).alias("page"))


def _found_on(now: DataFrame, open_: DataFrame, read: Fetch) -> DataFrame:
    """New rows for the candidates of pages, behind all that a hash has, but for addresses that it has already."""
    texts = read(now.select("url").distinct()).select(F.col("url").alias("page_url"), "html")
    lists = recovery.page_candidates(texts).select(F.col("page_url").alias("url"), "candidates")
    last = open_.groupBy("hash").agg(F.max("pos").alias("_last"))
    own = open_.select("hash", "url", F.col("source_class").alias("_class"))
    each = now.select("hash", "pos", "url").join(lists.hint("merge"), "url").join(own.hint("merge"), ["hash", "url"]).select("hash", F.col("pos").alias("_page"), F.concat(F.coalesce("_class", F.lit("")), F.lit("_page")).alias("source_class"), F.posexplode("candidates").alias("_k", "url")).where("url <> ''")
    new = ranking.first_wins(each, ["hash", "url"], ["_page", "_k"]).join(open_.select("hash", "url").hint("merge"), ["hash", "url"], "left_anti").join(last.hint("merge"), "hash")
    place = F.col("_last") + F.row_number().over(Window.partitionBy("hash").orderBy("_page", "_k"))
    return new.select("hash", place.alias("pos"), "url", "source_class", F.lit(None).cast("string").alias("status"), F.lit(False).alias("page"))

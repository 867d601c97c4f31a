"""Operators on manifests: appending with first-wins rows, the best row of a key, candidates of an image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranking


def append(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Old rows and those new ones whose key isn't there yet; old rows come first."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return ranking.first_wins(both, keys, ["_age", *order]).drop("_age")


def rejected(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows accepted and rejected by the first-wins rule."""
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return n.agg(F.count(F.lit(1)).alias("accepted"), (F.sum("_n") - F.count(F.lit(1))).alias("rejected"))


def best_per_hash(rows: DataFrame, key: str, digest: str, order: list[str]) -> DataFrame:
    """A key's first row, or the first with a digest if that has none."""
    return ranking.first_wins(rows, [key], [F.coalesce(F.col(digest), F.lit("")) == "", *order])


def last_url(rows: DataFrame, key: str, url: str, order: str) -> DataFrame:
    """Key and its last url."""
    return rows.groupBy(key).agg(F.max_by(url, order).alias(url))


def in_order(rows: DataFrame, key: str, order: str, limit: int | None = None) -> DataFrame:
    """Distinct keys in the order of first sight."""
    out = rows.groupBy(key).agg(F.min(order).alias("_first")).orderBy("_first", key)
    return (out.limit(limit) if limit is not None else out).select(key)


def done_filter(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that aren't done."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def upsert(state: DataFrame, rows: DataFrame, key: str, order: str, error: str | None = None) -> DataFrame:
    """State with rows written over it; the later wins. Errors are cut to 1000 characters."""
    both = state.unionByName(rows)
    if error:
        both = both.withColumn(error, F.substring(error, 1, 1000))
    return ranking.latest(both, [key], [order])


def capped_per_key(rows: DataFrame, key: str, order: list[str | Column], n: int) -> DataFrame:
    """The first n rows of each key."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")

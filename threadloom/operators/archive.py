"""Entries of a packed archive: pages, redirects, images, lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entries(pages: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """``pages``: (post_id, title, zim_path, answer_redirects). ``path, kind, title, target``: the page, its short address and one
    address for each answer; images by their hash."""
    item = pages.select(F.col("zim_path").alias("path"), F.lit("item").alias("kind"), "title", F.lit(None).cast("string").alias("target"))
    short = pages.select(F.concat(F.lit("questions/"), F.col("post_id").cast("string")).alias("path"), F.lit("redirect").alias("kind"), "title", F.col("zim_path").alias("target"))
    answers = pages.select(F.explode("answer_redirects").alias("_a"), "title", "zim_path").select(F.concat(F.lit("a/"), F.col("_a").cast("string")).alias("path"), F.lit("redirect").alias("kind"), "title", F.col("zim_path").alias("target"))
    out = item.unionByName(short).unionByName(answers)
    if images is not None:
        out = out.unionByName(images.select(F.concat(F.lit("images/"), F.col("name")).alias("path"), F.lit("image").alias("kind"), F.lit("").alias("title"), F.lit(None).cast("string").alias("target")))
    return out


def newest(pages: DataFrame, n: int) -> DataFrame:
    """The n pages of the largest ids: the list where scores are missing."""
    return pages.orderBy(F.desc("post_id")).limit(n)


def names_or(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first table, or the second where that is empty."""
    empty = first.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    return first.unionByName(second.join(F.broadcast(empty)).drop("_n"))


def fixed_entries(spark, paths: list[str]) -> DataFrame:
    """Entries for images that pages name by fixed paths (sprites); placeholders stand for them."""
    each = spark.range(1).select(F.explode(F.array(*[F.lit(p) for p in paths])).alias("path"))
    return each.select("path", F.lit("image").alias("kind"), F.lit("").alias("title"), F.lit(None).cast("string").alias("target"))


def top_users(users: DataFrame, n: int) -> DataFrame:
    """``users``: (user_id, name, score). The n best, or one row that says that there are none."""
    best = users.orderBy(F.desc("score"), "user_id").limit(n).select("user_id", "name", "score")
    empty = users.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(F.lit(None).cast("bigint").alias("user_id"), F.lit("no users").alias("name"), F.lit(0).cast("bigint").alias("score"))
    return best.select(F.col("user_id").cast("bigint").alias("user_id"), "name", F.col("score").cast("bigint").alias("score")).unionByName(empty)

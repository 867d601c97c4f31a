"""Checks of a backup bundle before it is restored: entries, layout, checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

#: Files that a bundle must hold (fixed values).
REQUIRED = ["MANIFEST.json", "MANIFEST.sha256", "redis/baseline.rdb"]
#: Shards looked into, and entries of each (fixed values).
SHARDS, POSTS = 3, 3


def entries(manifest: DataFrame) -> DataFrame:
    """``manifest``: (json). Rows (entry, problem) of its ``entries``, problem null where there is none; a manifest that can't be read, or
    whose entries are no list, is one row without an entry. A manifest without entries has no rows."""
    v = F.try_parse_json("json")
    named, listed = F.try_variant_get(v, "$.entries", "variant"), F.try_variant_get(v, "$.entries", "array<variant>")
    none = named.isNull() | F.is_variant_null(named)
    whole = F.when(v.isNull(), "unreadable").when(~none & listed.isNull(), "not-a-list")
    d = manifest.select(whole.alias("_whole"), F.explode_outer(listed).alias("_e"))
    text = F.when(F.schema_of_variant("_e") == "STRING", F.try_variant_get("_e", "$", "string"))
    d = d.where("_whole is not null or _e is not null")
    return d.select(text.alias("entry"), F.coalesce("_whole", urls.bundle_entry_problem(text)).alias("problem"))


def layout(files: DataFrame) -> DataFrame:
    """``files``: (path) from the bundle's folder. Rows (check, status, n): required files that are missing, shards of pages, pages among
    the first entries of the first shards, images. One pass over the paths; the sample is ranked in three shards alone."""
    p = F.split("path", "/")
    html = F.startswith("path", F.lit("stage/html/")) & (F.size(p) > 3) & F.get(p, F.lit(2)).rlike("^[0-9a-f]{2}\\z")
    pages = files.where(html).select(F.get(p, F.lit(2)).alias("shard"), F.get(p, F.lit(3)).alias("post"), ((F.size(p) == 5) & (F.get(p, F.lit(4)) == "index.html")).alias("page"))
    first = pages.select("shard").distinct().orderBy("shard").limit(SHARDS)
    some = pages.join(F.broadcast(first), "shard").groupBy("shard", "post").agg(F.max("page").alias("page"))
    some = some.withColumn("_rn", F.row_number().over(Window.partitionBy("shard").orderBy("post"))).where(F.col("_rn") <= POSTS)
    found = some.agg(F.count_if("page").alias("n")).select(F.lit("sample_pages").alias("check"), "n", F.lit(True).alias("_wanted"))
    counts = files.agg(
        *[F.max(F.col("path") == r).alias(f"_r{i}") for i, r in enumerate(REQUIRED)],
        F.count_distinct(F.when(html, F.get(p, F.lit(2)))).alias("shards"), F.count_if(F.startswith("path", F.lit("stage/images/")) & (F.size(p) == 3)).alias("images"),
    )
    missing = sum(F.when(F.coalesce(f"_r{i}", F.lit(False)), 0).otherwise(1) for i in range(len(REQUIRED)))
    rows = F.array(*[F.struct(F.lit(c).alias("check"), n.cast("long").alias("n"), F.lit(w).alias("_wanted")) for c, n, w in (("required_files", missing, False), ("html_shards", F.col("shards"), True), ("images", F.col("images"), True))])
    each = counts.select(F.inline(rows)).unionByName(found)
    return each.select("check", F.when((F.col("n") > 0) == F.col("_wanted"), "PASS").otherwise("FAIL").alias("status"), "n")


def checksums(files: DataFrame, sums: DataFrame) -> DataFrame:
    """``files``: (path, sha256); ``sums``: (line), as ``digest  path``. Rows (path, status) for each line: ok, mismatch, missing, or malformed
    with the line as its path. Blank lines and comments are skipped."""
    form = "^([0-9a-fA-F]{64}) [ *](?:\\./)?(.+)$"
    s = sums.where("trim(line) <> '' and not startswith(line, '#')").withColumn("_ok", F.col("line").rlike(form))
    s = s.select("_ok", F.lower(F.regexp_extract("line", form, 1)).alias("_want"), F.when(F.col("_ok"), F.regexp_extract("line", form, 2)).otherwise(F.col("line")).alias("path"))
    j = s.join(files.select("path", F.lower("sha256").alias("_is")), "path", "left")
    status = F.when(~F.col("_ok"), "malformed").when(F.col("_is").isNull(), "missing").when(F.col("_is") == F.col("_want"), "ok").otherwise("mismatch")
    return j.select("path", status.alias("status"))

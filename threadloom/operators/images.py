"""Verification of a stage's images against a manifest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decoding, dimensions, media
from . import decisions, ranking

#: States of a manifest's rows that say an image was had (fixed values).
RECOVERED = ["ok", "recovered", "upgrade_candidate"]
HASH = "^[0-9a-f]{16,32}$"


def states(manifest: DataFrame, files: DataFrame, size: int, sha256: str | None) -> DataFrame:
    """``manifest``: (hash, status); ``files``: (name, content). ``hash, recovered, placeholder, problem`` for each hash, its first problem or null. ``size`` and
    ``sha256`` are the placeholder's. Files are looked at before the join, so contents aren't shuffled."""
    key = F.lower(F.coalesce("hash", F.lit("")))
    hashes = manifest.select(key.alias("hash"), F.coalesce("status", F.lit("")).isin(RECOVERED).alias("_r")).where("hash <> ''").groupBy("hash").agg(F.bool_or("_r").alias("recovered"))
    c = F.col("content")
    looked = files.select(F.col("name").alias("hash"), F.octet_length(c).alias("_size"), dimensions.is_decodable_image(c).alias("_valid"), media.is_placeholder(c, size, sha256).alias("placeholder"))
    j = hashes.join(looked, "hash", "left")
    there, twin = F.col("_size").isNotNull(), F.coalesce("placeholder", F.lit(False))
    problem = decisions.image_problem(there, F.col("_size"), there, F.coalesce("_valid", F.lit(False)), F.col("recovered"), twin)
    return j.select("hash", "recovered", (twin & (F.col("_size") > 0)).alias("placeholder"), problem.alias("problem"))


def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decoding.deep_problem(c) for c in b.column(1).to_pylist()], pa.string())], ["name", "problem"])


def deep_sample(files: DataFrame, sample: int, seed: int) -> DataFrame:
    """``name, problem`` (empty if none) of so many files drawn by seed, of those whose name is a hash. Only names are sorted."""
    named = files.where(F.col("name").rlike(HASH))
    drawn = ranking.seeded_sample(named.select("name"), "name", sample, seed)
    return named.join(F.broadcast(drawn) if sample <= 100_000 else drawn, "name", "left_semi").select("name", "content").mapInArrow(decoded, "name string, problem string")


def summary(checked: DataFrame, sample: DataFrame) -> DataFrame:
    """One row of counts, and PASS if there is no problem in either."""
    a = checked.agg(F.count(F.lit(1)).alias("hashes_checked"), F.count_if("recovered").alias("recovered_entries"), F.count_if("placeholder").alias("placeholders_remaining"), F.count("problem").alias("problems"))
    b = sample.agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("problem") != "").alias("sample_issues"))
    return a.crossJoin(b).withColumn("result", F.when((F.col("problems") == 0) & (F.col("sample_issues") == 0), "PASS").otherwise("FAIL"))

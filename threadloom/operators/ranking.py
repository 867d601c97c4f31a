"""Operators whose result depends on an order: first wins, latest, top with ties, samples, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key. ``order`` must be total within a key. Only one row of a key leaves each task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn <= 1").drop("_rn")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by aggregation on the map side, so a hot key costs a row for each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_m"))
    return best.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest])


def top_with_ties(counts: DataFrame, n: int, count: str, first: str) -> DataFrame:
    """The n largest, ties in the order of first sight."""
    return counts.orderBy(F.desc(count), first).limit(n)


def even_sample(df: DataFrame, order: list[str], total: int, n: int) -> DataFrame:
    """The rows at places int(i * total / n) of the order; all where there are fewer. Places are found from the counts of
    range partitions, so the order is global without one task that holds it."""
    if n <= 0:
        return df.limit(0)
    placed = positions(df, order)
    if n >= total:
        return placed.drop("_pos")
    i = f"((_pos * {n} + {total - 1}) div {total})"  # the only i that could give this place
    return placed.where(f"{i} < {n} and ({i} * {total}) div {n} = _pos").drop("_pos")


def positions(df: DataFrame, order: list[str]) -> DataFrame:
    """``_pos``, the place from 0 in the order: ranks inside range partitions plus the sizes of the ones before. The sizes
    are a row for each partition. Ranks are written before sizes are counted: a second run may draw other bounds."""
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    inside = written(parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "ranked")
    sizes = inside.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return inside.join(F.broadcast(before), "_part").withColumn("_pos", F.col("_in") - 1 + F.col("_before")).drop("_part", "_in", "_before")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in the order of a hash of the key and a seed."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def paged(df: DataFrame, order: list[str | Column], per_page: int, keys: list[str] | None = None) -> DataFrame:
    """Adds ``rank`` and ``page`` from 1, over all rows or within each key."""
    if keys:
        ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    else:
        ranked = positions(df, order).withColumn("rank", (F.col("_pos") + 1).cast("long")).drop("_pos")
    return ranked.withColumn("page", F.ceil(F.col("rank") / per_page).cast("long"))


def page_count(n: Column, per_page: int, cap: int) -> Column:
    """Pages of a list: whole ones, at most ``cap``."""
    return F.least(F.floor(n / F.greatest(F.lit(1), F.lit(per_page))), F.lit(cap)).cast("long")

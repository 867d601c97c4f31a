"""Runs of workers that fetch items: what is open, where a quota ends a run, what a run adds to the state, its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import manifests, ranking

QUOTA = "quota_exhausted"


def pending(items: DataFrame, state: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """``items``: (hash, ...). Those whose hash the state doesn't call ok; with ``limit`` the first ones in their order."""
    rows = manifests.done_filter(items, state.where("status = 'ok'"), "hash")
    return rows.orderBy(order).limit(limit) if limit else rows


def until_quota(outcomes: DataFrame, worker: str, order: str) -> DataFrame:
    """``outcomes``: (status, ...). Of each worker's rows those up to its first exhausted quota, which is among them: what stands behind hasn't
    been tried and stays open for the next run. One row of a worker leaves each task."""
    stop = outcomes.where(F.col("status") == QUOTA).groupBy(worker).agg(F.min(order).alias("_stop"))
    return outcomes.join(stop, worker, "left").where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))).drop("_stop")


def after(state: DataFrame, outcomes: DataFrame, order: str) -> DataFrame:
    """The state with a run's outcomes written over it; of several outcomes of a hash the last counts. Errors are cut to 1000 characters."""
    both = state.withColumn("_run", F.lit(0)).unionByName(outcomes.select(state.columns).withColumn("_run", F.lit(1)))
    if "error" in state.columns:
        both = both.withColumn("error", F.substring("error", 1, 1000))
    return ranking.latest(both, ["hash"], ["_run", order]).select(state.columns)


def counters(outcomes: DataFrame, *by: str) -> DataFrame:
    """``outcomes``: (status, bytes_in, bytes_out). Counts of a run, or of each worker. Bytes are those of what was taken."""
    ok, status = F.col("status") == "ok", F.col("status")
    taken = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast("long").alias(c)
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(ok).alias("ok"), F.count_if(status == "rejected").alias("rejected"), F.count_if(status == QUOTA).alias("quota"),
        F.count_if(~ok & ~status.isin("rejected", QUOTA)).alias("fail"), taken("bytes_in"), taken("bytes_out"),
    )

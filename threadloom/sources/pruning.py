"""Pruning of page folders by tasks: a plan's rows go in its order, and the first failure keeps all after it.

Tasks can't know what happens elsewhere, so nothing is deleted at first. All rows are checked; those before the first problem are moved to a
trash folder beside the root, each by one rename; the first that couldn't be moved ends the plan, and what stands behind it is moved back. Only then
is the trash deleted. The outcome is that of going through the plan one by one.

The journal is a folder of tables: the plan with places, checks, moves, returns and results, each written before the next step begins. A run that
died goes on from the last that is finished, and a move that was made is recognised when it is tried again.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking

OUT = "_pos bigint, post_id string, path string, error string"
LATE = "an earlier removal failed"


class Place:
    """The stage's store: a mounted folder or any address that pyarrow's stores know."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
        self.root = self.root.rstrip("/")
        self.local = isinstance(self.fs, fs.LocalFileSystem)
        self.missing = fs.FileType.NotFound

    def there(self, path: str) -> bool:
        return self.fs.get_file_info(path).type != self.missing

    def problem(self, path: str | None) -> str:
        """Why a path below the root may not go; empty if it may."""
        if not path or path.startswith("/") or ".." in path.split("/"):
            return "not inside the stage"
        target = f"{self.root}/{path}"
        if self.local and (os.path.islink(target) or os.path.realpath(target) != os.path.realpath(self.root) + "/" + path):
            return "not inside the stage"
        return "" if self.there(target) else "nothing there"

    def move(self, source: str, target: str) -> str:
        """Moves a folder; no problem if that was done before."""
        if not self.there(source) and self.there(target):
            return ""
        try:
            self.fs.create_dir(os.path.dirname(target), recursive=True)
            self.fs.move(source, target)
            return ""
        except OSError as e:
            return str(e) or type(e).__name__


def prune(plan: DataFrame, root: str, journal: str, move: Callable[[Place, str, str], str] = Place.move) -> DataFrame:
    """``plan``: (post_id, path, problem), paths below ``root``. Returns ``post_id, path, status, error``: removed, failed (one at most) or kept. ``move`` takes the
    place of a rename in tests."""
    spark, trash = plan.sparkSession, f"{root.rstrip('/')}.trash"

    def table(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{journal}/{name}"
        if not _finished(spark, path):
            make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def by_rows(rows: DataFrame, act: Callable[[Place, int, str, str | None], str]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            place = Place(root)
            for b in batches:
                errors = [act(place, p, path, problem) for p, path, problem in zip(b["_pos"], b["path"], b["problem"])]
                yield pd.DataFrame({"_pos": b["_pos"], "post_id": b["post_id"], "path": b["path"], "error": errors})

        return rows.select("_pos", "post_id", "path", "problem").mapInPandas(run, OUT)

    def first_bad(rows: DataFrame) -> int | None:
        return rows.where("error <> ''").agg(F.min("_pos")).first()[0]

    there = lambda place, path: f"{place.root}/{path}"
    away = lambda place, p: f"{place.root}.trash/{p // 1000}/{p}"
    planned = table("plan", lambda: ranking.positions(plan.select(F.col("post_id").cast("string").alias("post_id"), "path", "problem"), ["path", "post_id"]))
    checked = table("checked", lambda: by_rows(planned, lambda place, p, path, problem: problem or ("" if place.there(away(place, p)) else place.problem(path))))
    stop = first_bad(checked)
    going = planned if stop is None else planned.where(F.col("_pos") < stop)
    moved = table("moved", lambda: by_rows(going, lambda place, p, path, _: move(place, there(place, path), away(place, p))))
    late = first_bad(moved)
    stop = late if late is not None else stop
    if stop is not None:
        back = planned.join(moved.where((F.col("error") == "") & (F.col("_pos") > stop)).select("_pos"), "_pos", "left_semi")
        returned = table("returned", lambda: by_rows(back, lambda place, p, path, _: place.move(away(place, p), there(place, path))))
        if not returned.where("error <> ''").isEmpty():
            raise OSError(f"{journal}: what was moved to {trash} couldn't all be moved back; see the table of returns")
    reason = checked.select("_pos", F.col("error").alias("_check")).join(moved.select("_pos", F.col("error").alias("_move")), "_pos", "left")
    end = F.lit(stop).cast("bigint")
    status = F.when(end.isNull() | (F.col("_pos") < end), "removed").when(F.col("_pos") == end, "failed").otherwise("kept")
    error = F.when(status == "failed", F.coalesce(F.nullif("_move", F.lit("")), "_check")).when(status == "kept", LATE).otherwise("")
    results = table("results", lambda: planned.join(reason, "_pos").select("_pos", "post_id", "path", status.alias("status"), error.alias("error"), F.lit(None).cast("string").alias("problem")))

    def drop(place: Place, p: int, path: str, _: str | None) -> str:
        if place.there(away(place, p)):
            place.fs.delete_dir(away(place, p))
        return ""

    by_rows(results.where("status = 'removed'"), drop).write.format("noop").mode("overwrite").save()
    place = Place(root)
    if place.there(f"{place.root}.trash"):
        place.fs.delete_dir(f"{place.root}.trash")
    return results.select("post_id", "path", "status", "error")


def _finished(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

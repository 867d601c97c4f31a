"""Rows that a stream has written, by batch: a sink that a restarted run cannot write to twice.

Every micro-batch has a folder of its own under its id. A batch that runs again, because the run ended before its offsets were committed,
writes the same folder anew and sees only what earlier batches wrote. A folder counts once its writer has finished it (``_SUCCESS``), so a
run that dies in the middle of one leaves nothing behind. ``compact`` folds all finished batches up to one into a single folder, which counts
in their place as soon as it is finished; they are deleted after that.

All of it goes through Spark's readers and Hadoop's file interface, in any store.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BATCH, FOLDED = "batch-{:012d}", "upto-{:012d}"
FOLDER = re.compile(r"(batch|upto)-(\d{12})")


class Ledger:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._upto, self._total = -1, None

    def _store(self, name: str = ""):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def folders(self) -> tuple[int, list[int]]:
        """The last batch that is folded, or -1, and finished batches after it."""
        store, root = self._store()
        if not store.exists(root):
            return -1, []
        names = [s.getPath().getName() for s in store.listStatus(root)]
        found = [(m[1], int(m[2])) for n in names if (m := FOLDER.fullmatch(n)) and store.exists(self._store(f"{n}/_SUCCESS")[1])]
        folded = max((k for kind, k in found if kind == "upto"), default=-1)
        return folded, sorted(k for kind, k in found if kind == "batch" and k > folded)

    def put(self, batch: int, rows: DataFrame) -> None:
        """Writes a batch's rows, whatever an earlier attempt has left. Batches that are folded are done and stay as they are."""
        store, folds = self._store("upto-*")
        folded = [s.getPath().getName() for s in store.globStatus(folds) or []]
        if batch > max((int(FOLDER.fullmatch(n)[2]) for n in folded if store.exists(self._store(f"{n}/_SUCCESS")[1])), default=-1):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{BATCH.format(batch)}")

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, or those of batches before one."""
        folded, batches = self.folders()
        if before is not None and folded >= before:
            raise ValueError(f"batch {before} is folded already")
        names = ([FOLDED.format(folded)] if folded >= 0 else []) + [BATCH.format(k) for k in batches if before is None or k < before]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*[f"{self.path}/{n}" for n in names]) if names else self.spark.createDataFrame([], self.schema)

    def total(self, aggs: list, add: Callable[[tuple, tuple], tuple], none: tuple) -> tuple:
        """Aggregates of all rows, ``add`` being how those of two parts add up. Finished batches that others follow don't change while a
        run goes on: this object reads each of them once."""
        read = lambda names: tuple(self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names]).agg(*aggs).first()) if names else none
        done = lambda k: self._store()[0].exists(self._store(f"{BATCH.format(k)}/_SUCCESS")[1])
        if self._total is not None and done(self._upto + 1):
            new = [self._upto + 1]
            while done(new[-1] + 1):
                new.append(new[-1] + 1)
        else:  # at first, and where batches were folded
            folded, new = self.folders()
            self._upto, self._total = folded, read([FOLDED.format(folded)] * (folded >= 0))
        if len(new) > 1:
            self._upto, self._total = new[-2], add(self._total, read([BATCH.format(k) for k in new[:-1]]))
        return add(self._total, read([BATCH.format(k) for k in new[-1:]]))

    def compact(self, fold: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Folds all finished batches but the last (the run that wrote it may not have committed it) into one folder, by ``fold``, which must give the same
        for its own results and later rows as for all rows."""
        folded, batches = self.folders()
        if len(batches) < 2:
            return
        upto = batches[-2]
        fold(self.rows(before=batches[-1])).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{FOLDED.format(upto)}")
        for name in [FOLDED.format(folded)] * (folded >= 0) + [BATCH.format(k) for k in batches if k <= upto]:
            store, p = self._store(name)
            store.delete(p, True)


def first_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """A key's first row. Folding may be repeated."""
    from ..operators import ranking

    return ranking.first_wins(rows, [key], order)

"""The dump scan as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import recovery
from ..sources.scratch import folder
from .ledger import Ledger, first_of


def matches(names: DataFrame, prefixes: list[str]) -> DataFrame:
    """``names``: (name), a stream or a table. Each name once, all its forms, and those whose key begins with one of ``prefixes``."""
    forms = names.dropDuplicates(["name"]).select("name", F.explode(urls.posts_candidates(F.col("name"))).alias("url")).withColumn("hash", urls.image_key(F.col("url")))
    return forms.where(F.substring("hash", 1, 1).isin(prefixes))


def wanted(names: DataFrame, keys: DataFrame) -> DataFrame:
    """As ``matches``, against a table of wanted keys (hash)."""
    forms = names.dropDuplicates(["name"]).select("name", F.explode(urls.posts_candidates(F.col("name"))).alias("url")).withColumn("hash", urls.image_key(F.col("url")))
    return forms.join(keys, "hash", "left_semi")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of dump lines, to names."""
    raw = spark.readStream.text(path)
    return raw.select(F.explode(urls.dump_names(F.col("value"))).alias("name"))


def run(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Runs a stream till all that is there has been read; restarting goes on where it stopped."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


HITS = "hash string, name string, _first struct<_at: struct<line_no: bigint, _pos: int>, _form: int>"


def scan_open(lines: DataFrame, wanted: DataFrame, out: str, checkpoint: str, in_order: bool = True, stop: Callable[[], bool] | None = None, after: Callable[[int], None] | None = None) -> None:
    """Scans a stream of ``line_no, line`` for the keys in ``wanted`` (hash), a table, into the ledger at ``out``; see ``found``.

    Where files come in the order of their lines, a key that is found leaves the open set, and later batches don't look for it. Otherwise all
    stay open and the first place counts when rows are read. A batch that runs again gives what it gave before. ``stop`` is asked between
    micro-batches; a stopped or failed run goes on where it was. ``after`` is told of each batch that is written.
    """
    spark = lines.sparkSession
    ledger = Ledger(spark, out, HITS)

    def batch(rows: DataFrame, number: int) -> None:
        still = wanted.select("hash").distinct()
        if in_order:
            still = still.join(ledger.rows(before=number).select("hash"), "hash", "left_anti")
        ledger.put(number, recovery.first_hits(recovery.first_seen(rows), still).select("hash", "name", "_first"))
        if after:
            after(number)

    wait(lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), stop)


def found(spark: SparkSession, out: str) -> DataFrame:
    """``hash, source_url`` of all that a scan has found so far: as ``recovery.match_posts`` over all lines read."""
    first = first_of(Ledger(spark, out, HITS).rows(), "hash", ["_first", "name"])
    return first.select("hash", F.concat(F.lit(f"https://{urls.PRIMARY_HOST}/"), F.col("name")).alias("source_url"))


def wait(query, stop: Callable[[], bool] | None = None, every: float = 0.2) -> None:
    """Till a stream has ended, or ``stop`` says so. The batch in hand is given up; it runs again when the stream is started again."""
    while not query.awaitTermination(every):
        if stop is not None and stop():
            query.stop()
            return


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of numbered lines, from tables of ``line_no, line``, oldest files first."""
    reader = spark.readStream.schema("line_no bigint, line string")
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def names_to_matches(spark: SparkSession, names: DataFrame, prefixes: list[str]) -> DataFrame:
    """Writes names as text lines, streams them through the scan and returns what it wrote."""
    src, out, check = folder(spark, "names"), folder(spark, "matches"), folder(spark, "stream")
    names.select(F.concat(F.lit(f"<row Body=\"https://{urls.PRIMARY_HOST}/"), "name", F.lit("\" />")).alias("value")).write.text(src)
    run(matches(lines(spark, src), prefixes), out, check)
    return spark.read.schema("name string, url string, hash string").parquet(out)

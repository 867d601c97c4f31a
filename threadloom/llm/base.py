"""What the corpus operators share: tables, scratch space, word rules."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators between words: the six ASCII white-space characters.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Everything of ASCII but digits and small letters; what is left are words.
NON_WORD_RUN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. A text of ASCII alone takes the fast built-in; ``lower`` would also change other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where that is unset and the master is
    local, as in tests. On a cluster an unset folder is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        root = f"file://{tempfile.gettempdir()}/threadloom-{os.getpid()}"
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage ends there, and a lost executor costs nothing
    that has been written. Parquet keeps these tables far smaller than ``checkpoint()`` would."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/threadloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch. Texts can be long: with Spark's 10,000 a batch alone may take a worker's memory.
BATCH_ROWS = 1000


def importable(spark: SparkSession) -> None:
    """Makes this package importable for Python workers that have neither its folder as their own nor on PYTHONPATH, and sets
    the session's Arrow batches to BATCH_ROWS rows at most."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    root = pathlib.Path(__file__).resolve().parents[2]
    known = [pathlib.Path(p or ".").resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    sc = spark.sparkContext
    if root in known or (sc.master.startswith("local[") and root == pathlib.Path.cwd()) or getattr(sc, "_threadloom_sent", False):
        return
    with tempfile.TemporaryDirectory() as d:
        base = pathlib.Path(d, "src")
        shutil.copytree(root / "threadloom", base / "threadloom", ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(str(pathlib.Path(d, "threadloom")), "zip", base))
    sc._threadloom_sent = True


#: Bits of a sieve's words: at most 2 ** WORD_BITS rows of two longs, 64 keys' bits in each.
WORD_BITS = 20


def _word(key: str) -> str:
    """Keys are hashed again: least hashes, for one, share their upper bits."""
    return f"shiftrightunsigned(xxhash64({key}), {64 - WORD_BITS})"


def _bit(key: str) -> str:
    return f"shiftleft(1L, cast(xxhash64({key}) & 63 as int))"


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes in the long column ``key``, as rows (_word, _bits): at most 2 ** WORD_BITS, some 16 MB, whatever the size
    of ``keys``."""
    word, bit = F.expr(_word(key)), F.expr(_bit(key))
    return keys.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def narrowed(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` (a hash, as in ``keys``) may be among ``keys``: all that are, and a share of the others that
    is small as long as there are fewer keys than bits. Spares the shuffle of a join, which has to follow, most rows."""
    bits = F.broadcast(sieve(keys, key))
    df = df.withColumn("_word", F.expr(_word(key))).join(bits, "_word")
    return df.where(F.expr(f"(_bits & {_bit(key)}) <> 0")).drop("_word", "_bits")


def split_by(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` as ``narrowed`` would keep them, and all others, which need no join with ``keys``."""
    bits = F.broadcast(sieve(keys, key))
    df = df.withColumn("_word", F.expr(_word(key))).join(bits, "_word", "left")
    maybe = F.expr(f"coalesce(_bits & {_bit(key)}, 0L) <> 0")
    return df.where(maybe).drop("_word", "_bits"), df.where(~maybe).drop("_word", "_bits")


def guarded(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a written table of narrow rows, to be broadcast if it has at most ``rows`` rows; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

"""Writers. Files that people read go out as one file by a rename; tables go out as versions with a pointer."""

from __future__ import annotations

import json
import os
import struct
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records
from ..operators import manifests


def write_atomic(path: str, data: bytes) -> None:
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        os.unlink(temp)
        raise


def tsv_lines(df: DataFrame, columns: list[str], escape: bool = True) -> DataFrame:
    cols = [records.tsv_escape(F.col(c)) if escape else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws("\t", *cols).alias("value"))


def write_tsv(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None, escape: bool = True) -> None:
    """Text files of a folder, in order across files, each with a header."""
    rows = df.orderBy(*order) if order else df
    out = rows.select(*[(records.tsv_escape(F.col(c)) if escape else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns])
    out.write.mode("overwrite").option("sep", "\t").option("header", "true").option("quote", "\u0000").option("escape", "\u0000").option("emptyValue", "").csv(path)


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object a row, keys in order, nulls kept."""
    return df.select(records.canonical_json(F.struct(*sorted(df.columns))).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    """A small report (a row for each check) as one JSON file."""
    write_atomic(path, json.dumps([r.asDict(recursive=True) for r in df.collect()], indent=1, sort_keys=True, default=str).encode())


def append_results(df: DataFrame, root: str) -> None:
    """Results of a run so far, as JSON lines appended to a folder."""
    json_lines(df).write.mode("append").text(f"{root}/results")


def compact_results(spark: SparkSession, state: DataFrame, root: str, key: str = "hash") -> DataFrame:
    """The authoritative results, in the order of their key, from the state; published as a version over what was appended."""
    return publish(state.orderBy(key), f"{root}/final")


def summary_text(df: DataFrame, key: str, n: int = 30) -> str:
    """Lines ``count  value`` of a column's most frequent values, ties in their order; n of them reach the driver."""
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(n).collect()
    return "\n".join(f"{r['n']:>10}  {r[key]}" for r in rows)


def report_text(df: DataFrame) -> tuple[str, int]:
    """Lines for people and an exit code."""
    rows = df.collect()
    text = "\n".join(f"{r['status']:5} {r['check']}: {r['n']}" for r in rows)
    return text, int(any(r["status"] == "FAIL" for r in rows))


def append_manifest(spark: SparkSession, root: str, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds rows whose key isn't there yet, as a new version; readers follow the pointer, so a failed run leaves the old one."""
    old = current(spark, root)
    rows = manifests.append(old, new, keys, order) if old is not None else manifests.append(new.where("false"), new, keys, order)
    return publish(rows, root)


def _store(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put_small(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in any store that Spark writes to, by a rename."""
    jvm, p, store = _store(spark, path)
    temp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = store.create(temp, True)
    out.write(bytearray(data))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(temp, p, over)


def get_small(spark: SparkSession, path: str) -> bytes | None:
    """The contents of a small file, or none if there is no such file."""
    _, p, store = _store(spark, path)
    if not store.exists(p):
        return None
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def publish(df: DataFrame, root: str) -> DataFrame:
    """A new version of a table and the pointer to it, in any store that Spark writes to."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{version}")
    put_small(df.sparkSession, f"{root}/CURRENT", version.encode())
    return df.sparkSession.read.parquet(f"{root}/{version}")


def current(spark: SparkSession, root: str) -> DataFrame | None:
    version = get_small(spark, f"{root}/CURRENT")
    return None if version is None else spark.read.parquet(f"{root}/{version.decode()}")


def write_files(df: DataFrame, root: str) -> DataFrame:
    """``name, content`` to files below a shared folder, each by a rename. Returns what was written: ``name, bytes``."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["name"], b["content"]):
                write_atomic(os.path.join(root, name), bytes(content))
            yield pd.DataFrame({"name": b["name"], "bytes": [len(c) for c in b["content"]]})

    return df.select("name", "content").mapInPandas(put, "name string, bytes bigint")


def write_pages(df: DataFrame, root: str) -> DataFrame:
    """``post_id, html, manifest`` (JSON text) to page folders: the page first, then its manifest, so a manifest always has its page."""
    d = df.withColumn("_dir", F.concat(records.shard_of(F.col("post_id")), F.lit("/"), F.col("post_id").cast("string")))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for folder, page, manifest in zip(b["_dir"], b["html"], b["manifest"]):
                write_atomic(os.path.join(root, folder, "page.html"), page.encode())
                write_atomic(os.path.join(root, folder, "manifest.json"), manifest.encode())
            yield pd.DataFrame({"path": b["_dir"]})

    return d.select("_dir", "html", "manifest").mapInPandas(put, "path string")


def prune(plan: DataFrame, root: str, journal: str, remove) -> dict[str, int]:
    """Applies a plan (post_id, path, problem): it is written as a table (``journal``.plan) before anything goes; each result is a line
    appended to ``journal``.results.jsonl, and the first failure stops the rest. Rows stream through the driver one by one. Returns
    how many were removed, failed and kept."""
    plan.write.mode("overwrite").json(f"{journal}.plan")
    counts, stopped = {"removed": 0, "failed": 0, "kept": 0}, False
    with open(f"{journal}.results.jsonl", "w") as out:
        for r in plan.toLocalIterator():
            error = "an earlier removal failed"
            status = "kept" if stopped else "removed"
            if not stopped:
                try:
                    target, error = os.path.join(root, r["path"]), ""
                    if r["problem"] is not None:
                        raise ValueError(r["problem"])
                    if os.path.islink(target) or os.path.realpath(target) != os.path.abspath(target) or not os.path.realpath(target).startswith(os.path.realpath(root) + os.sep):
                        raise ValueError("not inside the stage")
                    remove(target)
                except (OSError, ValueError) as e:
                    status, error, stopped = "failed", str(e), True
            counts[status] += 1
            out.write(json.dumps({"post_id": r["post_id"], "status": status, "error": error}) + "\n")
            out.flush()
            os.fsync(out.fileno())
    return counts


def placeholder_png(width: int = 320, height: int = 120, gray: int = 200) -> bytes:
    """A plain gray image with the same bytes every time."""

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    rows = (b"\0" + bytes([gray]) * width) * height
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 9)) + chunk(b"IEND", b"")


def run_manifest(path: str, output: str, arguments: dict, gates: dict) -> None:
    """Size and digest of an output, with the arguments and gates that led to it."""
    import hashlib

    digest = hashlib.sha256()
    with open(output, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    write_atomic(path, json.dumps({"output": output, "bytes": os.path.getsize(output), "sha256": digest.hexdigest(), "arguments": arguments, "gates": gates}, sort_keys=True).encode())

"""Readers. All carry the order of their rows (``src``, ``line_no`` from 1) where later steps take what comes first."""

from __future__ import annotations

import json
import os
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import pages as text
from . import schemas


def pages(spark: SparkSession, root: str) -> DataFrame:
    """``page_path, html`` of all ``*.html`` below a folder. Bytes that are no UTF-8 are dropped."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").load(root)
    return raw.select(F.col("path").alias("page_path"), text.decoded(F.col("content")).alias("html"))


def files(spark: SparkSession, root: str, content: bool = True, pattern: str = "*") -> DataFrame:
    """``name, path, size, content`` of files below a folder; without ``content`` only their listing is read."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    cols = [F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path"), F.col("length").alias("size")]
    return raw.select(*cols, *(["content"] if content else []))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``src, line_no, line`` of files of any size, read in splits. Numbers start at 1 and grow along each file, with gaps between
    splits: a line's number is its place in its split plus the byte at which that begins. The first line of each split is
    found by a pass over the files that keeps a row for each."""
    raw = spark.read.text(path).select(F.input_file_name().alias("src"), F.input_file_block_start().alias("_b"), F.monotonically_increasing_id().alias("_i"), F.col("value").alias("line"))
    first = raw.groupBy("src", "_b").agg(F.min("_i").alias("_first"))
    return raw.join(first, ["src", "_b"]).select("src", (F.col("_b") + F.col("_i") - F.col("_first") + 1).alias("line_no"), "line")


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return first[0][0].rstrip("\r").split("\t") if first else []


def tsv(spark: SparkSession, path: str, core: list[str] | None = None, short: str = "skip", long: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Rows of a headered TSV file, all columns text, and those set aside. Further and reordered columns are read; a missing
    core column is an error. ``short`` rows are skipped or padded, ``long`` ones skipped or cut. Nothing is unescaped."""
    names = _header(spark, path)
    if lost := [c for c in core or [] if c not in names]:
        raise ValueError(f"{path}: the header lacks {', '.join(lost)}")
    rows = lines(spark, path).where("line_no > 1 and line <> ''").withColumn("_p", F.split("line", "\t"))
    n = F.size("_p")
    ok = ((n >= len(names)) | F.lit(short == "pad")) & ((n <= len(names)) | F.lit(long == "cut"))
    good = rows.where(ok).select("src", "line_no", *[F.coalesce(F.get("_p", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names)])
    return good, rows.where(~ok).select("src", "line_no", "line")


def manifest_tsv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A recovery manifest: strict about width."""
    return tsv(spark, path, schemas.MANIFEST_FIELDS)


def manifest_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A recovery manifest of JSON lines; lines that hold no object are set aside."""
    schema = StructType(schemas.MANIFEST.fields).add("_corrupt_record", "string")
    raw = lines(spark, path).where("trim(line) <> ''")
    parsed = raw.withColumn("_j", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    ok = F.col("_j").isNotNull() & F.col("_j._corrupt_record").isNull() & F.ltrim("line").startswith("{")
    return parsed.where(ok).select("src", "line_no", *[F.coalesce(F.col(f"_j.{c}"), F.lit("")).alias(c) for c in schemas.MANIFEST_FIELDS]), parsed.where(~F.coalesce(ok, F.lit(False))).select("src", "line_no", "line")


def classified(spark: SparkSession, path: str) -> DataFrame:
    """Classified or inventory rows: short ones skipped, long ones cut, hashes in small letters, rows without one dropped."""
    good, _ = tsv(spark, path, ["hash"], long="cut")
    return good.withColumn("hash", F.lower("hash")).where("hash <> ''")


def small_list(spark: SparkSession, path: str) -> DataFrame:
    """A manifest or any headered list with ``hash`` and ``source_url``; short rows are padded."""
    good, _ = tsv(spark, path, ["hash"], short="pad", long="cut")
    return good.where("hash <> '' and source_url <> ''")


def pending(spark: SparkSession, path: str) -> DataFrame:
    """``hash, source_url``: the last address of each hash. A list without a header is one hash a line."""
    if "hash" in _header(spark, path):
        good, _ = tsv(spark, path, ["hash"], short="pad", long="cut")
        url = F.col("source_url") if "source_url" in good.columns else F.lit("")
        rows = good.select(F.lower(F.trim("hash")).alias("hash"), url.alias("source_url"), "line_no")
    else:
        rows = lines(spark, path).select(F.lower(F.trim(F.substring_index("line", "\t", 1))).alias("hash"), F.lit("").alias("source_url"), "line_no")
    return rows.where("hash <> ''").groupBy("hash").agg(F.max_by("source_url", "line_no").alias("source_url"))


def hash_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "^\\s+|\\s+$", "").alias("hash")).where("hash <> ''").distinct()


def recovered_list(spark: SparkSession, path: str) -> DataFrame:
    """Hashes by a column of that name, else by the first column."""
    if "hash" in _header(spark, path):
        return tsv(spark, path, ["hash"], long="cut")[0].select("hash").where("hash <> ''").distinct()
    return spark.read.text(path).select(F.trim(F.substring_index("value", "\t", 1)).alias("hash")).where("hash <> ''").distinct()


def worker_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``hash, url, basename`` of well-formed lines; blank lines and comments are skipped."""
    p = F.split("line", "\t")
    rows = lines(spark, path).where("trim(line) <> '' and not startswith(line, '#')").select("line_no", F.trim(F.get(p, F.lit(0))).alias("hash"), F.trim(F.get(p, F.lit(1))).alias("url"))
    return rows.where(F.col("hash").rlike("^[0-9a-f]{16,32}\\z") & F.col("url").startswith("http")).withColumn("basename", F.substring_index(F.substring_index("url", "?", 1), "/", -1))


def posts_xml(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of a dump of ``<row .../>`` elements, attributes as columns, all text."""
    reader = spark.read.format("xml").option("rowTag", "row").option("attributePrefix", "").option("inferSchema", "false")
    return (reader.schema(schema) if schema else reader).load(path)


def json_object(spark: SparkSession, path: str, part: str | None = None) -> DataFrame:
    """One row of a JSON file, or of its object ``part`` where it has one."""
    d = spark.read.option("multiLine", "true").json(path)
    return d.select(f"{part}.*") if part and part in d.columns else d


def zip_members(spark: SparkSession, pattern: str, wanted: DataFrame | None = None) -> DataFrame:
    """``shard, basename, pos, content, error`` of the members of ZIP shards of any size, or of those in ``wanted`` (shard, basename).

    Directories are listed first; then members are dealt to tasks, which read their byte ranges alone. A shard that is
    no ZIP file gives one row with an error and without a basename.
    """
    paths = spark.read.format("binaryFile").load(pattern).select("path")

    def opened(path: str) -> zipfile.ZipFile:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
        return zipfile.ZipFile(store.open_input_file(name))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                shard = path.rsplit("/", 1)[-1]
                try:
                    with opened(path) as z:
                        rows = [(path, shard, m.filename.rsplit("/", 1)[-1], k, m.filename, None) for k, m in enumerate(z.infolist()) if not m.is_dir()]
                except (zipfile.BadZipFile, ValueError) as e:
                    rows = [(path, shard, None, -1, None, str(e))]
                yield pd.DataFrame(rows, columns=["path", "shard", "basename", "pos", "member", "error"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, z = None, None
        for b in batches:
            for r in b.itertuples(index=False):
                content, error = None, r.error
                if error is None:
                    try:
                        if held != r.path:
                            held, z = r.path, opened(r.path)
                        content = z.open(z.infolist()[r.pos]).read()
                    except (zipfile.BadZipFile, NotImplementedError, RuntimeError, zlib.error) as e:
                        error = str(e)
                yield pd.DataFrame({"shard": [r.shard], "basename": [r.basename], "pos": [r.pos], "content": [content], "error": [error]})

    rows = paths.repartition("path").mapInPandas(listed, "path string, shard string, basename string, pos bigint, member string, error string")
    if wanted is not None:
        keys = wanted.select("shard", "basename").distinct()
        rows = rows.where("error is not null").unionByName(rows.join(keys, ["shard", "basename"], "left_semi").select(rows.columns))
    dealt = rows.repartition("path", F.floor(F.col("pos") / 256)).sortWithinPartitions("path", "pos")
    return dealt.mapInPandas(read, "shard string, basename string, pos bigint, content binary, error string")


def archive_header(path: str) -> dict | None:
    """The fixed head of a packed archive (80 bytes, little-endian); null if the file is too short."""
    with open(path, "rb") as f:
        head = f.read(80)
    if len(head) < 80:
        return None
    magic, major, minor = struct.unpack_from("<IHH", head, 0)
    entries, clusters = struct.unpack_from("<II", head, 24)
    return {"magic": magic, "major": major, "minor": minor, "uuid": head[8:24].hex(), "entry_count": entries, "cluster_count": clusters}


class Folders(DataSource):
    """Folders at a depth below a root, empty ones included, links not followed: ``spark.read.format("folders").option("depth", 2).load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "folders"

    def schema(self) -> str:
        return "path string, name string, has_manifest boolean"

    def reader(self, schema):
        return FolderReader(self.options.get("path", "."), int(self.options.get("depth", "2")))


class FolderReader(DataSourceReader):
    def __init__(self, root: str, depth: int):
        self.root, self.depth = root.removeprefix("file://"), depth

    def partitions(self):
        tops = [e.path for e in os.scandir(self.root) if e.is_dir(follow_symlinks=False)] if self.depth > 1 else [self.root]
        return [InputPartition(p) for p in sorted(tops)]

    def read(self, partition):
        level = [partition.value]
        for _ in range(self.depth - (2 if self.depth > 1 else 1) + 1):
            level = [e.path for p in level for e in sorted(os.scandir(p), key=lambda e: e.name) if e.is_dir(follow_symlinks=False)]
        for p in level:
            yield p, os.path.basename(p), os.path.isfile(os.path.join(p, "manifest.json"))


def folders(spark: SparkSession, root: str, depth: int = 2) -> DataFrame:
    spark.dataSource.register(Folders)
    return spark.read.format("folders").option("depth", str(depth)).load(root)


def stage_manifests(spark: SparkSession, root: str) -> DataFrame:
    """``path, post_id, schema_version ...`` of all manifest.json files below a folder; unreadable ones have a null schema_version."""
    raw = files(spark, root, pattern="manifest.json")
    return raw.withColumn("_j", F.from_json(text.decoded(F.col("content")), schemas.STAGE_PAGE)).select("path", "_j.*")


def config(path: str | None, env: dict, prefix: str, defaults: dict, **overrides) -> dict:
    """Defaults, then a JSON file, then the environment, then arguments. Unknown keys are errors."""
    out = dict(defaults)
    given = {}
    if path:
        with open(path) as f:
            given |= json.load(f)
    given |= {k[len(prefix) :].lower(): v for k, v in env.items() if k.startswith(prefix)}
    given |= {k: v for k, v in overrides.items() if v is not None}
    if unknown := sorted(set(given) - set(defaults)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    for k, v in given.items():
        kind = type(defaults[k])
        if kind is bool and isinstance(v, str):
            if v.strip().lower() not in ("1", "true", "yes", "on", "0", "false", "no", "off"):
                raise ValueError(f"{k}: not a boolean: {v}")
            v = v.strip().lower() in ("1", "true", "yes", "on")
        out[k] = kind(v)
    return out

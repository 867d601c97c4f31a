"""Token ids in ORC files.

A corpus of ids is a folder with two ORC tables. ``data`` has a row for each document, in ascending order of document ids across and
within files: ``doc_id``, ``part`` (the task that wrote it), ``at`` (ids of the part before it), ``n_tokens`` and ``ids``, an array of
32-bit integers that ORC run-length encodes. ``parts`` has a row for each part with ``base``, the ids of all parts before it, so a
document starts at base + at. Stripes are what tasks read in parallel; row indexes (least and greatest value of each column in runs of
ROW_INDEX rows) and Bloom filters on ``doc_id`` let readers skip stripes and runs by metadata alone.

Documents are dealt to tasks by ranges of their ids and sorted there, then encoded where they are to be written. A text's ids
are those of its chunks between ASCII white space one after the other (as in ``token_counts``), so each worker encodes a chunk once and keeps
it in a bounded cache; plain chunks' words are encoded by ranks (``word_ranks``), which takes a third of the library's time.

Defined results: a null text is empty and has the end id alone; rows of one document id stand together, ordered by a hash of
their texts; null ids come first; repeated rows are written each; texts of any length are encoded in whole, as one row; an empty table
gives files without rows, and none when read; other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import guarded, importable, shared_dir, table
from .token_counts import CACHE_SIZE, LONGEST, tokenizer, tokenizer_path
from .word_ranks import PLAIN, WordRanks, pack

END_ID = 2
#: Rows of a run of the row index (1,000 is the least that ORC takes), bytes of a stripe, Bloom filters' false positives.
ROW_INDEX, STRIPE_BYTES, FALSE_POSITIVES = 1_000, 64 << 20, 0.01
#: Bytes of ids of a batch that goes to the writer, unless one document alone has more.
BATCH_BYTES = 8 << 20

_chunk_ids: dict = {}


class ChunkIds(dict):
    """Ids of chunks as little-endian 32-bit bytes. It starts anew when full; long chunks aren't kept."""

    def __init__(self, path: str, size: int = CACHE_SIZE, longest: int = LONGEST):
        super().__init__()
        self.tok, self.size, self.longest = tokenizer(path), size, longest
        self.ranks, self.words = WordRanks.of(path), {}

    def encoded(self, texts: list[list[bytes]]) -> list[bytes]:
        """For each text, given as its chunks, the ids of all of them."""
        new = set(chain.from_iterable(texts)).difference(self)
        if len(self) + len(new) > self.size:
            self.clear()
            new = set(chain.from_iterable(texts))
        if len(self.words) > self.size:
            self.words.clear()
        left = []
        for c in new:
            s = c.decode("utf-8", "replace")
            if self.ranks and len(c) <= self.longest and "<|" not in s and PLAIN.fullmatch(s):
                self[c] = self.ranks.encode(s, self.words)
            else:
                left.append((c, s))
        for k in range(0, len(left), 10_000):
            some = left[k : k + 10_000]
            for (c, _), e in zip(some, self.tok.encode_batch([s for _, s in some], add_special_tokens=False)):
                self[c] = pack(e.ids)
        out = [b"".join(map(self.__getitem__, chunks)) for chunks in texts]
        for c in new:
            if len(c) > self.longest:
                del self[c]
        return out


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows in the order in which they come, with their place among the task's ids."""
    if path not in _chunk_ids:
        _chunk_ids[path] = ChunkIds(path)
    known = _chunk_ids[path]
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()
    part, at = TaskContext.get().partitionId(), 0
    held: list[tuple] = []
    names = ["doc_id", "part", "at", "n_tokens", "ids"]

    def out() -> pa.RecordBatch:
        nonlocal at
        docs, ids = [d for d, _ in held], [i for _, i in held]
        sizes = np.array([len(i) // 4 for i in ids], np.int64)
        ends = np.cumsum(sizes)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        places = at + ends - sizes
        at += int(ends[-1])
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(docs, kind), pa.array(np.full(len(docs), part, np.int32)), pa.array(places), pa.array(sizes), lists], names)

    for b in batches:
        texts = [t.split() if t else [] for t in b.column(1).cast(pa.binary()).to_pylist()]
        size = 0
        for doc, ids in zip(b.column(0).to_pylist(), known.encoded(texts)):
            held.append((doc, ids + end))
            size += len(ids)
            if size >= BATCH_BYTES:
                yield out()
                size = 0
        if held:
            yield out()


def write_tokens(docs: DataFrame, out: str, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = END_ID, row_index: int = ROW_INDEX, stripe_bytes: int = STRIPE_BYTES) -> str:
    """Writes the documents' ids, by the ``tokenizers`` file at ``path`` (one that drops white space), to the new folder ``out``."""
    spark = docs.sparkSession
    importable(spark)
    from pyspark.sql.pandas.types import to_arrow_type

    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = d.schema["_id"].dataType
    arrow = to_arrow_type(kind)
    # rows that agree in id and text may go to any task: whichever stands first, the rows are the same
    order = ["_id", "_tie", "_row"]
    ordered = d.withColumn("_tie", F.xxhash64("_text")).withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")
    rows = ordered.mapInArrow(lambda b: encode_batches(b, path, end_id, arrow), f"doc_id {kind.simpleString()}, part int, at bigint, n_tokens bigint, ids array<int>")
    options = {"compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(FALSE_POSITIVES), "orc.row.index.stride": str(row_index), "orc.stripe.size": str(stripe_bytes)}
    rows.write.options(**options).orc(f"{out}/data")
    sizes = spark.read.orc(f"{out}/data").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    base = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")
    sizes.withColumn("base", base).coalesce(1).write.options(compression="zstd").orc(f"{out}/parts")
    return out


def read_tokens(spark: SparkSession, path: str, ids: list | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, or of those named in ``ids``: that filter goes to the reader, which skips what row
    indexes and Bloom filters rule out."""
    data = spark.read.orc(f"{path}/data")
    if ids is not None:
        data = data.where(F.col("doc_id").isin(ids))
    parts = guarded(spark.read.orc(f"{path}/parts").select("part", "base"), 400_000)
    return data.join(parts, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def token_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The ids at places ``start`` to ``stop`` (excluded) of the whole corpus: ``start, doc_id, ids`` of each document that has some of them. Parts and
    places are compared with constants, so only runs of rows that overlap are read."""
    parts = spark.read.orc(f"{path}/parts").where((F.col("base") < stop) & (F.col("base") + F.col("n_tokens") > start))
    bounds = parts.agg(F.min("part"), F.max("part"), F.min(F.struct("part", "base"))["base"], F.max(F.struct("part", "base"))["base"]).first()
    low, high, first_base, last_base = bounds if bounds[0] is not None else (0, -1, 0, 0)
    data = spark.read.orc(f"{path}/data").where(F.col("part").between(low, high) & ((F.col("part") > low) | (F.col("at") + F.col("n_tokens") > start - first_base)) & ((F.col("part") < high) | (F.col("at") < stop - last_base)))
    rows = data.join(guarded(spark.read.orc(f"{path}/parts").select("part", "base"), 400_000), "part").withColumn("_start", F.col("base") + F.col("at"))
    begin = F.greatest(F.lit(start) - F.col("_start"), F.lit(0))
    end = F.least(F.lit(stop) - F.col("_start"), F.col("n_tokens"))
    return rows.where(begin < end).select((F.col("_start") + begin).alias("start"), "doc_id", F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"))


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(2)
        offsets, values = lists.offsets.to_numpy(), memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        crcs = [zlib.crc32(values[4 * i : 4 * j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read_tokens`` returns."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "ids").mapInArrow(checksums, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/threadloom/tokens-{uuid.uuid4().hex}"
    return digests(read_tokens(spark, write_tokens(table(spark, sf_dir, "documents"), out, tokenizer_path("word_bpe_49k.json"))))

"""Token counts by a two-tier lookup on the map side.

A text's tokens are the sum of those of its chunks between ASCII white space: the tokenizer drops white space before it
merges, so no token spans two chunks, and its normal form never crosses white space. The first tier is a table of the
most frequent chunks' lengths, gathered from the whole corpus as bounded summaries of each task and broadcast (its number of
entries is a parameter). A chunk that isn't there is encoded once and kept in the worker's own bounded cache, the
second tier. Texts and chunks are never shuffled, only the summaries.

Defined results: a null text counts as empty, with no bytes and no tokens; repeated rows give repeated rows; texts of any
length are counted in whole; other columns are not looked at.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import importable, table

#: Entries of the broadcast table, and of each task's summary of it. Bound on a chunk's bytes in either tier.
TABLE_SIZE, SUMMARY_SIZE, LONGEST = 16_384, 4_096, 48
#: Entries of a worker's cache; it starts anew when full.
CACHE_SIZE = 400_000
OVER = 2048

_tokenizers: dict = {}
_caches: dict = {}


def tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def summaries(batches: Iterator[pa.RecordBatch], size: int, longest: int) -> Iterator[pa.RecordBatch]:
    """The most frequent chunks of a task. The counter is cut back whenever it holds many times what it may return."""
    seen: Counter = Counter()
    for b in batches:
        seen.update(chain.from_iterable(t.split() for t in b.column(0).cast(pa.binary()).to_pylist() if t))
        if len(seen) > 64 * size:
            seen = Counter(dict(seen.most_common(16 * size)))
    top = [(w, n) for w, n in seen.most_common(size) if len(w) <= longest and n > 1]
    if top:
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["w", "n"])


def frequent(docs: DataFrame, table_size: int = TABLE_SIZE, summary_size: int = SUMMARY_SIZE, longest: int = LONGEST) -> list[bytes]:
    """At most ``table_size`` chunks of at most ``longest`` bytes. Which ones they are never changes a count."""
    parts = docs.select("_text").mapInArrow(lambda b: summaries(b, summary_size, longest), "w binary, n bigint")
    top = parts.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(table_size).collect()
    return [bytes(r.w) for r in top]


def count_batches(batches: Iterator[pa.RecordBatch], first, path: str, cache_size: int, longest: int) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(path)
    cache = _caches.setdefault(path, {})
    known: dict = first.value

    def lengths(chunks: list[bytes]) -> list[int]:
        return [len(e) for e in tok.encode_batch([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)]

    def count(text: bytes) -> int:
        total, misses = 0, []
        for n, c in zip(map(known.get, chunks := text.split()), chunks):
            if n is None:
                misses.append(c)
            else:
                total += n
        if not misses:
            return total
        own = {}
        if new := [c for c in set(misses) if c not in cache]:
            if len(cache) + len(new) > cache_size:
                cache.clear()
                new = list(set(misses))
            own = dict(zip(new, lengths(new)))
            cache.update((c, n) for c, n in own.items() if len(c) <= longest)
        return total + sum(own[c] if c in own else cache[c] for c in misses)

    for b in batches:
        texts = b.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) if t else 0 for t in texts], pa.int64()), pa.array([count(t) if t else 0 for t in texts], pa.int64())], ["_id", "_n_bytes", "_n_tokens"])


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", over: int = OVER, table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row, by the ``tokenizers`` file at ``path`` (one that drops white
    space; see the module). ``path`` is opened by the workers."""
    spark = docs.sparkSession
    importable(spark)
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    words = frequent(d, table_size, longest=longest)
    sizes = [len(e) for e in tokenizer(path).encode_batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
    first = spark.sparkContext.broadcast(dict(zip(words, sizes)))
    kind = d.schema["_id"].dataType.simpleString()
    out = d.mapInArrow(lambda b: count_batches(b, first, path, cache_size, longest), f"_id {kind}, _n_bytes bigint, _n_tokens bigint")
    return out.select(F.col("_id").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_tokens").alias("n_tokens"), (F.col("_n_tokens") > over).alias("over_limit"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))

"""Language identification by error-correcting output codes.

Every learned language has a codeword of bits. A binary classifier on hashed byte n-grams predicts each bit; a text takes the
language whose codeword costs the least logistic loss, each bit weighted by how well its classifier did in training.
A text whose two nearest codewords cost about the same is flagged as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows: at most ``per_language`` of each language, those with the
smallest hashes of their id. Only ids and labels are ranked, and of these only as many as have hashes that may be among the
smallest; the sample's ids are broadcast, so texts are never shuffled to be chosen. Counts are added up on the executors.
Predictions read every text in whole, and nothing but the text.

Defined results: a null text and one without a letter are ``und`` with score 0, as is every text if no row is labelled;
a single learned language is predicted for every text that has a letter; of codewords that cost the same the first in
the languages' order wins; repeated rows give repeated rows and are learned from as often as they stand; other columns are
not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import guarded, importable, table, written

#: Sampled rows of each language, slots of hashed n-grams, a bit's share of sharpness for each root of an n-gram, and the least lead.
PER_LANGUAGE, SLOTS, SHARPNESS, LEAD = 2000, 1 << 14, 0.6, 0.25
#: Rows up to which the sample's ids are broadcast (hundreds of languages).
SAMPLE_ROWS = 400_000
#: N-grams beyond which more text makes a prediction no surer.
SURE = 400
BLOCK = 1 << 20

#: ASCII beyond letters becomes a space.
LETTERS = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
ASCII_LETTER = re.compile("[A-Za-z]")


def codewords(n: int) -> np.ndarray:
    """n rows of bits as +1 and -1: all splits for few languages, else the best of some random codes of fixed seed."""
    if n <= 5:
        splits = [m for m in range(1, 1 << max(0, n - 1))]
        return np.array([[1 if (m >> i) & 1 else -1 for m in splits] for i in range(n)]).reshape(n, len(splits))
    bits, rng, best, far = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits))
        if (np.abs(code.sum(0)) == n).any():
            continue
        gap = min(int((a != b).sum()) for a, b in combinations(code, 2))
        if gap > far:
            best, far = code, gap
    return best


def grams(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, slots, starts) for blocks of texts: the slots of the n-grams of each text from its start on.
    A text is folded to small letters with single spaces around its words."""
    at = 0
    while at < len(texts):
        parts, size, first = [], 0, at
        while at < len(texts) and (size < BLOCK or at == first):
            parts.append(b" " + (texts[at] or "").lower().encode("utf-8", "replace").translate(LETTERS) + b"  ")
            size += len(parts[-1])
            at += 1
        x = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
        keep[np.r_[0, ends[:-1]]] = True
        x, starts = x[keep].astype(np.uint32), np.r_[0, np.cumsum(keep)[ends - 1]][:-1]
        h = x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D) if len(x) > 2 else np.zeros(0, np.uint32)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        # The last two places of a text would reach into the next one: they go to slot 0, whose weight is 0.
        slots = np.r_[(h >> np.uint32(18)).astype(np.int64) % (SLOTS - 1) + 1, 0, 0][: len(x)]
        slots[np.r_[starts[1:], len(x)] - 1] = 0
        slots[np.maximum(np.r_[starts[1:], len(x)] - 2, starts)] = 0
        yield first, at, slots, starts


def train_counts(docs: DataFrame) -> list:
    """(lang, counts of slots) of the sampled rows, (_lang, _text), in at most eight parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in set(langs):
                mine = total.setdefault(lang, np.zeros(SLOTS))
                for _, _, slots, _ in grams([t for t, x in zip(texts, langs) if x == lang]):
                    mine += np.bincount(slots, minlength=SLOTS)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["lang", "counts"])

    return docs.repartition(8).mapInArrow(count, "lang string, counts binary").collect()


class Model:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        self.code = codewords(len(self.langs))
        table = np.array([counts[x] for x in self.langs]).reshape(len(self.langs), SLOTS)
        table[:, 0] = 0
        p = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * SLOTS)  # languages weigh alike
        weights = [np.log(p[c > 0].mean(0)) - np.log(p[c < 0].mean(0)) for c in self.code.T]
        self.weights = np.array(weights, np.float32).reshape(-1, SLOTS).T.copy()
        self.weights[0] = 0
        # A bit counts as much as its classifier tells the languages' own n-grams apart on average.
        gain = (p @ self.weights) * self.code
        self.trust = np.maximum(gain.min(0), 1e-3) if len(self.langs) > 1 else np.zeros(0)
        self.trust = self.trust / self.trust.sum() * len(self.trust) if len(self.trust) else self.trust

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous, for each text."""
        n, k = len(texts), len(self.langs)
        has = np.array([bool(t) and (ASCII_LETTER.search(t) is not None or any(c.isalpha() for c in t)) for t in texts], bool)
        if not k or not n:
            return ["und"] * n, np.zeros(n), np.ones(n, bool)
        margin, size = np.zeros((n, self.code.shape[1]), np.float64), np.zeros(n)
        for first, last, slots, starts in grams(texts):
            size[first:last] = np.add.reduceat((slots > 0).astype(np.int64), starts)
            for j in range(margin.shape[1]):
                margin[first:last, j] = np.add.reduceat(self.weights[slots, j], starts, dtype=np.float64)
        margin /= np.maximum(size, 1)[:, None]
        margin *= (SHARPNESS * np.sqrt(np.minimum(size, SURE)))[:, None]
        loss = np.stack([(np.logaddexp(0, -margin * c) * self.trust).sum(1) for c in self.code], 1)
        best = loss.argmin(1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        score = 1 / share.sum(1)
        two = np.sort(loss, 1)[:, :2]
        close = (two[:, 1] - two[:, 0] < LEAD) if k > 1 else np.zeros(n, bool)
        return [self.langs[i] if ok else "und" for i, ok in zip(best, has)], np.where(has, score, 0.0), close | ~has


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``docs``: (_id, _text, _lang) of the rows to learn from; those without a language are left out."""
    ids = docs.where("_lang is not null").select("_id", "_lang", F.xxhash64("_id").alias("_x"))
    sizes = ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    # Twice as many hashes as wanted, and some more, are left to rank: a language's share of them doesn't grow with the corpus.
    near = F.pmod("_x", F.lit(1 << 40)) * F.col("_n") < F.lit(float((2 * per_language + 200) * (1 << 40)))
    near = ids.join(guarded(written(sizes, "language-sizes"), SAMPLE_ROWS), "_lang").where(near)
    order = Window.partitionBy("_lang").orderBy(F.pmod("_x", F.lit(1 << 40)), "_id")
    some = near.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_language).select("_id", "_lang").distinct()
    rows = docs.join(guarded(written(some, "language-sample"), SAMPLE_ROWS), ["_id", "_lang"], "left_semi").select("_lang", "_text")
    counts: dict[str, np.ndarray] = {}
    for r in train_counts(rows):
        counts[r.lang] = counts.get(r.lang, 0) + np.frombuffer(bytes(r.counts))
    return Model(counts)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` and the columns of ``keep`` for each row."""
    spark = docs.sparkSession
    importable(spark)
    keep = keep or []
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"), *keep)
    shared = spark.sparkContext.broadcast(model)  # slots x bits, whatever the corpus
    names = ["doc_id", *keep, "lang_pred", "score", "ambiguous"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, close = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *(b.column(2 + i) for i in range(len(keep))), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())], names)

    own = "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(predict, f"doc_id {d.schema['doc_id'].dataType.simpleString()}{own}, lang_pred string, score double, ambiguous boolean")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    docs = docs.withColumn("held_out", held)
    model = fit(docs.where(~F.col("held_out")).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang")))
    return identify(docs, model, keep=["held_out"])

"""A training-corpus pipeline: quality rules, line dedup, near-duplicates, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor kept and returns the columns of
``documents`` (the last one the packed pieces).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import base, decontamination, line_dedup, minhash, packing, quality, token_counts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly so, go; ``n_chars`` follows the text where there is such a column. Documents stay,
    if need be with an empty text."""
    from pyspark.sql import functions as F

    out = line_dedup.dedup_lines(docs)
    if "n_chars" not in out.columns:
        return out
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) the least doc_id stays."""
    return minhash.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of ten words with a benchmark item go."""
    return decontamination.without_contaminated(docs, base.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    return packing.pack(docs, token_counts.tokenizer_path("byte_bpe_50k.json"), token_counts.tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can express neither the tokenizer nor packing; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The pipeline against brute force, stage by stage and as a whole, on a small corpus."""

import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tokenizers")
import corpus_pipeline  # noqa: E402
from tests.llm.test_operators import brute_components, brute_lines, brute_quality, fold, prose  # noqa: E402
from threadloom.llm import quality, token_counts  # noqa: E402

COMMON = "the of and to in is that it for was on with as be by"


def text(n, seed):
    """Prose with common words, so that the quality rules have nothing against it."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(COMMON.split()) if k % 3 == 0 else w for k, w in enumerate(prose(n, seed).split())).capitalize() + "."


def corpus():
    a, b, line = text(120, 1), text(80, 2), text(12, 3)
    passage = text(14, 4)
    return [a, a + " tail words here", b, f"{text(40, 5)}\n{line}", f"{line}\n{text(40, 6)}", "| ".join(text(60, 7).split()), "short", None, "", text(30, 8) + " " + passage, text(50, 9), "same words again and " * 20, b.replace("the", "then", 1)], passage


def write(spark, d, texts, passage):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")


def test_pipeline(spark, tmp_path):
    texts, passage = corpus()
    write(spark, tmp_path, texts, passage)
    d = str(tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, left = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    judged = {r.doc_id: r.kept for r in quality.score_quality(docs).collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, d)
        assert out.columns == columns
        out.write.parquet(f"{d}/stage{k}")
        docs = spark.read.parquet(f"{d}/stage{k}")
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            assert not any(brute_quality(left[i])[5] for i in got)
            want = {i: t for i, t in left.items() if judged[i]}
        elif name == "line_dedup":
            want = {i: t for i, (t, _, _) in brute_lines(left).items()}
            assert {r.doc_id: r.n_chars for r in docs.collect()} == {i: len(t or "") for i, t in want.items()}
        elif name == "minhash_dedup":
            want = {i: left[i] for i, (_, c) in brute_components(left, 5, 80).items() if i == c}
        else:
            v = re.findall("[0-9a-z]+", fold(passage))
            grams = {tuple(v[i : i + 10]) for i in range(len(v) - 9)}
            want = {}
            for i, t in left.items():
                w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(t))
                if not any(tuple(w[k : k + 10]) in grams for k in range(len(w) - 9)):
                    want[i] = t
        assert sorted(got) == sorted(want), name
        assert got == want, name
        assert name == "line_dedup" or set(got) < set(left), name
        left = got
    tok = token_counts.tokenizer(token_counts.tokenizer_path("byte_bpe_50k.json"))
    whole = {}
    for r in corpus_pipeline.run(spark, d).collect():
        whole.setdefault(r.doc_id, []).append(r)
    assert set(whole) == set(left)
    for i, rs in whole.items():
        ids, at = [*tok.encode(left[i] or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_pipeline_empty(spark, tmp_path):
    write(spark, tmp_path, [], "x")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_bench_times_every_corpus_query():
    import __spark_entry__
    import bench

    assert set(bench.CORPUS) == {n for n in __spark_entry__.queries() if re.match(r"op\d+_", n) or n == "pipeline"}

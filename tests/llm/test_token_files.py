"""Token files: round trips against the tokenizer's library, and what the files themselves hold."""

import glob
import os
import struct
import zlib

import pytest

pytest.importorskip("tokenizers")
from threadloom.llm import token_files as m  # noqa: E402
from threadloom.llm.token_counts import tokenizer, tokenizer_path  # noqa: E402

DOCS = "doc_id long, text string, ids string, part string, _id string, _tie string"
PATH = tokenizer_path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS)


def ids_of(text):
    return tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [2]


ROWS = [(5, "Some Words, here: don't!"), (3, None), (4, ""), (1, " \n\t"), (2, "<|endoftext|> a<|startoftext|>b"), (9, "ΌΣΟΣ É́ ﬁ x \x00 日本語 🙂🙂 …"), (8, "long " * 20000 + "z" * 3000), (7, "word\x0bword\x0c1234 ' 's"), (-6, "before all"), (10**12, "after all")]


def stored(spark, rows, tmp, **options):
    out = m.write_tokens(frame(spark, rows), f"file://{tmp}/tokens", PATH, **options)
    return sorted(m.read_tokens(spark, out).collect(), key=lambda r: r.start), out


def test_round_trip(spark, tmp_path):
    got, out = stored(spark, ROWS, tmp_path)
    at = 0
    for r, (doc, text) in zip(got, sorted(ROWS), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc, at, len(ids_of(text)), ids_of(text))
        at += r.n_tokens
    for r in m.digests(m.read_tokens(spark, out)).collect():
        ids = ids_of(dict(ROWS)[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_repeated_rows_ties_and_null_ids(spark, tmp_path):
    rows = [(1, "one two")] * 4 + [(1, "other")] * 2 + [(None, "no id"), (None, None), (0, "zero")]
    got, _ = stored(spark, rows, tmp_path)
    assert [r.doc_id for r in got] == [None, None, 0] + [1] * 6
    assert sorted(map(tuple, ((r.doc_id or -1, r.ids) for r in got))) == sorted((i or -1, ids_of(t)) for i, t in rows)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    runs = [r.ids for r in got if r.doc_id == 1]
    assert runs in ([ids_of("one two")] * 4 + [ids_of("other")] * 2, [ids_of("other")] * 2 + [ids_of("one two")] * 4)


def test_empty_table(spark, tmp_path):
    assert stored(spark, [], tmp_path)[0] == []


def test_small_cache_gives_the_same_ids():
    known = m.ChunkIds(PATH, size=3, longest=4)
    for text in ["one two three four", "two elephantine one", "five six seven eight nine", ""] * 2:
        assert known.encoded([text.encode().split()])[0] == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])
        assert len(known) <= 5 and all(len(c) <= 4 for c in known)


def test_ranks_give_the_library_s_ids():
    import random

    from threadloom.llm.word_ranks import PLAIN, WordRanks, last_pair

    r, ranks = random.Random(3), WordRanks.of(PATH)
    signs = "aeiourstnlmAEST0159'\"-_.,;:!?()[]{}<|>@#%&*/~^`" + "".join(map(chr, range(0xA1, 0x250)))
    chunks = ["".join(r.choices(signs, [20] * 12 + [1] * (len(signs) - 12), k=r.randint(1, 24))) for _ in range(30000)]
    chunks += [w + s for w in tokenizer(PATH).get_vocab() for s in ("", "s") if PLAIN.fullmatch(w + s)][::5]
    chunks = [c for c in chunks if "<|" not in c]
    for c, e in zip(chunks, tokenizer(PATH).encode_batch(chunks, add_special_tokens=False)):
        assert ranks.encode(c, {}) == struct.pack(f"<{len(e.ids)}I", *e.ids), c
    assert WordRanks.of(tokenizer_path("byte_bpe_50k.json")) is None
    assert last_pair(b"abc", {(b"b", b"c"): 0, (b"a", b"bc"): 1, (b"a", b"b"): 2, (b"ab", b"c"): 3}) == (b"a", b"bc")


def rows_scanned(df):
    """Rows that the scan gave to the plan, after stripes and runs of rows were skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            p = p.executedPlan()
        if p.nodeName().startswith("Scan orc"):
            total += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
    return total


def test_metadata_prunes_and_stripes_split(spark, tmp_path):
    rows = [(3 * i, f"w{i} and some more words of document {i}") for i in range(9000)]
    got, out = stored(spark, rows, tmp_path, stripe_bytes=1 << 16)
    assert len(got) == 9000
    data = spark.read.orc(f"{out}/data")
    assert rows_scanned(data.select("ids")) == 9000
    assert 0 < rows_scanned(data.where("doc_id = 3000").select("ids")) <= m.ROW_INDEX
    assert rows_scanned(data.where("doc_id = 3001").select("ids")) == 0  # within a run's bounds: only the Bloom filter can tell
    assert [r.doc_id for r in m.read_tokens(spark, out, [3000, 3001, 6]).orderBy("doc_id").collect()] == [6, 3000]
    from pyarrow import orc

    files = [orc.ORCFile(f) for f in glob.glob(f"{tmp_path}/tokens/data/*.orc")]
    assert sum(f.nrows for f in files) == 9000 and files[0].compression == "ZSTD"
    # run-length encoded: a quarter of what plain 32-bit ids of these texts would take, the repeated words apart
    assert sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/tokens/data/*.orc")) < sum(r.n_tokens for r in got)


def test_ranges_of_tokens(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, out = stored(spark, rows, tmp_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    everything = [x for r in got for x in r.ids]
    assert len({r.part for r in spark.read.orc(f"{out}/parts").collect()}) > 1
    for start, stop in [(0, 1), (0, len(everything)), (777, 9001), (len(everything) - 3, len(everything) + 10), (50, 50), (10**9, 10**9 + 5)]:
        part = sorted(m.token_range(spark, out, start, stop).collect(), key=lambda r: r.start)
        assert [x for r in part for x in r.ids] == everything[start:stop]
        assert not part or part[0].start == start
    assert rows_scanned(m.token_range(spark, out, 777, 800)) <= 2 * m.ROW_INDEX

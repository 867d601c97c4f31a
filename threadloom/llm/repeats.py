"""Removal of long repeated strings.

A byte goes if it lies in a string of SPAN bytes that also starts earlier: in a document of smaller id, or further up in its
own. Strings are judged on the input, overlaps count, and matches never cross documents.

The corpus is dealt into shards by content, so that strings that are equal meet in one: a window of SPAN bytes belongs to the
least hash of its GRAM-byte strings (its anchor), and consecutive windows with the same anchor are one run, some 27 windows.

1. Runs whose anchor stands nowhere else are dropped, after an aggregation of narrow rows.
2. Of runs with equal bytes all but the first go in whole, before anything is shuffled by anchor.
3. The runs left of an anchor, each other than the rest, are a group; groups make shards of bounded size. In a shard a
   run-length index (``run_index``: run-compressed Burrows-Wheeler transform, sampled run ends) is built of earlier runs,
   matching statistics of later ones are streamed against it, and windows that begin a match of SPAN bytes go
   (``repeated_windows``). A group with more than GROUP runs would not be bounded; its windows are dealt anew one by one.

The index answers for the text that it was built on. Built on shards of documents, each would have to be streamed by all later
documents; built on shards by content, each run is streamed by its own shard alone, and work grows with the corpus.

Only narrow rows are shuffled for 1 and 2; texts join once for 3 and once for the removal, those with shared runs alone
(``base.narrowed``). Joins are of one kind at any size, as both sides grow with the corpus.

Hashes are polynomials in 64 bits; runs are compared by two of them, the anchor's and their own, windows by the index.

Defined results: a null or empty text has no bytes; texts under SPAN bytes are never cut; repeated rows are one document (they
give repeated results and don't remove each other); rows that share a doc_id but not the text are documents of their own,
ordered by a hash of the text; a null doc_id comes first; texts may be of any length; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import guarded, importable, narrowed, table, written
from .run_index import RunIndex
from .shingles import BASE, INVERSE, mix, powers

SPAN, GRAM, GROUP = 100, 48, 20_000
BLOCK = 1 << 20
#: Equal runs beyond which their places meet the first one by a broadcast. There are at most as many such runs as shared ones by HOT.
HOT, HOT_ROWS = 5_000, 400_000


def prefix_sums(x: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(x)), out=sums[1:])
    return sums


def ranges(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from a to b (arrays of places)."""
    return mix((sums[b] - sums[a]) * powers(INVERSE, len(sums))[a] ^ (b - a).astype(np.uint64))


def blocks(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(texts):
        some, size, first = [], 0, at
        while at < len(texts) and (size < BLOCK or not some):
            some.append(texts[at] or b"")
            size += len(some[-1])
            at += 1
        yield first, some


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    got = 1
    while 2 * got <= width:
        h = np.minimum(h[:-got], h[got:])
        got *= 2
    return np.minimum(h[: len(h) - (width - got)], h[width - got :]) if width > got else h


def runs(texts: list[bytes], span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor, hash of its bytes) of all runs of windows of a block of texts."""
    x = np.frombuffer(b"".join(texts), np.uint8)
    n = len(x)
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    if n < span:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = prefix_sums(x)
    h = (sums[gram:] - sums[:-gram]) * powers(INVERSE, n)[: n - gram + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    least = least_of(h, span - gram + 1)  # for windows at 0 .. n - span
    valid = np.zeros(n - span + 2, np.int8)
    ok = size >= span
    np.add.at(valid, (end - size)[ok], 1)
    np.add.at(valid, (end - span + 1)[ok], -1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    new = np.ones(len(least), bool)
    # A run ends where the least hash changes, or where its first place falls out of the window.
    new[1:] = ~valid[:-1] | (least[1:] != least[:-1]) | (h[: len(least) - 1] == least[:-1])
    starts = np.flatnonzero(new & valid)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    doc = np.searchsorted(end, starts, "right")
    last = np.minimum(np.r_[starts[1:], n] - 1, end[doc] - span)
    return doc, starts - (end - size)[doc], last - starts + 1, least[starts], ranges(sums, starts, last + span)


def run_batches(batches: Iterator[pa.RecordBatch], span: int, gram: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        for first, some in blocks(b.column(1).cast(pa.binary()).to_pylist()):
            doc, start, n, anchor, own = runs(some, span, gram)
            if len(doc):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc + first)), pa.array(anchor.view(np.int64)), pa.array(own.view(np.int64)), pa.array(start), pa.array(n)], ["_id", "_a", "_h", "_at", "_n"])


def cut_batches(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """(_id, _text, _runs) to a row for each run with its bytes."""
    for b in batches:
        ids, anchors, hs, ats, ns, cuts = [], [], [], [], [], []
        texts, wanted = b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()
        for k, (t, rs) in enumerate(zip(texts, wanted)):
            for r in rs:
                ids.append(k)
                anchors.append(r["_a"])
                ats.append(r["_at"])
                cuts.append(t[r["_at"] : r["_at"] + r["_n"] + span - 1])
                ns.append(r["_n"])
                hs.append(r["_many"])
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(anchors, pa.int64()), pa.array(ats, pa.int64()), pa.array(hs, pa.bool_()), pa.array(cuts, pa.binary())], ["_id", "_a", "_at", "_many", "_cut"])


def window_hashes(cuts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of the cuts, and how many each has."""
    n = np.array([len(c) - span + 1 for c in cuts], np.int64)
    first = np.cumsum([0] + [len(c) for c in cuts])[:-1]
    at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    return ranges(prefix_sums(np.frombuffer(b"".join(cuts), np.uint8)), at, at + span), n


def repeated_windows(rows: list[tuple[int, bytes]], span: int) -> list[tuple[int, int, int]]:
    """``rows``: (anchor, bytes), groups of one anchor together and in order. (row, lo, hi): windows that an earlier row of the group has.

    Groups are halved again and again, all at once: each time an index of the first halves is streamed by the second ones.
    Windows found so are left out of all that follows, so what stands in a later pair of halves can't be taken for earlier.
    """
    place, sizes = [], Counter(a for a, _ in rows)
    for k, (a, _) in enumerate(rows):
        place.append(place[-1] + 1 if k and rows[k - 1][0] == a else 0)
    pieces = [(k, 0, len(c) - span + 1) for k, (a, c) in enumerate(rows) if sizes[a] > 1]
    found = []
    for level in range(max(sizes.values(), default=1).bit_length() - 1, -1, -1):
        pairs: dict[tuple, int] = defaultdict(int)
        for k, _, _ in pieces:
            pairs[rows[k][0], place[k] >> (level + 1)] |= 1 << ((place[k] >> level) & 1)
        early, late, rest = [], [], []
        for x in pieces:
            k = x[0]
            both = pairs[rows[k][0], place[k] >> (level + 1)] == 3
            (rest if not both else late if (place[k] >> level) & 1 else early).append(x)
        if not late:
            continue
        cut = lambda x: rows[x[0]][1][x[1] : x[2] + span - 1]
        pieces = rest + early
        for (k, lo, hi), n in zip(late, RunIndex([cut(x) for x in early]).matching([cut(x) for x in late])):
            gone = np.zeros(hi - lo + 2, np.int8)
            gone[1:-1] = n[: hi - lo] >= span
            edges = np.flatnonzero(np.diff(gone)) + lo
            found += [(k, int(i), int(j) - 1) for i, j in zip(edges[::2], edges[1::2])]
            stay = [lo, *edges.tolist(), hi]
            pieces += [(k, i, j) for i, j in zip(stay[::2], stay[1::2]) if j > i]
    return found


def compare_batches(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Rows (_id, _a, _at, _cut) sorted by (_a, _id, _at): runs (_id, _lo, _hi) of windows that an earlier row of their anchor has."""
    held, ids, size = [], None, 0  # (anchor, place, bytes), and their ids

    def out() -> Iterator[pa.RecordBatch]:
        got = repeated_windows([(a, c) for a, _, c in held], span)
        if got:
            at = [held[k][1] for k, _, _ in got]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array([k for k, _, _ in got])), pa.array([p + i for p, (_, i, _) in zip(at, got)]), pa.array([p + j for p, (_, _, j) in zip(at, got)])], ["_id", "_lo", "_hi"])

    for b in batches:
        ids = b.column(0) if ids is None else pa.concat_arrays([ids, b.column(0)])
        for a, p, cut in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            if size > BLOCK and held[-1][0] != a:
                yield from out()
                ids, held, size = ids.slice(len(held)), [], 0
            held.append((a, p, cut))
            size += len(cut)
    if held:
        yield from out()


def explode_batches(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cuts = b.column(3).to_pylist()
        for k in range(0, len(cuts), 2000):
            h, n = window_hashes(cuts[k : k + 2000], span)
            row = np.repeat(np.arange(len(n)), n) + k
            at = np.repeat(b.column(2).to_numpy()[k : k + 2000] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(h))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(at), pa.array(h.view(np.int64))], ["_id", "_a", "_lo", "_w"])


def cut_out(text: bytes, spans: list[dict], span: int) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many runs."""
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, [s["_lo"] for s in spans], 1)
    np.add.at(edge, [min(len(text), s["_hi"] + span) for s in spans], -1)
    gone = np.cumsum(edge[:-1]) > 0
    n_spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), n_spans


def remove_batches(batches: Iterator[pa.RecordBatch], span: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [cut_out(t or b"", s, span) for t, s in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist())]
        cols = [b.column(0), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()), pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())]
        names = ["_rid", "_removed", "_spans", "_sha"]
        if with_text:
            cols.append(pa.array([g[0] for g in got], pa.binary()))
            names.append("_kept")
        yield pa.RecordBatch.from_arrays(cols, names)


def repeated_spans(d: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``d``: (_id, _text). Written rows (_id, _lo, _hi): windows that start from _lo to _hi also start earlier."""
    name = d.schema["_id"].dataType.simpleString()
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = d.mapInArrow(lambda b: run_batches(b, span, gram), f"_id {name}, _a bigint, _h bigint, _at bigint, _n bigint")
    anchors = written(rows.groupBy("_a").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_a"), "shared-anchors")
    shared = written(narrowed(rows, anchors, "_a"), "shared-runs")
    first = shared.groupBy("_a", "_h").agg(F.min(F.struct("_id", "_at")).alias("_first"), F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_c"))
    first = written(first, "first-runs")
    copies = first.where("_c > 1").select("_a", "_h", "_first", "_c")
    # Places of runs that stand very often meet the few first ones without a shuffle, so no task gets all of one run.
    hot = guarded(written(copies.where(F.col("_c") > HOT).drop("_c"), "hot-runs"), HOT_ROWS)
    cold = copies.where(F.col("_c") <= HOT).drop("_c")
    whole = shared.join(hot, ["_a", "_h"]).unionByName(narrowed(shared, cold, "_h").join(cold.hint("merge"), ["_a", "_h"]))
    whole = whole.where(F.struct("_id", "_at") != F.col("_first"))
    whole = whole.select("_id", F.col("_at").alias("_lo"), (F.col("_at") + F.col("_n") - 1).alias("_hi"))

    differ = written(first.groupBy("_a").agg(F.count(F.lit(1)).alias("_runs")).where("_runs > 1"), "differing-anchors")
    own = narrowed(first, differ, "_a").join(differ, "_a")
    own = own.select(F.col("_first._id").alias("_fid"), F.struct("_a", F.col("_first._at").alias("_at"), "_n", (F.col("_runs") > group).alias("_many")).alias("_r"))
    by_doc = written(own.groupBy("_fid").agg(F.collect_list("_r").alias("_runs")), "runs-to-compare")
    cuts = with_texts(d, by_doc, "_fid").select("_id", "_text", "_runs")
    cuts = written(cuts.mapInArrow(lambda b: cut_batches(b, span), f"_id {name}, _a bigint, _at bigint, _many boolean, _cut binary"), "cuts")
    grouped = cuts.where("not _many").select("_id", "_a", "_at", "_cut").repartition(parts, "_a").sortWithinPartitions("_a", "_id", "_at")
    near = grouped.mapInArrow(lambda b: compare_batches(b, span), f"_id {name}, _lo bigint, _hi bigint")
    windows = cuts.where("_many").select("_id", "_a", "_at", "_cut").mapInArrow(lambda b: explode_batches(b, span), f"_id {name}, _a bigint, _lo bigint, _w bigint")
    firsts = windows.groupBy("_a", "_w").agg(F.min(F.struct("_id", "_lo")).alias("_first"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    far = windows.join(firsts, ["_a", "_w"]).where(F.struct("_id", "_lo") != F.col("_first")).select("_id", "_lo", F.col("_lo").alias("_hi"))
    return written(whole.unionByName(near).unionByName(far), "repeated-spans")


def with_texts(d: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``d`` joined with the rows whose ``key`` is its ``_id``; other texts aren't shuffled."""
    some = narrowed(d.withColumn("_k", F.xxhash64("_id")), rows.select(F.xxhash64(key).alias("_k")), "_k").drop("_k")
    return some.join(rows.hint("merge"), F.col("_id").eqNullSafe(F.col(key)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, group: int = GROUP, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row, and ``kept`` (binary: a cut may fall inside a character)
    ``with_text``."""
    importable(docs.sparkSession)
    t = F.col(text).cast("string")
    d = docs.select(F.struct(F.col(doc_id).alias("i"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("t")).alias("_id"), t.alias("_text"))
    name = d.schema["_id"].dataType.simpleString()
    spans = repeated_spans(d, span, gram, group).groupBy(F.col("_id").alias("_sid")).agg(F.collect_list(F.struct("_lo", "_hi")).alias("_where"))
    cut = with_texts(d, written(spans, "spans-by-document"), "_sid").select("_id", "_text", "_where")
    kept = ", _kept binary" if with_text else ""
    cut = cut.mapInArrow(lambda b: remove_batches(b, span, with_text), f"_rid {name}, _removed bigint, _spans bigint, _sha string{kept}")
    cut = cut.dropDuplicates(["_rid", "_sha"])
    t = F.coalesce("_text", F.lit(""))
    base = d.select("_id", F.octet_length(t).cast("long").alias("_bytes"), F.sha2(t, 256).alias("_all"), *([t.cast("binary").alias("_t")] if with_text else []))
    out = base.join(cut, F.col("_id").eqNullSafe(F.col("_rid")), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("_id.i").alias("doc_id"), F.col("_bytes").alias("n_bytes"), F.coalesce("_removed", zero).alias("n_removed"), F.coalesce("_spans", zero).alias("n_spans"),
        F.coalesce("_sha", "_all").alias("kept_sha256"), *([F.coalesce("_kept", "_t").alias("kept")] if with_text else []),
    )


def op3_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))

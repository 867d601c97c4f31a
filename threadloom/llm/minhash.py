"""MinHash near-duplicates by bottom-k sketches.

A document's sketch is the ``k`` least hashes of its distinct word shingles, from one hash function. Documents with equal
sets become one node. Inverted lists of retained values give candidates: of two documents with the similarity asked for,
so many of the retained values are shared (all but a bound of 5.5 standard deviations) that one of them is among the first
``p`` of each sketch, in an order that puts values of long lists last. So lists stay short except among documents that
have nothing but common values.

Each list is held against a head among its documents of about the same size (a star, not all pairs); the union of the two
sketches estimates the similarity of these candidates, and those within the same bound are verified on the full sets of
hashes, made again from the texts. What heads leave open is followed up as ``link_nodes`` tells, until no pair of
one list is left in different components, so groups of thousands of near copies cost about as many checks as they have
members. Every pair goes through the estimate and the exact check.

Components are found by rounds of least labels. No texts, links or components reach the driver.

Defined results: a document without words, or with a null text, has an empty set and is linked with nothing; repeated rows
give repeated rows; rows that share a doc_id are one node with the links of all of them; a null doc_id is kept and has
a null component; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .base import guarded, importable, narrowed, table, written
from .components import components
from .shingles import mix, sets

SHINGLE, PERCENT, K = 5, 80, 64
#: Standard deviations that an estimate may lie below the similarity asked for. Length from which a list counts as long.
SIGMAS, LONG_LIST = 5.5, 48
BROADCAST_ROWS = 400_000
#: Rows of one list that one group of the last comparison holds. Pairs for each row of a list up to which heads aren't sought.
BLOCK, PAIRS_A_ROW = 512, 8
#: Rows of one list that meet its heads in one group.
HEAD_BLOCK = 20_000
#: Pairs of one document that one group of the exact check holds.
GROUP = 256


def sketch_batches(batches: Iterator[pa.RecordBatch], shingle: int, k: int | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, f1, f2, flat, off = [], [], [], [], [0]
        for s in sets(b.column(1).cast(pa.binary()).to_pylist(), shingle):
            n.append(len(s))
            f1.append(int(np.add.reduce(mix(s), dtype=np.uint64).view(np.int64)) if len(s) else 0)
            f2.append(int(np.bitwise_xor.reduce(mix(s + np.uint64(77))).view(np.int64)) if len(s) else 0)
            flat.append(s[:k])
            off.append(off[-1] + len(flat[-1]))
        values = np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, f1, f2)), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, pa.int64()))], ["_id", "_n", "_f1", "_f2", "_sk"])


def bound(percent: int, k: int) -> float:
    """Least share of shared values in a union sketch that still goes to the exact check."""
    j = percent / 100
    return max(0.0, j - SIGMAS * math.sqrt(j * (1 - j) / k))


def sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def prefixes(nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """``nodes``: (_id, _n, _sk). Rows (_v, _long, _id, _n, _common) of the retained values that lists are made of: those that two
    documents share at least and that are among a document's first ones. ``_long`` tells long lists, ``_common`` how many values of
    long lists the document has."""
    rows = nodes.select("_id", "_n", F.size("_sk").alias("_s"), F.posexplode_outer("_sk").alias("_i", "_v")).where("_v is not null")
    shared = rows.groupBy("_v").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    per = rows.join(shared, "_v").groupBy("_id", "_n", "_s").agg(F.collect_list(F.struct("_i", "_v", "_df")).alias("_vs"))
    per = per.withColumn("_long", F.array_sort(F.filter(F.transform("_vs", lambda x: F.when(x["_df"] >= LONG_LIST, F.struct(x["_df"].alias("d"), x["_v"].alias("v"), x["_i"].alias("i")))), lambda x: x.isNotNull())))
    # Of values not shared only the number counts; what is long follows after all others.
    short = F.transform("_vs", lambda x: F.when(x["_df"] < LONG_LIST, F.struct(x["_v"].alias("v"), (x["_i"] - F.size(F.filter("_long", lambda y: y["i"] < x["_i"]))).alias("p"), F.lit(False).alias("l"))))
    long = F.transform("_long", lambda x, r: F.struct(x["v"].alias("v"), (F.col("_s") - F.size("_long") + r).alias("p"), F.lit(True).alias("l")))
    per = per.withColumn("_ps", F.concat(F.filter(short, lambda x: x.isNotNull()), long)).withColumn("_p", F.col("_s") - F.ceil(F.lit(bound(percent, k)) * F.col("_s")) + 1)
    out = per.select("_id", "_n", "_p", F.size("_long").alias("_common"), F.explode_outer("_ps").alias("_x")).where("_x is not null and _x.p < _p")
    return out.select(F.col("_x.v").alias("_v"), F.col("_x.l").alias("_long"), "_id", "_n", "_common")


def padded(column: pa.ListArray, rows: slice, width: int, mark: int) -> np.ndarray:
    """Sketches as rows of one matrix; what is missing becomes values above all others, different for either side."""
    part = column.slice(rows.start, rows.stop - rows.start)
    size = np.diff(part.offsets.to_numpy())
    out = np.iinfo(np.int64).max - mark - np.tile(np.arange(width), (len(size), 1))
    out[np.arange(width) < size[:, None]] = part.flatten().to_numpy()
    return out


def estimate_batches(batches: Iterator[pa.RecordBatch], k: int, least: float) -> Iterator[pa.RecordBatch]:
    """Rows (_x, _y, _a, _b): the pairs whose sketches share at least that part of the sketch of their union."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i in range(0, batch.num_rows, 4096):
            rows = slice(i, min(i + 4096, batch.num_rows))
            c = np.sort(np.concatenate([padded(batch.column(2), rows, k, 0), padded(batch.column(3), rows, k, k)], 1), 1)
            real = c < np.iinfo(np.int64).max - 2 * k
            again = np.zeros(c.shape, bool)
            again[:, 1:] = c[:, 1:] == c[:, :-1]
            place = np.cumsum(~again, 1)
            union = np.minimum((real & ~again).sum(1), k)
            keep[rows] = (again & real & (place <= k)).sum(1) >= least * union
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["_x", "_y"])


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (_x, _y) that the sketch of the union of two sets doesn't rule out."""
    # The upper halves of the values keep their order and are enough for an estimate.
    half = F.transform("_sk", lambda v: F.shiftright(v, 32).cast("int"))
    a = nodes.select(F.col("_id").alias("_x"), half.alias("_a"))
    b = nodes.select(F.col("_id").alias("_y"), half.alias("_b"))
    name, least = nodes.schema["_id"].dataType.simpleString(), bound(percent, k)
    d = pairs.join(a, "_x").join(b, "_y").select("_x", "_y", "_a", "_b")
    return d.mapInArrow(lambda x: estimate_batches(x, k, least), f"_x {name}, _y {name}")


def check_batches(batches: Iterator[pa.RecordBatch], kind: pa.DataType, shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (_x, _salt, _role, _y, and _text or _sk, a full set), sorted: the text or set of x (role 0), then of its candidates."""
    now, heads = None, []
    for b in batches:
        xs, salts, roles, ys = (b.column(i).to_pylist() for i in range(4))
        out, last = [], b.column(4)
        made = (v.values.to_numpy() for v in last) if pa.types.is_list(last.type) else sets(last.cast(pa.binary()).to_pylist(), shingle)
        for x, salt, role, y, s in zip(xs, salts, roles, ys, made):
            if (x, salt) != now:
                now, heads = (x, salt), []
            if role == 0:
                heads.append(s)
                continue
            for h in heads:
                both = len(np.intersect1d(h, s, assume_unique=True))
                if both and 100 * both >= percent * (len(h) + len(s) - both):
                    out.append((x, y))
                    break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], kind), pa.array([y for _, y in out], kind)], ["_x", "_y"])


def full_sets(d: DataFrame, shingle: int) -> DataFrame:
    """``d``: (_id, _text). The different full sets of each id, (_id, _n, _f1, _f2, _sk)."""
    name = d.schema["_id"].dataType.simpleString()
    full = d.mapInArrow(lambda b: sketch_batches(b, shingle, None), f"_id {name}, _n bigint, _f1 bigint, _f2 bigint, _sk array<bigint>").where("_n > 0")
    return written(full.dropDuplicates(["_id", "_n", "_f1", "_f2"]), "full-sets")


def full_prefixes(full: DataFrame, percent: int) -> DataFrame:
    """``full``: full sets. Rows (_v, _id, _n, _r) of the values that two sets share at least, rarest first, as far as a set similar
    enough must have one of them; ``_r`` tells how many values of the set are left from this one on."""
    key = ["_id", "_n", "_f1", "_f2"]
    rows = full.select(*key, F.explode_outer("_sk").alias("_v"))
    shared = written(rows.groupBy("_v").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1"), "full-values")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("_df"), F.desc("_v")))
    return rows.join(guarded(shared, BROADCAST_ROWS), "_v").withColumn("_r", rank).where(100 * F.col("_r") >= percent * F.col("_n")).select("_v", "_id", "_n", "_r")


def part_numbers(group: int, percent: int) -> tuple[int, int]:
    """Of a group of sizes, the bands ``group`` and the one above it: the number of parts that values are dealt to, and how many parts
    may be empty before empty ones count as well."""
    most = int((100 / percent) ** (group + 2)) + 1
    differ = 2 * most * (100 - percent) // (100 + percent)
    spare = differ // 6 + 1
    return differ + 1 + spare, spare


def part_keys(s: np.ndarray, group: int, percent: int) -> np.ndarray:
    """Hashes of the parts of a set. Of two sets of the group that are similar enough, at most ``differ`` values stand in one alone, so
    more than ``spare`` parts are equal. Either one of these isn't empty, or both sets have more than ``spare`` empty parts."""
    m, spare = part_numbers(group, percent)
    part = mix(s + np.uint64(177)) % np.uint64(m)
    order = np.argsort(part, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0])
    place, sums = part[order][at], np.add.reduceat(mix(s + np.uint64(277))[order], at)
    if m - len(place) > spare:
        none = np.setdiff1d(np.arange(m, dtype=np.uint64), place, assume_unique=True)
        place, sums = np.r_[place, none], np.r_[sums, np.zeros(len(none), np.uint64)]
    return mix(mix(sums) + place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(group + 2)).view(np.int64)


def part_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Columns _id, _n, _band, _sk. The parts of each set in the group that its band begins (``_own``), and in the one that it ends."""
    for b in batches:
        own, other, n1, n2 = [], [], [0], [0]
        for v, band in zip(b.column(3), b.column(2).to_pylist()):
            s = v.values.to_numpy().view(np.uint64)
            own.append(part_keys(s, band, percent))
            other.append(part_keys(s, band - 1, percent))
            n1.append(n1[-1] + len(own[-1]))
            n2.append(n2[-1] + len(other[-1]))
        lists = [pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))) for n, x in ((n1, own), (n2, other))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *lists], ["_id", "_n", "_band", "_ours", "_others"])


def parts(full: DataFrame, percent: int) -> DataFrame:
    """``full``: (_id, _n, _band, _sk). Rows (_v, _id, _n, _band, _own) of the parts of these sets that two sets share at least."""
    name = full.schema["_id"].dataType.simpleString()
    d = full.mapInArrow(lambda b: part_batches(b, percent), f"_id {name}, _n bigint, _band int, _ours array<bigint>, _others array<bigint>")
    rows = d.select("_id", "_n", "_band", F.size("_ours").alias("_k"), F.posexplode_outer(F.concat("_ours", "_others")).alias("_i", "_v"))
    rows = written(rows.select("_v", "_id", "_n", "_band", (F.col("_i") < F.col("_k")).alias("_own")), "parts")
    shared = written(rows.groupBy("_v").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_v"), "shared-parts")
    return narrowed(rows, shared, "_v").join(shared, "_v")


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The written pairs (_x, _y) whose full sets are similar enough. ``docs``: (_id, and _text or _sk, a full set)."""
    last = "_sk" if "_sk" in docs.columns else "_text"
    salted = pairs.join(pairs.groupBy("_x").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("_salts")), "_x")
    salted = written(salted.withColumn("_salt", F.pmod(F.xxhash64("_y"), "_salts")), "salted-pairs")
    ids = guarded(written(pairs.select(F.explode(F.array("_x", "_y")).alias("_id")).distinct(), "pair-ids"), BROADCAST_ROWS)
    texts = docs.join(ids, "_id", "left_semi")
    heads = salted.select("_x", "_salt").distinct().withColumn("_id", F.col("_x"))
    rows = heads.join(texts, "_id").select("_x", "_salt", F.lit(0).alias("_role"), F.col("_id").alias("_y"), last)
    rows = rows.unionByName(salted.select("_x", "_salt", F.col("_y").alias("_id")).join(texts, "_id").select("_x", "_salt", F.lit(1).alias("_role"), F.col("_id").alias("_y"), last))
    kind = docs.schema["_id"].dataType
    arrow, name = to_arrow_type(kind), kind.simpleString()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "_x", "_salt").sortWithinPartitions("_x", "_salt", "_role")
    return ordered.mapInArrow(lambda b: check_batches(b, arrow, shingle, percent), f"_x {name}, _y {name}")


def star(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (_x, _y) of each list's heads and members: of every list and band of sizes the head is the document with most common
    values, as near copies of one text are nearest to it."""
    heads = lists.groupBy("_v", "_band").agg(F.min(F.struct((-F.col("_common")).alias("c"), "_id", "_n")).alias("_head"))
    members = lists.withColumn("_band", F.explode(bands()))
    both = members.join(heads, ["_v", "_band"]).select(F.col("_head._id").alias("_x"), F.col("_head._n").alias("_xn"), F.col("_id").alias("_y"), F.col("_n").alias("_yn"))
    return both.where((F.col("_x") != F.col("_y")) & sizes_fit("_xn", "_yn", percent)).select("_x", "_y").distinct()


def bands() -> Column:
    return F.array("_band", F.col("_band") - 1, F.col("_band") + 1)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("_x", "_y").alias("_x"), F.greatest("_x", "_y").alias("_y"))


def link_nodes(nodes: DataFrame, d: DataFrame, shingle: int, percent: int, k: int) -> DataFrame:
    """``nodes``: (_id, _n, _sk), ``d``: (_id, _text). Rows (_node, _comp) of all linked nodes.

    1. Every list is held against its heads.
    2. Short lists (under LONG_LIST) whose documents are in several components: pairs across these.
    3. Long lists whose documents are in several components: all their documents, linked or not, are compared by an
       exact prefix filter on the full sets (``full_links``), which keeps lists of common values out.
    """
    band = F.floor(F.log(F.col("_n")) / math.log(100 / percent)).cast("int")
    lists = written(prefixes(nodes, percent, k).withColumn("_band", band), "lists")

    def check(pairs: DataFrame, texts: DataFrame = d) -> DataFrame:
        return written(verified(written(likely(pairs, nodes, percent, k), "likely"), texts, shingle, percent), "links")

    def across(rows: DataFrame, tried: DataFrame) -> DataFrame:
        """Pairs of rows (_v, _id, _n, _band, _comp) of one list in different components."""
        a = rows.select("_v", F.col("_id").alias("_x"), F.col("_n").alias("_xn"), F.col("_comp").alias("_xc"), "_band")
        b = rows.select("_v", F.col("_id").alias("_y"), F.col("_n").alias("_yn"), F.col("_comp").alias("_yc"), F.explode(bands()).alias("_band"))
        pairs = a.join(b, ["_v", "_band"]).where((F.col("_xc") != F.col("_yc")) & sizes_fit("_xn", "_yn", percent))
        return written(ordered(pairs).distinct().join(ordered(tried), ["_x", "_y"], "left_anti"), "across")

    tried = written(star(lists, percent), "star")
    comp = components(check(tried))

    short = named(lists.where("not _long"), comp)
    mixed = short.groupBy("_v").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"), F.count(F.lit(1)).alias("_c")).where("_lo <> _hi and _c > 2").select("_v")
    rest = across(written(short.join(guarded(written(mixed, "mixed-lists"), BROADCAST_ROWS), "_v"), "open-lists"), tried)
    comp = merged(comp, check(rest))

    long = named(lists.where("_long"), comp).withColumn("_band", F.explode(bands()))
    mixed = long.groupBy("_v", "_band").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi")).where("_lo <> _hi").select("_v", "_band")
    ids = long.join(guarded(written(mixed, "mixed-lists"), BROADCAST_ROWS), ["_v", "_band"]).groupBy("_id").agg(F.max("_common").alias("_common"))
    ids = guarded(written(ids, "long-documents"), BROADCAST_ROWS)
    if ids.isEmpty():
        return comp
    full = full_sets(d.join(ids, "_id", "left_semi"), shingle)
    rows = written(full_prefixes(full, percent).join(ids, "_id").withColumn("_band", band), "full-lists")
    return full_links(rows, full.withColumn("_band", band), tried.unionByName(rest), comp, check, percent)


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp``: (_node, _comp) with the written links (_x, _y) added. Components are nodes of the new rounds, which cost as much as there is new."""
    at = {c: named(links.select(F.col(c).alias("_id")).distinct(), comp).select(F.col("_id").alias(c), F.col("_comp").alias(c + "c")) for c in ("_x", "_y")}
    new = components(links.join(at["_x"], "_x").join(at["_y"], "_y").select(F.col("_xc").alias("_x"), F.col("_yc").alias("_y")))
    to = guarded(new.select(F.col("_node").alias("_old"), F.col("_comp").alias("_new")), BROADCAST_ROWS)
    old = comp.withColumnRenamed("_comp", "_old").join(to, "_old", "left").select("_node", F.coalesce("_new", "_old").alias("_comp"))
    # What was alone until now.
    return written(old.unionByName(new.join(comp.select("_node"), "_node", "left_anti").select("_node", "_comp")), "components")


def named(df: DataFrame, comp: DataFrame) -> DataFrame:
    return df.join(comp.select(F.col("_node").alias("_id"), "_comp"), "_id", "left").withColumn("_comp", F.coalesce("_comp", "_id"))


def cheaper(at: DataFrame, full: DataFrame, comp: DataFrame, least: Column, percent: int) -> DataFrame:
    """Lists of the last comparison, (_v, _id, _n, _r, _band, _comp, _c, _asks). They are those of ``at`` and those of equal parts: either
    kind alone holds all pairs wanted. A document asks in the kind in which its lists are shorter (``_asks``) and is found in both."""
    sets = full.join(at.select("_id").distinct(), "_id", "left_semi").select("_id", "_n", "_band", "_sk")
    part = named(parts(sets, percent), comp)
    mixed = part.groupBy("_v").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"), F.count(F.lit(1)).alias("_c")).where("_lo <> _hi").select("_v", "_c")
    part = written(part.join(guarded(written(mixed, "mixed-parts"), BROADCAST_ROWS), "_v"), "open-parts")
    cost = at.where(least).groupBy("_id").agg(F.sum("_c").alias("_a")).join(part.where("_own").groupBy("_id").agg(F.sum("_c").alias("_b")), "_id", "left")
    cost = guarded(written(cost.select("_id", (F.col("_a") > F.coalesce("_b", F.lit(0))).alias("_by_parts")), "costs"), BROADCAST_ROWS)
    columns = ["_v", "_id", "_n", "_r", "_band", "_comp", "_c", "_asks"]
    a = at.join(cost, "_id", "left").withColumn("_asks", least & F.coalesce(~F.col("_by_parts"), F.lit(False))).select(columns)
    b = part.join(cost, "_id", "left").withColumn("_asks", F.col("_own") & F.coalesce("_by_parts", F.lit(False))).withColumn("_r", F.col("_n")).select(columns)
    return written(a.unionByName(b), "last-lists")


def full_links(rows: DataFrame, full: DataFrame, tried: DataFrame, comp: DataFrame, check: Callable[[DataFrame, DataFrame], DataFrame], percent: int) -> DataFrame:
    """``rows``: (_v, _id, _n, _r, _band, _common) of full prefixes, ``full``: (_id, _n, _band, _sk) their sets. The components once all
    pairs of one list that are in different ones, and that sizes and places in the lists don't rule out, have been checked.

    While these pairs are many, heads come first: one for each list and band, then four, then sixteen, out of components
    that have had none in the list. They join what belongs together at a cost in proportion to the documents. What they
    leave open is compared in lists, large ones in blocks: those of ``rows``, or, where common values make too many pairs of these,
    those of equal parts (``cheaper``).
    """
    heads, new, buckets = None, None, 1
    # Rows that may be the smaller set of a pair.
    least = (100 + percent) * F.col("_r") >= 2 * percent * F.col("_n")
    while True:
        at = named(rows, comp)
        each = at.groupBy("_v", "_comp").agg(F.count(F.lit(1)).alias("_c"))
        mixed = each.groupBy("_v").agg(F.sum("_c").alias("_c"), F.sum(F.col("_c") * F.col("_c")).alias("_q"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
        mixed = guarded(written(mixed.select("_v", "_c", ((F.col("_c") * F.col("_c") - F.col("_q")) / 2).alias("_pairs")), "mixed-lists"), BROADCAST_ROWS)
        at = written(at.join(mixed.select("_v", "_c"), "_v"), "open-lists")
        n, pairs = mixed.agg(F.coalesce(F.sum("_c"), F.lit(0)), F.coalesce(F.sum("_pairs"), F.lit(0))).first()
        if n == 0:
            return comp
        few = pairs <= PAIRS_A_ROW * n
        last = few or new == 0
        x = at
        if last:
            at = at.withColumn("_asks", least) if few else cheaper(at, full, comp, least, percent)
            x = at.where("_asks").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.floor(F.col("_c") / BLOCK))))
            y = at.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.floor(F.col("_c") / BLOCK) + 1))
        else:
            if heads is not None:
                x = at.join(named(heads, comp).select("_v", "_comp").distinct(), ["_v", "_comp"], "left_anti")
            x = x.groupBy("_v", "_band", F.pmod(F.xxhash64("_id"), F.lit(buckets)).alias("_b")).agg(F.min(F.struct((-F.col("_common")).alias("c"), "_id", "_n", "_r", "_comp")).alias("_h"))
            x = written(x.select("_v", "_band", "_h._id", "_h._n", "_h._r", "_h._comp"), "heads")
            heads = x.select("_v", "_id") if heads is None else heads.unionByName(x.select("_v", "_id"))
            # Heads are few; each meets every block of its list.
            x = x.join(mixed.select("_v", "_c"), "_v").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.floor(F.col("_c") / HEAD_BLOCK))))
            y = at.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.floor(F.col("_c") / HEAD_BLOCK) + 1))
            buckets *= 4
        x = x.select("_v", "_band", "_salt", F.col("_id").alias("_x"), F.col("_n").alias("_xn"), F.col("_r").alias("_xr"), F.col("_comp").alias("_xc"))
        y = y.select("_v", F.explode(bands()).alias("_band"), "_salt", F.col("_id").alias("_y"), F.col("_n").alias("_yn"), F.col("_r").alias("_yr"), F.col("_comp").alias("_yc"))
        # The first value that two sets share leaves no more of either than they can have in common.
        reach = (100 + percent) * F.least("_xr", "_yr") >= percent * (F.col("_xn") + F.col("_yn"))
        both = x.join(y, ["_v", "_band", "_salt"]).where((F.col("_xc") != F.col("_yc")) & sizes_fit("_xn", "_yn", percent) & reach)
        if last:
            both = both.where("_xn <= _yn")
        both = written(ordered(both).distinct().join(ordered(tried), ["_x", "_y"], "left_anti"), "across")
        found = check(both, full.select("_id", "_sk"))
        new = found.count()
        if new:
            comp = merged(comp, found)
        if last:
            return comp
        tried = tried.unionByName(both)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row: ``component_id`` is the least doc_id that links lead to,
    ``kept`` whether that is the row's own."""
    spark = docs.sparkSession
    importable(spark)
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    name = d.schema["_id"].dataType.simpleString()
    sk = written(d.mapInArrow(lambda b: sketch_batches(b, shingle, k), f"_id {name}, _n bigint, _f1 bigint, _f2 bigint, _sk array<bigint>"), "sketches")
    some = sk.where("_n > 0 and _id is not null")
    same = written(some.groupBy("_n", "_f1", "_f2").agg(F.min("_id").alias("_rep")), "equal-sets")
    nodes = written(some.join(guarded(same.select(F.col("_rep").alias("_id"), "_n", "_f1", "_f2"), BROADCAST_ROWS), ["_id", "_n", "_f1", "_f2"], "left_semi").select("_id", "_n", "_sk").dropDuplicates(["_id", "_n"]), "nodes")
    comp = link_nodes(nodes, d, shingle, percent, k)

    of = sk.select("_id", "_n", "_f1", "_f2").join(same, ["_n", "_f1", "_f2"], "left").join(comp.withColumnRenamed("_node", "_rep"), "_rep", "left")
    own = F.when((F.col("_n") == 0) | F.col("_id").isNull(), F.col("_id")).otherwise(F.coalesce("_comp", "_rep"))
    out = of.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), own.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, k: int = K) -> DataFrame:
    """The rows of ``docs``, with all their columns, of the least doc_id of each component."""
    seen = near_duplicates(docs, doc_id, text, shingle, percent, k)
    gone = guarded(written(seen.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "near-duplicates"), BROADCAST_ROWS)
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)

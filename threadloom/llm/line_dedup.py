"""Line dedup by a segment-partition edit join.

A line of at least MIN_CHARS characters goes if an equal line, or one of at least NEAR_CHARS within MAX_EDITS edits, stands earlier
(smaller doc_id, or higher up in the document).

Equal lines are found by two hashes. For near ones a line is split into MAX_EDITS + 1 segments: of two lines within that
many edits, one segment of the shorter stands unchanged in the longer. A line's segments are indexed by (length,
segment number, contents), and a line probes the indexes of its own length and of up to MAX_EDITS characters less, at the
few places that the edits left and right of a segment allow. A third of a short line is so short that it stands in very many
others: lines under LONG_CHARS are split into MAX_EDITS + 2 segments, two of which must stand unchanged, and indexed by the first
two that do. Only keys that two different lines share, one of them as an index, go on; they are found where all keys have been shuffled to, so
keys are made and shuffled once.

The lines of a key are a list. Each is first held against the list's earliest line, its head, which settles groups of near
copies at a cost in proportion to their size. What is left open isn't compared pair by pair: a line's place of first
difference from the list's most typical line splits the list (``typical``, ``deviations``), and only lines with the same place, or with equal repairs of such
differences, go on. Most candidates have too few of PARTS parts in common to be near each other; a bit-parallel automaton on a
band of 2 * MAX_EDITS + 1 diagonals verifies the rest.

DataFrame functions only.

Defined results: a null text stays null and has no lines; an empty one is one empty line; a document whose lines all go
keeps an empty text. Repeated rows are one document and lose the same lines. Rows that share a doc_id but not the text are
documents of their own, ordered by a hash of the text; a null doc_id comes first. Texts are split at ``\\n`` alone. All
other columns are kept as they are.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import narrowed, split_by, table, written

MIN_CHARS, NEAR_CHARS, MAX_EDITS = 20, 20, 2
#: Lines of fewer characters are indexed by pairs of segments.
LONG_CHARS = 40
#: Parts of a candidate, all but MAX_EDITS of which must stand in the other line: a character each at the least length.
PARTS = 20
#: Powers of two, from a length that no string has, by which a common prefix is measured.
STEPS = [1 << k for k in range(30, -1, -1)]
#: Beginnings of a line by which the most typical line of a list is found.
CUTS = 16


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """``docs``: (_id, _th, _text). A row (_id, _th, _no, _line, _len) for each line of at least ``min_chars`` characters."""
    every = docs.select("_id", "_th", F.posexplode_outer(F.split("_text", "\n")).alias("_no", "_line"))
    return every.withColumn("_len", F.length("_line")).where(F.col("_len") >= min_chars)


def hashes() -> list[Column]:
    return [F.xxhash64("_line").alias("_h"), F.xxhash64(F.lit(1), F.col("_line")).alias("_h2")]


def places(edits: int, pairs: bool) -> list[tuple]:
    """(less, i, si, j, sj): of a line with ``less`` characters less, in edits + 1 segments, segment i stands in a line within ``edits`` edits, moved by si;
    with ``pairs``, segments i and j (of edits + 2) are the first two that do. There are as many edits before a segment as it is moved, and one
    in each segment passed over. Index keys, nothing less and nothing moved, come first."""
    moves, parts = range(-edits, edits + 1), range(1, edits + 2 + pairs)
    if pairs:
        out = [
            (less, i, si, j, sj)
            for less in range(edits + 1) for i in parts for j in parts if i < j for si in moves for sj in moves
            if max(i - 1, abs(si)) + max(j - i - 1, abs(sj - si)) + abs(less - sj) <= edits
        ]
    else:
        # Of the segments that stand, one has no more edits before it than segments, and no more after it.
        out = [(less, i, si, 0, 0) for less in range(edits + 1) for i in parts for si in moves if abs(si) <= i - 1 and abs(less - si) <= len(parts) - i]
    return sorted(out, key=lambda x: (any((x[0], x[2], x[4])), x))


def keyed(docs: DataFrame, edits: int, least: int, long: int = LONG_CHARS) -> DataFrame:
    """(_key, _h, _x) for the lines long enough to have near ones; _x is a line's length, negative where it only probes. A line's places become rows before its keys are made of them,
    so keys are one compiled expression."""
    kinds = "array<struct<less:int,i:int,si:int,j:int,sj:int>>"
    singles, doubles = (F.array(*[F.struct(*map(F.lit, x)) for x in places(edits, p)]).cast(kinds) for p in (False, True))
    both = F.array(*[F.struct(*map(F.lit, x)) for p in (True, False) for x in places(edits, p)]).cast(kinds)
    n = F.col("_len")
    rows = lines_of(docs, least).withColumn("_h", F.xxhash64("_line"))
    rows = rows.select("_h", "_len", "_line", F.explode_outer(F.when(n < long, doubles).when(n < long + edits, both).otherwise(singles)).alias("_p"))
    rows = rows.select("_h", "_len", "_line", "_p.*", (n - F.col("_p.less")).alias("_m"))
    pair = F.col("j") > 0
    parts = F.when(pair, edits + 2).otherwise(edits + 1)
    end = lambda k: F.floor(F.col("_m") * k / parts).cast("int")
    at, size = end(F.col("i") - 1) + F.col("si"), end(F.col("i")) - end(F.col("i") - 1)
    at2, size2 = end(F.col("j") - 1) + F.col("sj"), end(F.col("j")) - end(F.col("j") - 1)
    fits = (F.col("_m") >= least) & (pair == (F.col("_m") < long)) & (at >= 0) & (at + size <= n) & (~pair | ((at2 >= 0) & (at2 + size2 <= n)))
    second = F.when(pair, F.col("_line").substr(at2 + 1, size2)).otherwise("")
    key = F.xxhash64("_m", "i", "j", F.col("_line").substr(at + 1, size), second)
    own = (F.col("less") == 0) & (F.col("si") == 0) & (F.col("sj") == 0)
    return rows.where(fits).select(key.alias("_key"), "_h", F.when(own, n).otherwise(-n).alias("_x"))


def shared_keys(keys: DataFrame) -> DataFrame:
    """``keys``: as of ``keyed``. (_key, _h, _len, _index), a row for each line of the keys that two different lines share, one of them as an index.
    Keys are made and shuffled once: what is counted and what is kept read the same partitions, and live keys meet their lines there."""
    keys = keys.repartition("_key")
    # The aggregate reads all columns, so that its shuffle is the other side's, too.
    live = keys.groupBy("_key").agg(F.min("_h").alias("_a"), F.max("_h").alias("_b"), F.max("_x").alias("_c")).where("_a <> _b and _c > 0").select("_key")
    most = keys.join(live.hint("shuffle_hash"), "_key").groupBy("_key", "_h").agg(F.max("_x").alias("_x"))
    return most.select("_key", "_h", F.abs("_x").alias("_len"), (F.col("_x") > 0).alias("_index"))


def within(a: str, b: str, edits: int) -> Column:
    """Whether two strings are within ``edits`` edits. Bit o of state d: some prefix of ``a`` that is o - edits longer than the
    part of ``b`` read so far is at most d edits from it."""
    band = 2 * edits + 1
    mask = (1 << band) - 1
    start = [1 << edits]
    for _ in range(edits):
        start.append((start[-1] | start[-1] << 1) & mask)

    def same_at(char: Column, j: Column) -> Column:
        bits = [F.when(F.get(a, j + (o - edits)) == char, 1 << o).otherwise(0) for o in range(band)]
        return functools.reduce(lambda x, y: x.bitwiseOR(y), bits)

    def step(state: Column, same: Column) -> Column:
        new = []
        for d in range(edits + 1):
            r = state[f"r{d}"].bitwiseAND(same)
            if d:
                old = state[f"r{d - 1}"]
                r = r.bitwiseOR(old).bitwiseOR(F.shiftright(old, 1)).bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(F.lit(mask))
            new.append(r)
        return F.struct(*[r.alias(f"r{d}") for d, r in enumerate(new)])

    first = F.struct(*[F.lit(r).alias(f"r{d}") for d, r in enumerate(start)])
    offset = F.size(a) - F.size(b) + edits
    # Characters are compared once for each place of ``b``, not anew wherever a state refers to them.
    last = F.aggregate(F.transform(b, same_at), first, step, lambda s: s[f"r{edits}"])
    return (offset >= 0) & (offset < band) & (F.floor(last / F.pow(F.lit(2), offset)) % 2 == 1)


def parts_in_common(a: str, b: str, edits: int, parts: int = PARTS) -> Column:
    """Whether all but ``edits`` of the parts of ``a`` stand in ``b``, moved by no more than ``edits`` places: so it is for any two strings within
    as many edits, as an edit changes one part at most. It is seldom so for others."""
    n, found = F.length(a), F.lit(0)
    for k in range(parts):
        at, to = F.floor(n * k / parts).cast("int"), F.floor(n * (k + 1) / parts).cast("int")
        near = F.col(b).substr(F.greatest(at - edits, F.lit(0)) + 1, to - at + 2 * edits)
        found = found + F.contains(near, F.col(a).substr(at + 1, to - at)).cast("int")
    return found >= parts - edits


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two strings."""
    room = F.least(F.length(a), F.length(b))
    same = lambda lo, n: (lo + n <= room) & (a.substr(lo + 1, n) == b.substr(lo + 1, n))
    steps = F.slice(F.array(*[F.lit(n) for n in STEPS]), F.lit(len(STEPS)) - F.floor(F.log2(F.greatest(room, F.lit(1)))).cast("int"), F.lit(len(STEPS)))
    return F.aggregate(steps, F.lit(0), lambda lo, n: F.when(same(lo, n), lo + n).otherwise(lo))


def verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The pairs (_x, _y) of line hashes whose lines (``texts``: _h, _line) are within ``edits`` edits, by the automaton. As that is
    interpreted, it is only asked about lines with enough parts in common."""
    a, b = texts.select(F.col("_h").alias("_x"), F.col("_line").alias("_la")), texts.select(F.col("_h").alias("_y"), F.col("_line").alias("_lb"))
    both = pairs.join(a, "_x").join(b, "_y").where(parts_in_common("_la", "_lb", edits))
    # Written, so that splitting into characters isn't moved into every step of the automaton.
    chars = written(both, "near-passed").select("_x", "_y", F.split("_la", "").alias("_a"), F.split("_lb", "").alias("_b"))
    return chars.withColumn("_ok", within("_a", "_b", edits) & (F.monotonically_increasing_id() >= 0)).where("_ok").select("_x", "_y")


def repairs(a: Column, head: Column, at: Column) -> Column:
    """The strings that one edit at the first difference from ``head`` (``at`` characters in) makes of ``a``: the head's character put in
    place of a's own, put before it, or a's own taken out."""
    start, rest, char = a.substr(F.lit(1), at), a.substr(at + 1, F.length(a)), head.substr(at + 1, F.lit(1))
    more, own = at < F.length(head), at < F.length(a)
    after = a.substr(at + 2, F.length(a))
    return F.array_compact(F.array(F.when(more & own, F.concat(start, char, after)), F.when(more, F.concat(start, char, rest)), F.when(own, F.concat(start, after))))


def deviations(line: Column, head: Column) -> Column:
    """Structs (u, s, p): after u repairs, the hash of the string and its first difference from the head (up to MAX_EDITS - 1 repairs).

    Take two lines within two edits that differ from the head first at places p < q. The second has the head's character at
    p, the first has not, so an optimal alignment edits the first at p towards the head: one of its repairs is within one
    edit of the second. By induction, repairs of the two, of no more than MAX_EDITS in all, either become equal or differ
    from the head at the same place.
    """
    own = F.array(F.struct(F.lit(0).alias("u"), line.alias("s"), common_prefix(line, head).alias("p")))
    once = F.flatten(F.transform(own, lambda x: F.transform(repairs(x["s"], head, x["p"]), lambda r: F.struct(F.lit(1).alias("u"), r.alias("s"), common_prefix(r, head).alias("p")))))
    twice = F.flatten(F.transform(once, lambda x: F.transform(repairs(x["s"], head, x["p"]), lambda r: F.struct(F.lit(2).alias("u"), r.alias("s"), F.lit(-1).alias("p")))))
    return F.transform(F.concat(own, once, twice), lambda x: F.struct(x["u"].alias("u"), F.xxhash64(x["s"]).alias("s"), x["p"].alias("p")))


def typical(rows: DataFrame) -> DataFrame:
    """``rows``: (_list, _h, _line). A row (_list, _head) for each list: the line that agrees with the list's commonest beginnings, of up to
    CUTS places, for most lines. Others then differ from it at places of their own, not all at one of its. Beginnings are only counted;
    a list's commonest ones, a row for each list, are what its lines meet."""
    cuts = [F.xxhash64(F.col("_line").substr(F.lit(1), F.floor(F.length("_line") * k / CUTS).cast("int"))) for k in range(1, CUTS)]
    shared = rows.select("_list", F.posexplode_outer(F.array(*cuts)).alias("_k", "_cut")).groupBy("_list", "_k", "_cut").agg(F.count(F.lit(1)).alias("_c"))
    common = shared.groupBy("_list", "_k").agg(F.max(F.struct("_c", "_cut")).alias("_m"))
    common = common.groupBy("_list").agg(*[F.max(F.when(F.col("_k") == k, F.col("_m"))).alias(f"_m{k}") for k in range(CUTS - 1)])
    score = functools.reduce(lambda x, y: x + y, [F.when(cut == F.col(f"_m{k}._cut"), F.col(f"_m{k}._c")).otherwise(0) for k, cut in enumerate(cuts)])
    return rows.join(common, "_list").groupBy("_list").agg(F.max(F.struct(score.alias("_c"), "_h")).alias("_top")).select("_list", F.col("_top._h").alias("_head"))


def star(lists: DataFrame, edits: int) -> DataFrame:
    """``lists``: (_list, _h, _len, _index, _first). Pairs (_x, _y) of each list's earliest line and its others."""
    heads = lists.groupBy("_list").agg(F.min(F.struct("_first", "_h", "_index", "_len")).alias("_head"))
    both = lists.join(heads, "_list").where((F.col("_h") != F.col("_head._h")) & (F.col("_index") | F.col("_head._index")) & (F.abs(F.col("_len") - F.col("_head._len")) <= edits))
    return both.select(F.col("_head._h").alias("_x"), F.col("_h").alias("_y")).distinct()


def spread(rows: DataFrame, on: str) -> DataFrame:
    """A row (_u, ``on``) for each different repaired string (``_s``) or place (``_p``) of the structs in ``_d``, next to the other columns."""
    some = F.filter("_d", lambda x: x["p"] >= 0) if on == "_p" else F.col("_d")
    some = F.array_distinct(F.transform(some, lambda x: F.struct(x["u"].alias("u"), x[on[1:]].alias("v"))))
    rows = rows.withColumn("_d", F.explode_outer(some))
    return rows.withColumn("_u", F.col("_d.u")).withColumn(on, F.col("_d.v")).drop("_d")


def within_lists(rows: DataFrame, on: str, edits: int) -> DataFrame:
    """``rows``: (_list, _h, _len, _index, _first, _open, _u and ``on``). Pairs (_x, _y) of open lines with earlier ones that are equal
    in ``on``, after no more repairs in all than there may be edits (equal strings) or one less (places)."""
    most = edits if on == "_s" else edits - 1
    y = rows.where("_open").select("_list", on, F.col("_h").alias("_y"), F.col("_len").alias("_yl"), F.col("_index").alias("_yi"), F.col("_first").alias("_yf"), F.col("_u").alias("_yu"))
    x = rows.select("_list", on, F.col("_h").alias("_x"), F.col("_len").alias("_xl"), F.col("_index").alias("_xi"), F.col("_first").alias("_xf"), F.col("_u").alias("_xu"))
    fits = (F.col("_xf") < F.col("_yf")) & (F.col("_xi") | F.col("_yi")) & (F.abs(F.col("_xl") - F.col("_yl")) <= edits) & (F.col("_xu") + F.col("_yu") <= most)
    return x.join(y, ["_list", on]).where(fits).select("_x", "_y")


def near_lines(docs: DataFrame, first: DataFrame, edits: int = MAX_EDITS, least: int = NEAR_CHARS) -> DataFrame:
    """Rows (_h, _h2) of the lines that have a near line before them. ``first``: (_h, _first) of all lines."""
    if edits != MAX_EDITS:
        raise ValueError(f"repairs are written out for {MAX_EDITS} edits")
    shared = written(shared_keys(keyed(docs, edits, least)), "shared-keys")
    ids = written(shared.select("_h").distinct(), "near-candidates")
    lines = lines_of(docs, least).select(*hashes(), "_line")
    # An inner join: a semi join would be moved below the one with the sieve, and shuffle all lines.
    texts = written(narrowed(lines, ids, "_h").join(ids, "_h").dropDuplicates(["_h", "_h2"]), "near-texts")
    at = written(narrowed(first, ids, "_h").join(ids, "_h").groupBy("_h").agg(F.min("_first").alias("_first")), "near-places")
    v = written(shared.join(at, "_h").withColumnRenamed("_key", "_list"), "near-lists")

    def settled(pairs: DataFrame) -> DataFrame:
        return written(verified(pairs, texts, edits).select(F.col("_y").alias("_h")).distinct(), "near-settled")

    first_star = written(star(v, edits), "near-star")
    done = settled(first_star)
    # Lists of three lines and more with a line that is neither head nor settled. All of their lines but the head go on.
    size = v.groupBy("_list").agg(F.count(F.lit(1)).alias("_c"), F.min(F.struct("_first", "_h")).alias("_top")).where("_c > 2")
    rest = v.join(size.select("_list", F.col("_top._h").alias("_top")), "_list").where("_h <> _top").drop("_top")
    rest = rest.join(done.withColumn("_done", F.lit(True)), "_h", "left").withColumn("_open", F.col("_done").isNull())
    rest = written(rest.drop("_done"), "near-rest")
    rest = rest.join(rest.where("_open").select("_list").distinct(), "_list", "left_semi")
    rest = written(rest.join(texts.select("_h", "_line"), "_h"), "near-rest")
    heads = typical(rest).join(texts.select(F.col("_h").alias("_head"), F.col("_line").alias("_top")), "_head")
    rest = rest.join(heads, "_list")
    rest = written(rest.select("_list", "_h", "_len", "_index", "_first", "_open", deviations(F.col("_line"), F.col("_top")).alias("_d")), "near-deviations")
    # Lines that leave the typical line at the same place are lists again.
    places = spread(rest, "_p").withColumn("_list", F.xxhash64("_list", "_p"))
    again = written(star(places, edits).join(first_star, ["_x", "_y"], "left_anti").join(done, F.col("_y") == F.col("_h"), "left_anti"), "near-star")
    done = written(done.unionByName(settled(again)).distinct(), "near-settled")
    still = rest.where("_open").select("_h").distinct().join(done, "_h", "left_anti").withColumn("_still", F.lit(True))
    rest = written(rest.join(still, "_h", "left").withColumn("_open", F.coalesce("_still", F.lit(False))).drop("_still"), "near-open")
    pairs = within_lists(spread(rest, "_s"), "_s", edits).unionByName(within_lists(spread(rest, "_p"), "_p", edits)).distinct()
    pairs = pairs.join(first_star, ["_x", "_y"], "left_anti").join(again, ["_x", "_y"], "left_anti")
    done = done.unionByName(settled(written(pairs, "near-pairs")))
    return written(texts.join(done.distinct(), "_h", "left_semi").select("_h", "_h2"), "near-lines")


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """``docs``: (_id, _th, _text). A row (_rid, _rth, _gone) for each document that loses lines, with their numbers from 0."""
    rows = lines_of(docs, min_chars).select("_id", "_th", "_no", *hashes())
    place = F.struct("_id", "_th", "_no")
    first = written(rows.groupBy("_h", "_h2").agg(F.min(place).alias("_first"), (F.max(place) != F.min(place)).alias("_more")), "first-lines")
    hit = first.where("_more").select("_h", "_h2", "_first", F.lit(False).alias("_near"))
    if edits:
        near = near_lines(docs, first.select("_h", "_first"), edits, near_chars)
        hit = hit.unionByName(narrowed(first, near, "_h").join(near, ["_h", "_h2"]).select("_h", "_h2", "_first", F.lit(True).alias("_near")))
    hit = written(hit, "repeated-lines")
    gone = narrowed(rows, hit, "_h").join(hit, ["_h", "_h2"]).where(F.col("_near") | (place != F.col("_first")))
    return written(gone.groupBy(F.col("_id").alias("_rid"), F.col("_th").alias("_rth")).agg(F.collect_set("_no").alias("_gone")), "removed-lines")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """The rows of ``docs`` with all their columns, ``text`` without its removed lines; with ``counts`` also ``n_lines`` and
    ``n_removed`` (long)."""
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    gone = removed_lines(docs.select(F.col(doc_id).alias("_id"), own.alias("_th"), F.col(text).alias("_text")), min_chars, near_chars, edits)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(doc_id).alias("_id"), own.alias("_th"))
    d = d.withColumn("_doc", F.xxhash64("_id", "_th"))
    touched, whole = split_by(d, gone.select(F.xxhash64("_rid", "_rth").alias("_doc")), "_doc")
    # One kind of join at any size: both sides grow with the corpus.
    out = touched.join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left").select("_row", "_gone")
    out = out.unionByName(whole.select("_row", F.lit(None).cast("array<int>").alias("_gone"))).withColumn("_lines", F.split(F.col(f"_row.`{text}`"), "\n"))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")))
    old = F.col(f"_row.`{text}`")
    kept = F.when(F.col("_gone").isNull() | F.col("_lines").isNull(), old).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    cols = [(kept if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    if counts:
        cols += [F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"), F.when(F.col("_lines").isNull() | F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed")]
    return out.select(*cols)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def sql(source: str = "documents", measured: bool = False) -> str:
    """The query's SQL. That a segment of the shorter line stands in the longer only spares DuckDB distances."""
    part = "length(a.l) // 3"
    ctes = f"""
li AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS no, unnest(w) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM {source} WHERE text IS NOT NULL)),
fi AS (SELECT l, length(l) AS n, min(row(doc_id, no)) AS f FROM li WHERE length(l) >= {MIN_CHARS} GROUP BY l),
near AS (SELECT DISTINCT CASE WHEN a.f < b.f THEN b.l ELSE a.l END AS l FROM fi a JOIN fi b ON a.n >= {NEAR_CHARS} AND b.n >= a.n AND b.n <= a.n + {MAX_EDITS} AND a.l <> b.l
  WHERE (contains(b.l, substr(a.l, 1, {part})) OR contains(b.l, substr(a.l, 1 + {part}, {part})) OR contains(b.l, substr(a.l, 1 + 2 * ({part}))))
  AND levenshtein(a.l, b.l) <= {MAX_EDITS}),
gone AS (SELECT li.doc_id, li.no FROM li JOIN fi USING (l) LEFT JOIN near ON near.l = li.l WHERE near.l IS NOT NULL OR row(li.doc_id, li.no) <> fi.f),
kept AS (SELECT li.doc_id, string_agg(li.l, chr(10) ORDER BY li.no) AS t FROM li ANTI JOIN gone ON gone.doc_id = li.doc_id AND gone.no = li.no GROUP BY li.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)""".strip()
    if measured:
        return ctes
    return f"""WITH {ctes}
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.t, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines, coalesce(lost.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN lost ON lost.doc_id = d.doc_id"""

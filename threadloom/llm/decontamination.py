"""Benchmark decontamination by winnowing.

Of each run of SPAN - GRAM + 1 consecutive GRAM-word hashes the least is kept as a fingerprint, in documents and in
benchmark items alike. Two texts that share SPAN words in a row share all hashes of that run and so its least one: no
shared span is missed. Fingerprints are joined; for documents with a hit, the windows whose fingerprint matched are
compared in whole (two hashes of all SPAN words), and the words inside matching windows are counted once.
Items of fewer than SPAN words are one window each. Winnowing promises nothing for those, so documents are compared with
them by all windows of these few lengths, in one pass for all of them.

DataFrame functions only. Arrays are exploded with ``explode_outer``: for ``explode`` the optimizer adds a filter on the
array, which it would compute a second time, with all that it is made of written out in place. Documents are exploded into distinct fingerprints, never into pairs: a passage that stands in a
third of all documents is a row for each of them.

Defined results: a null or empty text, of a document or an item, has no words; an item without an id marks words but isn't
listed; rows that share a doc_id but not the text are documents of their own, and repeated rows get equal results; an empty table gives
an empty one; a text may be of any length that fits a row; a window that stands in several items counts for each of them; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import LOWER, NON_WORD_RUN, UPPER, ascii_lower, guarded, narrowed, table, written

SPAN, GRAM = 10, 5
#: Rows of a table of two or three longs that may be broadcast: some 16 MB.
BROADCAST_ROWS = 400_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD_RUN), "")


def gram_hashes(w: str, n: int) -> Column:
    """Hashes of all windows of n words of the array column ``w``."""
    every = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]))
    return F.slice(every, 1, F.greatest(F.size(w) - (n - 1), F.lit(0)))


def whole(words: list[Column], salt: int = 0) -> list[Column]:
    """Two hashes of a run of words; with words of one item or window alone, 128 bits tell it from all others."""
    return [F.xxhash64(F.lit(salt), *words).alias("_h"), F.xxhash64(*words, F.lit(salt + 1)).alias("_h2")]


def winnow(grams: str, run: int) -> Column:
    """The least hash of each run of ``run`` consecutive ones in the array column ``grams``."""
    least = F.transform(grams, lambda x, i: F.least(x, *[F.get(grams, i + k) for k in range(1, run)]))
    return F.slice(least, 1, F.greatest(F.size(grams) - (run - 1), F.lit(0)))


def looked_up(df: DataFrame, found: DataFrame, on: list[str], key: str) -> DataFrame:
    """``df`` joined with a written table of narrow rows: broadcast if it is small, else a shuffle of what passes a bitmap of the hashes ``key``."""
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(found), on)
    return narrowed(df, found, key).join(found, on)


def matches(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs``: (_id, _text), ``items``: (_item, _itext). A row (_id, _at, _len, _item) for each place of a window in a document."""
    run = span - gram + 1
    it = items.select("_item", words(F.col("_itext")).alias("_iw")).where(F.size("_iw") > 0)
    it = it.withColumn("_g", gram_hashes("_iw", gram)).withColumn("_least", winnow("_g", run))
    long_items = it.where(F.size("_iw") >= span).select("_item", "_iw", F.posexplode_outer("_least").alias("_i", "_p")).where("_p is not null")
    windows = written(long_items.select("_item", "_p", *whole([F.get("_iw", F.col("_i") + k) for k in range(span)])).distinct(), "item-windows")
    prints = written(windows.select("_p").distinct(), "item-prints")

    w = docs.select("_id", words(F.col("_text")).alias("_w"))
    own = w.withColumn("_g", gram_hashes("_w", gram)).select("_id", F.array_distinct(winnow("_g", run)).alias("_ps"))
    hit = looked_up(own.select("_id", F.explode_outer("_ps").alias("_p")), prints, ["_p"], "_p")
    # A document has few fingerprints that match; the set is bounded by its own text.
    hit = written(hit.groupBy("_id").agg(F.collect_set("_p").alias("_hits")), "hit-documents")
    few = hit.agg(F.coalesce(F.sum(F.size("_hits") + 1), F.lit(0))).first()[0] <= BROADCAST_ROWS
    again = docs.withColumnRenamed("_id", "_id0").join(F.broadcast(hit) if few else hit, F.col("_id0").eqNullSafe(F.col("_id"))).drop("_id0")
    again = again.select("_id", "_hits", words(F.col("_text")).alias("_w"))
    again = again.withColumn("_g", gram_hashes("_w", gram)).withColumn("_least", winnow("_g", run))
    places = again.select("_id", "_w", F.explode_outer(F.filter(F.transform("_least", lambda p, i: F.when(F.array_contains("_hits", p), i)), lambda i: i.isNotNull())).alias("_at")).where("_at is not null")
    places = places.select("_id", "_at", *whole([F.get("_w", F.col("_at") + k) for k in range(span)]))
    found = looked_up(places, written(windows.select("_h", "_h2", "_item").distinct(), "item-full"), ["_h", "_h2"], "_h").select("_id", "_at", F.lit(span).alias("_len"), "_item")

    joined = F.array_join("_iw", " ")
    short = it.where(F.size("_iw") < span).select("_item", F.size("_iw").alias("_len"), *whole([joined], 7)).distinct()
    short = written(short, "item-short")
    lengths = sorted(r[0] for r in short.select("_len").distinct().collect())  # at most SPAN - 1
    if not lengths:
        return found
    every = docs.select("_id", words(F.col("_text")).alias("_w"))
    every = every.select("_id", F.explode_outer(F.concat(*[_windows("_w", n) for n in lengths])).alias("_x")).select("_id", "_x.*")
    return found.unionByName(looked_up(every, short, ["_len", "_h", "_h2"], "_h").select("_id", "_at", "_len", "_item"))


def _windows(w: str, n: int) -> Column:
    """Structs (_len, _at, _h, _h2) of all windows of n words."""
    def one(x, i):
        text = F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, n)])
        return F.struct(F.lit(n).alias("_len"), i.alias("_at"), *whole([text], 7))

    return F.slice(F.transform(w, one), 1, F.greatest(F.size(w) - (n - 1), F.lit(0)))


def own(doc_id: str, text: str) -> Column:
    """What tells documents apart: the id and a hash of the text."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"))


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``_id, _n_hit, _n_items, _items`` (sorted strings, comma-joined) of the documents with a hit."""
    m = matches(docs, items, span, gram)
    per = m.groupBy("_id").agg(
        F.array_sort(F.collect_set(F.struct("_at", (F.col("_at") + F.col("_len")).alias("_end")))).alias("_spans"),
        F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("_items"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    count = F.aggregate("_spans", zero, lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["_end"] - F.greatest(s["_at"], a["to"]))).alias("n"), F.greatest(a["to"], s["_end"]).alias("to")), lambda a: a["n"])
    return per.select("_id", count.cast("long").alias("_n_hit"), F.size("_items").cast("long").alias("_n_items"), F.array_join("_items", ",").alias("_items"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` for each row of ``docs``."""
    d = docs.select(own(doc_id, text).alias("_id"), F.col(text).alias("_text"))
    c = contamination(d, items.select(F.col(item_id).alias("_item"), F.col(item_text).alias("_itext")), span, gram).withColumnRenamed("_id", "_hit_id")
    base = d.select("_id", F.size(words(F.col("_text"))).cast("long").alias("n_words"))
    out = base.join(c, F.col("_id").eqNullSafe(F.col("_hit_id")), "left")
    n = F.coalesce("_n_hit", F.lit(0).cast("long"))
    return out.select(F.col("_id.id").alias("doc_id"), "n_words", n.alias("n_hit"), F.coalesce("_n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("_items", F.lit("")).alias("items"), (n > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with an item."""
    c = contamination(docs.select(own(doc_id, text).alias("_id"), F.col(text).alias("_text")), items.select(F.col("item_id").alias("_item"), F.col("text").alias("_itext")))
    gone = guarded(written(c.select("_id"), "contaminated"), BROADCAST_ROWS)
    return docs.join(gone, own(doc_id, text).eqNullSafe(gone["_id"]), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


def sql() -> str:
    cut = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS th, {cut} AS w FROM documents),
b AS (SELECT item_id, w, least({SPAN}, len(w)) AS n FROM (SELECT item_id, {cut} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dw AS (SELECT doc_id, th, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, th, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, th, item_id, i, n FROM dw JOIN bw USING (n, g)),
word AS (SELECT doc_id, th, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, th, i, unnest(range(0, n)) AS k FROM hit) GROUP BY doc_id, th),
item AS (SELECT doc_id, th, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY doc_id, th)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id, th) LEFT JOIN item USING (doc_id, th)
""".strip()

"""Collocations: phrases of two to four words whose parts go together more often than chance would have it.

Counts come from word-id suffix arrays. A task gathers texts up to a shard of bounded size, numbers its words, and sorts all
suffixes by prefix doubling in numpy: ranks of one word, of two, of four. Where neighbours in that order share n words they lie in one
LCP interval of depth n, and an interval's length is the shard's count of its phrase. A shard therefore emits one row for each
distinct phrase, and rows of all shards are merged by key. The language of a text is part of a word's rank, so a shard may hold any
mixture of languages, and a hot language is spread over all tasks.

Texts are passed three times: single words, then pairs of frequent words, then triples and quadruples all of whose pairs are
frequent (a phrase is never more frequent than a part of it). What is frequent reaches the tasks as a bitmap over hashes, whose size
follows the number of keys up to a stated limit. A bitmap only ever lets too much through: counts are of whole phrases by their
text, and exact at any size. Beyond its limit more rows are shuffled, none is lost.

Defined results: a null text has no words; a null language is ``und``, together with that very value; repeated rows count each;
phrases never cross a separator or a text; texts of any length are taken in whole, long ones cut into shards between pieces;
ties of cuts go to the shorter first part, ties of phrases to their bytes; an empty table gives an empty one; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import importable, table, written

#: Phrases have at most so many words.
LONGEST = 4
MIN_COUNT, TOP, SCALE, COVER = 30, 2000, 2_000_000, 80
#: Bytes of text of a shard, from which its arrays take some 15 times as much.
SHARD_BYTES = 4 << 20
#: Bits of a bitmap: sixteen for each key, within these powers of two (7 at least).
SIEVE_BITS = (16, 27)
#: Separators of pieces become a line feed, a tab a space; everything else stays.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
TO_BLANKS = bytes.maketrans(SEPARATORS + b"\t", b"\n" * len(SEPARATORS) + b" ")
#: Copies of a part's count, to spread a part that stands in very many phrases.
SALTS = 8
ROWS = "lang string, phrase string, c bigint"


# --- one shard -----------------------------------------------------------------------------------------------------------


class Words:
    """A shard's words: ``ids`` from 0 into ``vocabulary`` (bytes), the text each stands in, and how many words its piece still has
    from it on, itself included, up to LONGEST."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts).lower().translate(TO_BLANKS)
        buf = np.frombuffer(data, np.uint8)
        blank = (buf == 32) | (buf == 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        starts, ends = edge[0::2], edge[1::2]
        letters = np.ascontiguousarray(buf[~blank])
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        self.ids, self.vocabulary = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
        piece = np.searchsorted(np.flatnonzero(buf == 10), starts)
        firsts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.text = np.searchsorted(firsts, starts, side="right") - 1
        self.left = np.ones(len(starts), np.int64)
        for d in range(1, LONGEST):
            self.left[:-d] += piece[d:] == piece[:-d]


def shifted(a: np.ndarray, d: int) -> np.ndarray:
    return np.concatenate([a[d:], np.zeros(min(d, len(a)), a.dtype)])


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 1."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


def suffix_ranks(first: np.ndarray, left: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks (from 1) of the suffixes by their first 1, 2, 4, ... words, until ``depth`` is reached. What lies beyond a piece's end ranks
    as 0, before all words."""
    ranks, width = [first], 1
    while width < depth:
        after = np.where(left > width, shifted(ranks[-1], width), 0)
        ranks.append(dense(ranks[-1] * (after.max(initial=0) + 1) + after))
        width *= 2
    return ranks


def lcp(order: np.ndarray, ranks: list[np.ndarray], left: np.ndarray, depth: int) -> np.ndarray:
    """How many words, up to ``depth``, a suffix shares with the one before it in the order; 0 for the first."""
    x, y = order[:-1], order[1:]
    shared = np.zeros(len(y), np.int64)
    for n in range(1, depth + 1):
        # words 1..n agree if those of a power of two do that fits in n, from the start and up to the end
        k = n.bit_length() - 1
        far = n - (1 << k)
        same = (ranks[k][x] == ranks[k][y]) & (ranks[k][np.minimum(x + far, len(left) - 1)] == ranks[k][np.minimum(y + far, len(left) - 1)])
        same &= (left[x] >= n) & (left[y] >= n)
        shared[same] = n
    return np.concatenate([[0], shared])


def intervals(order: np.ndarray, common: np.ndarray, left: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The LCP intervals of depth ``n``: a suffix of each, and its length."""
    begins = np.flatnonzero(common < n)
    sizes = np.diff(np.append(begins, len(order)))
    at = order[begins]
    whole = left[at] >= n
    return at[whole], sizes[whole]


# --- hashes and bitmaps --------------------------------------------------------------------------------------------------


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in their order."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def member(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap (64-bit words, a power of two of them) has a hash's bit; see ``bitmap``."""
    word = h >> np.uint64(64 - (len(bits).bit_length() - 1))
    return (bits[word.astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) != 0


def phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of (lang, phrase), phrases of one word or two, as ``shard_rows`` looks them up."""
    for b in batches:
        out = np.zeros(b.num_rows, np.uint64)
        for k, (lang, phrase) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            first, *rest = word_hashes(phrase.encode().split(b" "), [lang] * 2)
            out[k] = mixed(np.array([first], np.uint64), np.array(rest, np.uint64))[0] if rest else first
        yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["h"])


def word_hashes(words: list[bytes], langs: list[str]) -> list[int]:
    from xxhash import xxh64_intdigest

    seeds = {x: xxh64_intdigest(x.encode()) for x in set(langs)}
    return [xxh64_intdigest(w, seeds[x]) for w, x in zip(words, langs)]


def bitmap(keys: DataFrame, limits: tuple[int, int] = SIEVE_BITS) -> np.ndarray:
    """The bits of the hashes of a written table's phrases (columns lang, phrase), gathered by word on the executors. Its size is bounded
    by ``limits``."""
    power = min(max(int(keys.count() * 16).bit_length(), limits[0]), limits[1])
    out = np.zeros(1 << (power - 6), np.uint64)
    h = keys.select("lang", "phrase").mapInArrow(phrase_hashes, "h bigint")
    got = h.groupBy(F.expr(f"shiftrightunsigned(h, {64 - (power - 6)})").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b")).toArrow()
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return out


# --- passes over the texts -----------------------------------------------------------------------------------------------


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts with their languages, up to about ``size`` bytes at a time; longer texts are cut where pieces end."""
    texts, langs, held = [], [], 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            for part in parts(text or b"", size):
                texts.append(part)
                langs.append(lang)
                held += len(part)
                if held >= size:
                    yield texts, langs
                    texts, langs, held = [], [], 0
    if held:
        yield texts, langs


def parts(text: bytes, size: int) -> Iterator[bytes]:
    if len(text) <= size:
        if text:
            yield text
        return
    blank = text.translate(TO_BLANKS)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else blank.find(b"\n", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def shard_rows(texts: list[bytes], langs: list[str], sizes: tuple[int, ...], frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the shard's phrases of ``sizes`` words. ``frequent`` is a bitmap of words (for pairs) or of pairs (for more), of which all
    of a phrase's must be in it. With single words come rows without phrase: the number of words of each language."""
    w = Words(texts)
    if not len(w.ids):
        return
    names = sorted(set(langs))
    numbers = {x: k for k, x in enumerate(names)}
    code = np.array([numbers[x] for x in langs])
    lang, depth = code[w.text], max(sizes)
    distinct, first = np.unique(lang * len(w.vocabulary) + w.ids, return_inverse=True)
    first = first.astype(np.int64) + 1
    ranks = suffix_ranks(first, w.left, depth)
    order = np.argsort(ranks[-1], kind="stable")
    common = lcp(order, ranks, w.left, depth)
    passes = None
    if frequent is not None:
        spelled = w.vocabulary.take(pa.array(distinct % len(w.vocabulary))).to_pylist()
        hashes = np.array(word_hashes(spelled, [names[k] for k in distinct // len(w.vocabulary)]), np.uint64)[first - 1]
        keys = hashes if sizes == (2,) else np.where(w.left > 1, mixed(hashes, shifted(hashes, 1)), np.uint64(0))
        passes = member(frequent, keys)
    lang_names = pa.array(names, pa.string())

    def rows(lang_codes, phrase, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang_names.take(pa.array(lang_codes)), phrase, pa.array(c)], ["lang", "phrase", "c"])

    for n in sizes:
        at, count = intervals(order, common, w.left, n)
        if passes is not None:
            inner = 2 if n == 2 else n - 1  # so many words, or pairs, a phrase has
            keep = np.ones(len(at), bool)
            for d in range(inner):
                keep &= passes[at + d]
            at, count = at[keep], count[keep]
        if not len(at):
            continue
        for k in range(0, len(at), 100_000):
            a, c = at[k : k + 100_000], count[k : k + 100_000]
            words = [w.vocabulary.take(pa.array(w.ids[a + d])).cast(pa.string()) for d in range(n)]
            yield rows(lang[a], words[0] if n == 1 else pc.binary_join_element_wise(*words, " "), c)
    if sizes == (1,):
        codes, c = np.unique(lang, return_counts=True)
        yield rows(codes, pa.nulls(len(codes), pa.string()), c)


def phrase_counts(docs: DataFrame, sizes: tuple[int, ...], frequent=None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, phrase, c`` over all texts (columns _lang, _text): the phrases of ``sizes`` words. ``frequent`` is a broadcast bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in shards(batches, shard_bytes):
            yield from shard_rows(texts, langs, sizes, None if frequent is None else frequent.value)

    return docs.mapInArrow(run, ROWS).groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


# --- scores --------------------------------------------------------------------------------------------------------------


def exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """``counts``: lang, phrase, k (words), c, all phrases that occur often enough, single words too. A row for each of more words: the
    lowest of its cuts' scores, with the counts of the two parts. Joins of phrases are by sorting: a compressed table of them looks small enough
    to broadcast, and is many times as large in memory."""
    long = counts.where("k > 1").select("lang", "phrase", "c", F.split("phrase", " ").alias("_w"))
    cut = long.select("lang", "phrase", "c", F.explode(F.expr("transform(sequence(1, size(_w) - 1), i -> named_struct('cut', i, 'first', array_join(slice(_w, 1, i), ' '), 'rest', array_join(slice(_w, i + 1, size(_w)), ' ')))")).alias("_x")).select("lang", "phrase", "c", "_x.*")
    sides = cut.select("lang", "phrase", "c", "cut", F.explode(F.expr("array(struct(true as left, first as part), struct(false as left, rest as part))")).alias("_s")).select("lang", "phrase", "c", "cut", "_s.*")
    sides = sides.withColumn("_salt", F.expr(f"cast(pmod(xxhash64(phrase, cut), {SALTS}) as int)"))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("c").alias("_n"), F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("_salt"))
    both = sides.hint("merge").join(known, ["lang", "part", "_salt"]).groupBy("lang", "phrase", "cut").agg(F.first("c").alias("a"), F.max(F.expr("if(left, _n, null)")).alias("l"), F.max(F.expr("if(left, null, _n)")).alias("r"))
    score = F.expr(f"cast((cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("_b"))
    return best.select("lang", "phrase", "a", "_b.l", "_b.r", "_b.score")


def covered(counts: DataFrame, cover: int) -> DataFrame:
    """``lang, phrase`` of those that lie within a longer phrase with at least ``cover`` percent of their count."""
    longer = counts.where("k > 2").select("lang", "c", "k", F.split("phrase", " ").alias("_w"))
    spans = "flatten(transform(sequence(2, k - 1), n -> transform(sequence(1, k - n + 1), i -> array_join(slice(_w, i, n), ' '))))"
    inside = longer.select("lang", "c", F.explode(F.expr(spans)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("c").alias("_longer"))
    both = inside.hint("merge").join(counts.where("k > 1").select("lang", "phrase", "c"), ["lang", "phrase"])
    return both.where(exact(F.col("_longer")) * 100 >= exact(F.col("c")) * cover).select("lang", "phrase")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, cover: int = COVER, shard_bytes: int = SHARD_BYTES, sieve_bits: tuple[int, int] = SIEVE_BITS) -> DataFrame:
    """Each language's ``top`` phrases by score: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    importable(spark)
    d = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"), F.col(text).cast("string").alias("_text"))

    def counted(sizes: tuple[int, ...], frequent: np.ndarray | None, name: str) -> DataFrame:
        bits = None if frequent is None else spark.sparkContext.broadcast(frequent)
        return written(phrase_counts(d, sizes, bits, shard_bytes).where(F.col("phrase").isNull() | (F.col("c") >= min_count)), name)

    single = counted((1,), None, "words")
    words, totals = single.where("phrase is not null"), single.where("phrase is null").select("lang", F.col("c").alias("n"))
    pairs = counted((2,), bitmap(words, sieve_bits), "pairs")
    more = counted((3, 4), bitmap(pairs, sieve_bits), "phrases")
    counts = words.union(pairs).union(more).select("lang", "phrase", F.expr("size(split(phrase, ' '))").alias("k"), "c")
    kept = scored(counts).hint("merge").join(covered(counts, cover), ["lang", "phrase"], "left_anti")
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def sql() -> str:
    """The same over a table ``documents``, phrase by phrase."""
    return f"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) piece from documents
), worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') w from pieces
), total as (
  select lang, cast(sum(len(w)) as bigint) n from worded group by lang
), grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) phrase
  from worded, (select unnest([1, 2, 3, 4]) k) where len(w) >= k
), f as (
  select lang, k, phrase, cast(count(*) as bigint) c from grams group by all having count(*) >= {MIN_COUNT}
), cuts as (
  select lang, phrase, k, c a, i, array_to_string(list_slice(string_split(phrase, ' '), 1, i), ' ') p, array_to_string(list_slice(string_split(phrase, ' '), i + 1, k), ' ') q
  from f, (select unnest([1, 2, 3]) i) where k > 1 and i < k
), scores as (
  select c.lang, c.phrase, c.k, c.a, c.i, x.c l, y.c r, cast((({SCALE})::hugeint * c.a) // (x.c::hugeint + y.c) as bigint) score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.p join f y on y.lang = c.lang and y.phrase = c.q
), best as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, i) = 1
), inner_spans as (
  select distinct lang, c, array_to_string(list_slice(string_split(phrase, ' '), i, i + n - 1), ' ') phrase
  from f, (select unnest([2, 3]) n), (select unnest([1, 2, 3]) i) where k > n and i + n - 1 <= k
), hidden as (
  select distinct b.lang, b.phrase from best b join inner_spans s on s.lang = b.lang and s.phrase = b.phrase where 100::hugeint * s.c >= {COVER}::hugeint * b.a
)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)) as rank, b.phrase, a, l, r, n, score
from best b join total t on t.lang = b.lang
where not exists (select 1 from hidden h where h.lang = b.lang and h.phrase = b.phrase)
qualify row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)) <= {TOP}
"""

"""The corpus operators on small fixtures, against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tokenizers")
from threadloom.llm import decontamination, language_id, licenses, line_dedup, minhash, packing, quality, repeats, run_index, shingles, token_counts, url_filter  # noqa: E402

DOCS = "doc_id long, text string, _id string, n_words string, kept string"


def frame(spark, texts, first=1):
    """Documents with clashing further columns."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts, first)], DOCS)


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- near-duplicates ---------------------------------------------------------------------------------------------------------


def shingle_set(t, k):
    w = re.findall("[^\x20\x09-\x0D]+", fold(t))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(texts, k, percent):
    sets, parent = {i: shingle_set(t, k) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"q{r.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates(spark):
    base, other = prose(150, 1), prose(60, 2)
    line = prose(20, 99)
    texts = [base, base.upper(), base + " tail", edited(base, 2, 3), edited(base, 30, 4), other, None, "", " \t\n", "one two", "ONE two", "a", "one two three", other + " x", "x" * 5000, "NBSP\u00a0word here now"]
    texts += [edited(base, k % 5, 100 + k) for k in range(70)] + [prose(15, 200 + k) + " " + line for k in range(60)]
    got = rows(minhash.near_duplicates(frame(spark, texts), shingle=3, percent=85))
    want = brute_components(dict(enumerate(texts, 1)), 3, 85)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_duplicate_families_that_share_lines(spark):
    """Two families of near copies around the same common text, and lone documents: more than one round of heads."""
    shared = prose(120, 7)
    texts = [edited(f"{shared} {prose(60, 50 + f)}", k % 3, 1000 * f + k) for f in range(2) for k in range(60)] + [edited(shared, 14, 5000 + k) for k in range(10)]
    got = rows(minhash.near_duplicates(frame(spark, texts), shingle=3, percent=85))
    want = brute_components(dict(enumerate(texts, 1)), 3, 85)
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_bridge_of_two_large_families(spark):
    """Two families of more than LONG_LIST; each has a member near its head, and only these two are near each other."""
    body, a, b = prose(110, 131), prose(18, 132), prose(18, 133)
    texts = [f"{body} {own} u{k}" for own in (a, b) for k in range(60)] + [f"{body} {' '.join(own.split()[:2])}" for own in (a, b)]
    got = rows(minhash.near_duplicates(frame(spark, texts), shingle=3, percent=85))
    want = brute_components(dict(enumerate(texts, 1)), 3, 85)
    assert {c for _, c in want.values()} == {1}
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_that_share_a_common_passage(spark, monkeypatch):
    """The last text is near the one before it alone; the passage in which these differ from the others stands in more than
    LONG_LIST (lowered here) documents of another family."""
    monkeypatch.setattr(minhash, "LONG_LIST", 6)
    body, other, passage = prose(300, 2041), prose(300, 2042), prose(20, 2043)
    texts = [edited(f"{body} {prose(20, 44)}", k % 2, 6000 + k) for k in range(20)] + [edited(other, k % 2, 7000 + k) + (f" {passage}" if k < 16 else "") for k in range(20)]
    texts += [f"{body} q1 {passage}", f"{body} q2 {passage} {prose(25, 45)}"]
    got = rows(minhash.near_duplicates(frame(spark, texts), shingle=3, percent=85))
    want = brute_components(dict(enumerate(texts, 1)), 3, 85)
    assert want[42][1] == 1
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}


def test_equal_parts_find_all_similar_sets():
    """Pairs at the very threshold, of all sizes: one part is equal at least, in the group of the smaller set's band."""
    r = np.random.default_rng(5)
    for percent in (80, 85):
        for n in [*range(1, 60), 150, 700, 4000]:
            s = r.integers(0, 1 << 62, n, dtype=np.uint64)
            off = n * (100 - percent) // (100 + percent)
            more = int(n * 100 / percent) - n
            near = [np.r_[s[off:], r.integers(0, 1 << 62, off, dtype=np.uint64)], np.r_[s, r.integers(0, 1 << 62, more, dtype=np.uint64)]]
            for t in near:
                band = [math.floor(math.log(len(x)) / math.log(100 / percent)) for x in (s, t)]
                assert band[1] - band[0] in (0, 1)
                assert np.intersect1d(*[minhash.part_keys(np.unique(x), band[0], percent) for x in (s, t)]).size


def pool_texts(n, seed):
    """Texts of six sentences out of a pool of 24: many share sentences, few are near each other."""
    r, pool = random.Random(seed), [prose(17, 9000 + k) for k in range(24)]
    return [" ".join(r.sample(pool, 6)) for _ in range(n)]


def test_near_duplicates_out_of_a_pool_of_sentences(spark, monkeypatch):
    """Pairs compared last grow with the documents, not with the pairs that share a sentence; near ones among them are found."""
    across = []
    for n in (200, 400):
        texts = pool_texts(n, n)
        texts += [edited(t, 2, 70 + k) for k, t in enumerate(texts[:12])]
        sizes, write = [], minhash.written
        monkeypatch.setattr(minhash, "written", lambda df, name: (sizes.append(out.count()) if name == "across" else None, out)[1] if (out := write(df, name)) is not None else None)
        got = rows(minhash.near_duplicates(frame(spark, texts), shingle=3, percent=85))
        monkeypatch.setattr(minhash, "written", write)
        want = brute_components(dict(enumerate(texts, 1)), 3, 85)
        assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}
        across.append(sum(sizes))
    assert across[1] < 3 * across[0], across


def test_near_duplicates_empty_and_repeated(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    d = frame(spark, ["a b c d e f", "a b c d e f"])
    got = minhash.near_duplicates(d.unionByName(d)).collect()
    assert len(got) == 4 and {r.component_id for r in got} == {1}
    stay = minhash.without_near_duplicates(d)
    assert stay.columns == d.columns and [r.doc_id for r in stay.collect()] == [1]


def test_shingle_sets():
    texts = ["a b c d", "A  b\tc\nd", "", None, "a b", "x" * 100]
    got = list(shingles.sets([None if t is None else t.encode() for t in texts], 3))
    assert [len(g) for g in got] == [2, 2, 0, 0, 1, 1] and (got[0] == got[1]).all()


# --- tokens and packing ------------------------------------------------------------------------------------------------------

ODD = ["a  b", "a\n  b", " \n\t x  ", "foo  <|endoftext|> bar\x1cbaz", "don't  we'll\r\n\r\nI'M", "\u0301e \u00c5 \u0130 \x85 z", None, "", "a" * 3000, "\u3000\u3000a\u2003 b", "<|startoftext|>x<|endoftext|>", "\u03a3\u03a3 \u03a3", "1234 12.5e3 \u00bd", "word " * 3000, "\U0001f600\U0001f600 x", "same", "same"]


def test_token_counts(spark):
    path = token_counts.tokenizer_path("word_bpe_49k.json")
    tok = token_counts.tokenizer(path)
    got = rows(token_counts.token_counts(frame(spark, ODD), path, table_size=8))
    for i, t in enumerate(ODD, 1):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


@pytest.mark.parametrize("ranks", [True, False])
def test_packing_round_trip(spark, ranks):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    tok = token_counts.tokenizer(path)
    texts = ODD + [prose(n, n) for n in range(1, 200, 7)]
    df = packing.pack(frame(spark, texts), path, token_counts.tokenizer_path("byte_bpe_50k.tiktoken") if ranks else None)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in df.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in enumerate(texts, 1):
        ids, at = [*tok.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len(rs) <= packing.MAX_SEGMENTS
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 8 * len(sequences)
    assert packing.pack(frame(spark, []), path).count() == 0


def test_packing_limits_matter(spark):
    """Each limit changes what is packed together; all hold; ids are whole."""
    path, ranks = token_counts.tokenizer_path("byte_bpe_50k.json"), token_counts.tokenizer_path("byte_bpe_50k.tiktoken")
    tok = token_counts.tokenizer(path)
    texts = [f"{prose(k % 9 + 1, k)}\n{prose(k % 40, 500 + k)}" for k in range(300)] + [prose(4000, 9), "a", "a"]

    def packed(**limits):
        out = collections.defaultdict(list)
        for r in packing.pack(frame(spark, texts).coalesce(1), path, ranks, prompts=True, **limits).collect():
            out[r.sequence_id].append(r)
        return out

    quiet = {i: len(tok.encode(packing.first_line(t), add_special_tokens=False).ids) for i, t in enumerate(texts, 1)}
    bears = lambda r: r.length - max(0, min(r.length, quiet[r.doc_id] - r.start))
    free = packed(max_segments=10_000, max_loss=2048)
    for limits in ({"max_segments": 12, "max_loss": 2048}, {"max_segments": 10_000, "max_loss": 1500}, {}):
        got = packed(**limits)
        most, loss = limits.get("max_segments", packing.MAX_SEGMENTS), limits.get("max_loss", packing.MAX_LOSS)
        assert all(sum(r.length for r in rs) <= 2048 and len(rs) <= most and sum(map(bears, rs)) <= loss for rs in got.values())
        assert sum(r.length for rs in got.values() for r in rs) == sum(r.length for rs in free.values() for r in rs)
        if limits:
            assert any(len(rs) > most or sum(map(bears, rs)) > loss for rs in free.values())


def test_packing_limits():
    """All three limits hold, with and without cutting."""
    r = random.Random(5)
    for cut in (True, False):
        p = packing.Packer(0, 64, 3, 20, 16, cut)
        for doc in range(200):
            n = r.randint(1, 60)
            mask = np.zeros(n, np.int64)
            mask[n - r.randint(0, min(n, 20)) :] = 1
            p.add(doc, bytes(4 * n), mask)
        p.drain(0)
        by = collections.defaultdict(list)
        for row in p.taken():
            by[row[5]].append(row)
        assert all(sum(x[2] for x in v) <= 64 and len(v) <= 3 for v in by.values())
    with pytest.raises(ValueError):
        packing.Packer(0, 8, 3, 8, 16, False).add(1, bytes(4 * 9))


# --- repeats -----------------------------------------------------------------------------------------------------------------


def brute_repeats(texts, span):
    seen, out = set(), {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - span + 1):
            if b[s : s + span] in seen:
                gone[s : s + span] = b"\1" * span
            seen.add(b[s : s + span])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats(spark, group):
    p, q = prose(40, 1), prose(30, 2)
    texts = [prose(50, 3) + p, prose(20, 4) + p + prose(10, 5) + p, None, "", "ab" * 400, "x" * 350, q, q, q[:99], q[:100], "\u00e9" * 200, p[30:] + q[:120] + p[:110]] + [prose(5, 50 + k) + p[20:125] + prose(5, 90 + k) for k in range(12)]
    got = rows(repeats.remove_repeats(frame(spark, texts), group=group))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute_repeats(dict(enumerate(texts, 1)), 100)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_repeats_of_shared_repeated_and_long_rows(spark):
    p = prose(40, 61)
    d = spark.createDataFrame([(2, p), (2, None), (2, p + prose(20, 62)), (3, p), (3, p), (None, p[:150])], "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in repeats.remove_repeats(d, with_text=True).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.kept.decode()))
    assert got[None] == [(150, 0, p[:150])] and got[3] == [(len(p), len(p), "")] * 2
    assert (0, 0, "") in got[2] and sum(t.endswith(prose(20, 62)) for _, _, t in got[2]) == 1
    long = [prose(200_000, 63)]  # about 1 MB
    long += [prose(20, 64) + long[0][300_000:300_400] + prose(20, 65), long[0][999_000:]]
    assert len(long[0]) > 1_000_000
    out = rows(repeats.remove_repeats(frame(spark, long)))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in out.items()} == brute_repeats(dict(enumerate(long, 1)), 100)


def test_run_index_matching_statistics():
    r = random.Random(1)
    for alphabet in [b"ab"] * 40 + [bytes(range(256))] * 10:
        base = bytes(r.choice(alphabet) for _ in range(60))

        def some():
            at = r.randrange(60)
            return b"".join([bytes(r.choice(alphabet) for _ in range(r.randint(1, 6))), base[at : at + r.randint(0, 50)], bytes(r.choice(alphabet) for _ in range(r.randint(0, 5)))])

        have, asked = [some() for _ in range(r.randint(1, 10))], [some() for _ in range(r.randint(1, 10))]
        index = run_index.RunIndex(have)
        assert len(index.start) <= len(index.text)
        for p, got in zip(asked, index.matching(asked)):
            assert got.tolist() == [max(n for n in range(len(p) - i + 1) if any(p[i : i + n] in s for s in have)) for i in range(len(p))]


# --- lines -------------------------------------------------------------------------------------------------------------------


def test_repeats_of_runs_that_agree_in_upper_bits(spark, monkeypatch):
    """Runs of one anchor that differ in the lower 40 bits of their hashes alone are compared window by window."""
    real = repeats.run_batches

    def low(batches, span, gram):
        for b in real(batches, span, gram):
            yield b.set_column(2, "_h", pc.bit_wise_and(b.column(2), (1 << 40) - 1))

    texts = dict(enumerate([prose(60, 1), prose(30, 2) + prose(60, 1)[40:240] + prose(30, 3), prose(60, 1)[20:200] + prose(20, 4)], 1))
    want = {i: r.kept_sha256 for i, r in rows(repeats.remove_repeats(frame(spark, texts.values()))).items()}
    monkeypatch.setattr(repeats, "run_batches", low)
    got = rows(repeats.remove_repeats(frame(spark, texts.values())))
    assert any(r.n_removed for r in got.values())
    assert {i: r.kept_sha256 for i, r in got.items()} == want


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def brute_lines(texts):
    seen, out = [], {}
    for i in sorted(texts):
        if texts[i] is None:
            out[i] = (None, 0, 0)
            continue
        lines, kept = texts[i].split("\n"), []
        for x in lines:
            if len(x) >= 20 and any(x == y or len(y) >= 20 and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2 for y in seen):
                pass
            else:
                kept.append(x)
            seen.append(x)
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def typo(line, n, seed):
    r = random.Random(seed)
    s = list(line)
    for _ in range(n if s else 0):
        k, at = r.randrange(3), r.randrange(max(1, len(s)))
        s[at : at + (k != 0)] = [] if k == 2 else ["\u00df"]
    return "".join(s)


def test_line_dedup(spark):
    a, b = prose(15, 1)[:75], prose(30, 2)[:130]
    texts = [f"{a}\nshort\n{b}", None, "", "\n\n", f"{a}\nshort\nshort", prose(8, 3)[:30] + "\n" + prose(8, 3)[:30], "\n".join(typo(a, k % 4, k) for k in range(40)), "\n".join(typo(b, k % 4, 50 + k) for k in range(40)), "x" * 9000, a[:59], a[:59] + "!"]
    got = rows(line_dedup.dedup_lines(frame(spark, texts), counts=True))
    assert {i: (r.text, r.n_lines, r.n_removed) for i, r in got.items()} == brute_lines(dict(enumerate(texts, 1)))
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_of_short_lines(spark):
    """Lines of 18 to 64 characters, across both ways of indexing and the least length, with up to three typos."""
    r = random.Random(17)
    lines = []
    for k, n in enumerate([*range(18, 65, 2), 20, 21, 58, 59, 60, 61, 62]):
        line = prose(20, 700 + k)[:n]
        lines += [line, *(typo(line, e, 900 + 7 * k + e) for e in (1, 2, 2, 3))]
    lines += [f"page {k} of the same report" for k in range(95, 105)]
    r.shuffle(lines)
    texts = ["\n".join(lines[k : k + 9]) for k in range(0, len(lines), 9)]
    want = brute_lines(dict(enumerate(texts, 1)))
    got = rows(line_dedup.dedup_lines(frame(spark, texts), counts=True))
    assert {i: (x.text, x.n_lines, x.n_removed) for i, x in got.items()} == want
    assert sum(n for _, _, n in want.values()) > 60


def test_parts_in_common(spark):
    """Never refuses strings within two edits, and nearly always those of other words."""
    lines = [(prose(20, 40 + k)[: 20 + k], k % 3, k) for k in range(60)]
    d = spark.createDataFrame([(x, typo(x, e, k), prose(20, 500 + k)[: len(x)]) for x, e, k in lines], "a string, b string, c string")
    got = d.select(line_dedup.parts_in_common("a", "b", 2).alias("near"), line_dedup.parts_in_common("b", "a", 2).alias("back"), line_dedup.parts_in_common("a", "c", 2).alias("far")).collect()
    assert all(x.near and x.back for x in got) and sum(x.far for x in got) <= 1


def test_line_dedup_of_lists_without_near_lines(spark):
    """Many variants of one line, far from each other but for a few: no head settles them."""
    r = random.Random(11)
    base = prose(28, 21)
    words = base.split()

    def changed(k):
        w = list(words)
        for _ in range(1 + k % 2):
            w[r.randrange(len(w))] = "".join(r.choice("qrstuv") for _ in range(6))
        return " ".join(w)

    lines = [base] + [changed(k) for k in range(60)]
    lines += [typo(lines[k], 1 + k % 2, 300 + k) for k in range(3, 40, 3)] + [typo(lines[5], 2, 400 + k) for k in range(6)]
    r.shuffle(lines)
    got = rows(line_dedup.dedup_lines(frame(spark, lines), counts=True))
    want = brute_lines(dict(enumerate(lines, 1)))
    assert sum(n for _, _, n in want.values()) > 5
    assert {i: (x.text, x.n_lines, x.n_removed) for i, x in got.items()} == want


def test_line_dedup_of_shared_and_repeated_rows(spark):
    """Rows of one doc_id with different texts keep their own lines; repeated rows lose the same ones."""
    line = prose(12, 5)
    d = spark.createDataFrame([(5, f"{line}\nrow A is here"), (5, f"{line}\nunique line of row B"), (7, line), (7, line), (None, prose(9, 6)), (8, prose(9, 6))], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(d).collect()]
    assert sum(t.count("row A is here") for _, t in got) == 1 and sum(t.count("unique line of row B") for _, t in got) == 1
    assert sum(t.count(line) for _, t in got) == 1
    assert [t for i, t in got if i == 7] == ["", ""] and (None, prose(9, 6)) in got and (8, "") in got


def test_banded_distance(spark):
    r = random.Random(3)
    pairs = [("", ""), ("a", ""), ("ab", "ba"), ("a" * 5, "a" * 8)] + [(x := "".join(r.choice("ab\u00e9") for _ in range(r.randint(1, 12))), typo(x, r.randint(0, 4), r.random())) for _ in range(60)]
    d = spark.createDataFrame([(x, y) for x, y in pairs if y], "a string, b string").select("a", "b", F.split("a", "").alias("_a"), F.split("b", "").alias("_b")).withColumn("ok", line_dedup.within("_a", "_b", 2))
    for row in d.where("a <> ''").collect():
        assert row.ok == (distance(row.a, row.b) <= 2), row


# --- language ----------------------------------------------------------------------------------------------------------------


def test_language_id(spark):
    words = {"en": "the of and to in is that it for was with".split(), "de": "der die und in den von zu das mit sich".split(), "sv": "och att det som en p\u00e5 \u00e4r av f\u00f6r med".split()}
    r = random.Random(1)
    data = [(i, " ".join(r.choice(words[lang]) for _ in range(40)), lang) for i, lang in enumerate(["en", "de", "sv"] * 40)]
    learn = spark.createDataFrame(data, "_id long, _text string, _lang string")
    model = language_id.fit(learn)
    texts = ["the and of it is in the", "der und die von das mit", "och att det som \u00e4r", None, "", "123 !!", "THE  AND, OF: it"]
    got = rows(language_id.identify(frame(spark, texts), model))
    assert [got[i].lang_pred for i in range(1, 8)] == ["en", "de", "sv", "und", "und", "und", "en"]
    assert all(0 <= x.score <= 1 for x in got.values()) and got[4].score == 0
    none = language_id.fit(learn.where("false"))
    assert {x.lang_pred for x in language_id.identify(frame(spark, texts), none).collect()} == {"und"}
    assert (np.abs(language_id.codewords(7).sum(0)) < 7).all()


def slow_predict(model, text):
    """A text's language by its trigrams one at a time."""
    cost = []
    raw = (text or "").lower().encode("utf-8", "replace").translate(language_id.LETTERS)
    x = b" " + b" ".join(raw.split()) + b" "
    margins, n = [0.0] * model.code.shape[1], 0
    for a, b, c in zip(x, x[1:], x[2:]):
        h = ((a * 0x9E3779B1) & 0xFFFFFFFF) ^ ((b * 0x85EBCA77) & 0xFFFFFFFF) ^ ((c * 0xC2B2AE3D) & 0xFFFFFFFF)
        h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
        slot = (h >> 18) % (language_id.SLOTS - 1) + 1
        n += 1
        margins = [m + float(w) for m, w in zip(margins, model.weights[slot])]
    scale = language_id.SHARPNESS * math.sqrt(min(n, language_id.SURE)) / max(n, 1)
    for word in model.code:
        cost.append(sum(t * math.log1p(math.exp(-m * scale * c)) for m, c, t in zip(margins, word, model.trust)))
    return model.langs[cost.index(min(cost))], cost


def test_language_id_decoding(spark):
    """Six invented languages with held-out texts; a slow decoder; one language; repeated rows, ties, clashing columns."""
    r = random.Random(5)
    alphabets = {x: [r.choice("abcdefghijklmnoprstuvw\u00e9\u00f6") for _ in range(9)] for x in ("aa", "bb", "cc", "dd", "ee", "ff")}
    text = lambda x, n: " ".join("".join(r.choice(alphabets[x]) for _ in range(r.randint(2, 6))) for _ in range(n))
    learn = [(k, text(x, 30), x) for k, x in enumerate(list(alphabets) * 40)]
    df = spark.createDataFrame(learn + learn[:6] + [(999, "zzz", None), (None, text("aa", 9), "aa")], "_id long, _text string, _lang string")
    model = language_id.fit(df)
    assert model.langs == sorted(alphabets) and model.code.shape[1] > 5
    held = [(x, text(x, n)) for n in (8, 20, 2000) for x in alphabets for _ in range(5 if n < 100 else 1)]
    got = rows(language_id.identify(frame(spark, [t for _, t in held]), model))
    right = sum(got[i].lang_pred == x for i, (x, _) in enumerate(held, 1))
    assert right >= 0.9 * len(held)
    for i, (_, t) in enumerate(held, 1):
        lang, cost = slow_predict(model, t)
        two = sorted(cost)[:2]
        assert got[i].lang_pred == lang or two[1] - two[0] < 1e-6
        assert got[i].ambiguous == (two[1] - two[0] < language_id.LEAD) or abs(two[1] - two[0] - language_id.LEAD) < 1e-3
    one = language_id.fit(df.where("_lang = 'cc'"))
    assert [x.lang_pred for x in language_id.identify(frame(spark, ["abc", "!!", None, "abc"]), one).orderBy("doc_id").collect()] == ["cc", "und", "und", "cc"]
    same = language_id.fit(spark.createDataFrame([(1, "same text", "x"), (2, "same text", "b")], "_id long, _text string, _lang string"))
    tied = language_id.identify(frame(spark, ["same text"]), same).first()
    assert tied.lang_pred == "b" and tied.ambiguous
    few = language_id.fit(df, per_language=3)
    assert few.langs == sorted(alphabets)
    assert language_id.identify(frame(spark, []), model).count() == 0


# --- licences, urls, quality, benchmark ---------------------------------------------------------------------------------------


def test_licenses(spark):
    texts = ["x Under the MIT License y under the mit-license", "Apache License, Version 2.0", "CC BY-NC 4.0", "cc by \u00e9 nc", None, "", "under the mit", "All rights reserved.", "This work is licensed under the GNU General Public License, version 3."]
    got = rows(licenses.scan_licenses(frame(spark, texts)))
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (10, 2, 1, 6, "mit")
    assert [got[i].base_labels for i in range(1, 10)] == ["mit", "apache-2", "cc-by-nc", "", "", "", "", "", ""]
    assert got[5].n_words == 0 and got[5].first_word is None and got[5].labels == ""
    assert "reserved" in got[8].labels and "gpl" in got[9].labels and "cc-by-nc" in got[3].labels
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def slow_licenses(words, n_docs, df):
    """The same verdicts from all alignments of every template, one by one."""
    idf = lambda w: math.log((n_docs + 1) / (df.get(w, 0) + 0.5)) + 1e-6
    starts, base, found = [], set(), set()
    for text, label in licenses.PHRASES:
        p = text.encode().split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += here
        base |= {label} if here else set()
    for label, text, key in licenses.TEMPLATES:
        t, k = text.encode().split(), key.encode().split()
        known = sorted(set(t), key=lambda w: (-idf(w), w))
        rare = [w for w in known if w in words][: licenses.RARE]
        need = min(licenses.MATCHES, len(known))
        for o in range(-len(t), len(words)):
            exact = any(0 <= o + q < len(words) and words[o + q] == w for w in rare for q, y in enumerate(t) if y == w)
            agree = sum(any(words[i] == w and t[q] == w and abs(i - q - o) <= licenses.SHIFT for i in range(max(0, o - 2), min(len(words), o + len(t) + 3)) for q in range(len(t))) for w in rare)
            near = range(max(0, o - licenses.SHIFT), o + len(t) + licenses.SHIFT - len(k) + 1)
            if not exact or agree < need or not any(words[i : i + len(k)] == k for i in near):
                continue
            share = sum(idf(w) for i, w in enumerate(t) if any(0 <= i + o + d < len(words) and words[i + o + d] == w for d in range(-licenses.SHIFT, licenses.SHIFT + 1)))
            if share / sum(idf(w) for w in t) >= licenses.MIN_SCORE:
                found.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | found))


def test_licenses_against_all_alignments(spark):
    """Random mixtures of template words, phrases and prose; repeated and long texts."""
    r = random.Random(8)
    pool = [t for _, t, _ in licenses.TEMPLATES] + [p for p, _ in licenses.PHRASES]
    texts = []
    for k in range(60):
        w = []
        for _ in range(r.randint(0, 4)):
            part = r.choice(pool).split()
            at = r.randrange(len(part))
            part = [x for x in part[at if r.random() < 0.3 else 0 :] if r.random() > 0.1]
            w += part[: r.randint(1, 60)] + prose(r.randint(0, 6), r.random()).split()
        texts.append(" ".join(w))
    texts += [texts[3], None, "", prose(6000, 1) + " " + pool[1] + " " + prose(3000, 2)]
    words = [licenses.words_of((t or "").encode()) for t in texts]
    df = collections.Counter(w for ws in words for w in set(ws))
    got = rows(licenses.scan_licenses(frame(spark, texts)))
    labelled = 0
    for i, ws in enumerate(words, 1):
        x = got[i]
        if len(ws) < 5000:
            assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels) == slow_licenses(ws, len(texts), df), texts[i - 1]
        labelled += x.labels != x.base_labels
        assert 0 <= x.score <= 1
    assert labelled > 10 and "mit" in got[len(texts)].labels and got[4][1:] == got[61][1:]


def test_url_rules(spark):
    urls = ["http://www.Example.com/en/1", "https://example.com/en/x", "https://a.example.com/de/", "http://b.net/es/?q", "http://net/fr/", "http://b.net/es", None, "no-scheme", "x://h?q", "https://org.uk/a"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r.page_id: r for r in url_filter.filter_urls(pages, spark.createDataFrame([], "_id long, _bad double")).collect()}
    assert [(out[i].rule, out[i].verdict) for i in range(10)] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"), ("net/es/", "block"), ("net/fr/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert [(out[i].host, out[i].path) for i in (0, 3, 6, 7, 8)] == [("www.example.com", "/en/1"), ("b.net", "/es/"), ("", ""), ("", ""), ("h", "")]


def test_url_reputation(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i < 60 else f'g{i % 6}'}.org/{i}") for i in range(200)], "page_id long, url string")
    bad = spark.createDataFrame([(i, 1.0 if i < 60 else 0.0) for i in range(0, 200)], "_id long, _bad double")
    out = url_filter.filter_urls(pages, bad).collect()
    assert {r.host for r in out if r.verdict == "block"} == {"bad.org"}
    without = {r.host for r in url_filter.filter_urls(pages, bad.withColumn("_bad", F.lit(0.3)), rules=[]).collect() if r.verdict == "block"}
    assert not without  # with the same rate everywhere the method blocks nothing


def test_url_levels(spark):
    """Ports, users and addresses; bad hosts next to one of the same domain; empty, repeated and clashing input."""
    hosts = ["a.shop.co.uk", "b.shop.co.uk:8080", "u@c.shop.co.uk", "10.0.0.1", "10.0.0.2:81", "[::1]:80", "x.com", "com", "", "d.e.f.org"]
    got = {r._host: (r._domain, r._suffix) for r in url_filter.levels(spark.createDataFrame([(h,) for h in hosts], "_host string")).collect()}
    assert got == dict(zip(hosts, [("shop.co.uk", "co.uk")] * 3 + [("10.0.0.1",) * 2, ("10.0.0.2",) * 2, ("[::1]",) * 2, ("x.com", "com"), ("com", "com"), ("", ""), ("f.org", "org")]))
    urls = [f"http://{h}.farm.net/{'x' * (50_000 if i == 3 else 3)}/{i}" for i, h in enumerate(["spam"] * 60 + ["good"] * 60)] + [f"http://h{i % 9}.org/{i}" for i in range(120)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, _host string, verdict string")
    bad = spark.createDataFrame([(i, 1.0 if i < 60 and i % 10 else 0.0) for i in range(240)] + [(3, None), (None, 1.0), (999, 1.0)], "_id long, _bad double")
    out = url_filter.filter_urls(pages, bad, rules=[]).collect()
    assert {r.host for r in out if r.verdict == "block"} == {"spam.farm.net"}
    means = {r.host: r.bad_rate for r in out}
    assert means["good.farm.net"] > means["h1.org"]  # its neighbour's bad pages count, a little
    assert url_filter.filter_urls(pages.unionByName(pages), bad).count() == 480 and url_filter.filter_urls(pages.limit(0), bad).count() == 0


def brute_quality(t):
    w = re.findall("[^\x20\x09-\x0D]+", t or "")
    g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = collections.Counter(g)
    hit = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), len(lines) - len(set(lines)), len(hit), failed


def test_quality(spark):
    clean = " ".join(random.Random(4).choice("the of and to in is that it for was house river morning letter garden window people".split()) for _ in range(15))
    texts = [None, "", " \n\t ", "a b c d e " * 3, prose(50, 1) + "\n" + prose(12, 2) + "\n" + prose(12, 2), "x\nx\n \nx", "| ".join(prose(60, 5).split()), prose(60, 6).upper() + "!!", "w\u00a0x y", clean + " " + prose(30, 3), "a " * 4000]
    got = rows(quality.score_quality(frame(spark, texts)))
    for i, t in enumerate(texts, 1):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(t), t
        assert not (r.kept and r.base_failed)
    assert not got[7].kept and not got[8].kept
    d = frame(spark, texts)
    kept = quality.quality_filter(d)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.score_quality(frame(spark, [])).count() == 0


def test_quality_references(spark):
    """References learned from labelled rows: each language's own texts stay, shuffled symbols and other languages' mixtures go."""
    r = random.Random(3)
    words = {"x": "aa bb cc dd ee ff gg hh".split(), "y": "kkk lll mmm nnn ooo ppp qqq".split()}
    text = lambda lang, n: " ".join(r.choice(words[lang]) if r.random() < 0.6 else prose(1, r.random()) for _ in range(n)).capitalize() + "."
    data = [(k, text(lang, 80), lang) for k, lang in enumerate(["x", "y"] * 60)]
    data += [(500, text("x", 90), None), (501, "K1# " * 9 + " ".join(f"{k}$%#{k}" for k in range(60)), "x"), (502, None, "y"), (None, "text", "x"), (503, text("x", 90).upper(), "x"), (504, text("y", 2000), "x")]
    docs = spark.createDataFrame(data + data[:2], "doc_id long, text string, lang string")
    learned = quality.references(docs.selectExpr("doc_id _id", "text _text", "lang _lang"))
    assert [x.lang for x in learned] == ["x", "y"] and set(words["x"][:5]) <= set(learned[0].words) and set(words["y"]) <= set(learned[1].words)
    got = collections.defaultdict(list)
    for x in quality.score_quality(docs).collect():
        got[x.doc_id].append(x)
    assert all(x.kept for k in range(120) for x in got[k]) and len(got[0]) == 2
    assert got[500][0].kept and got[504][0].kept and not got[501][0].kept and not got[503][0].kept and not got[502][0].kept
    # The references matter: from those of other languages the same texts are farther.
    plain = {x.doc_id: x.distance for x in quality.score_quality(docs, lang=None).collect()}
    assert all(plain[k] > got[k][0].distance + 0.05 for k in range(20))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    cur = con.execute(quality.sql())
    names = [c[0] for c in cur.description]
    key = lambda row: repr(sorted((k, None if v is None or v != v else int(v) if k == "doc_id" else v) for k, v in row.items()))
    assert sorted(key(dict(zip(names, row))) for row in cur.fetchall()) == sorted(key(x.asDict()) for rows_ in got.values() for x in rows_)


def test_quality_references_of_all_rows(spark, tmp_path):
    """References count all rows of a language, also beyond REFERENCE_ROWS; the query learns from the rows of its SQL."""
    r = random.Random(8)
    texts = [" ".join(r.choice("aa bb cc dd ee ff".split() if k < 400 else "gg hh ii jj kk".split()) for _ in range(40)).capitalize() + "." for k in range(900)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(900 + k, t, "y") for k, t in enumerate(texts[:60])] + [(990, None, "x"), (None, "zz", "x")], "doc_id long, text string, lang string")
    x, y = quality.references(docs.selectExpr("doc_id _id", "text _text", "lang _lang"))
    c = collections.Counter(w for t in texts for w in fold(t).split())
    top = sorted(c, key=lambda w: (-c[w], w))[: quality.COMMON]
    first, second = sum(c[w] for w in top[: quality.TOP]), sum(c[w] for w in top[quality.TOP :])
    assert x.words == tuple(top) and x.bins == (first, second, 36_000 - first - second) and sum(x.classes) == sum(map(len, texts)) and x.classes[1] == 900
    assert (y.lang, sum(y.bins), y.classes[1]) == ("y", 2400, 60)
    some = quality.references(docs.selectExpr("doc_id _id", "text _text", "lang _lang"), quality.REFERENCE_ROWS)
    assert [sum(z.bins) for z in some] == [40 * quality.REFERENCE_ROWS, 2400]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(quality.sql())
    names = [z[0] for z in cur.description]
    got = quality.op10_quality_rules(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))


def test_quality_references_with_repeated_ids(spark, tmp_path):
    """Rows count, not ids: exactly REFERENCE_ROWS of a language teach, also where all its ids have high hashes."""
    r = random.Random(9)
    text = lambda words: " ".join(r.choice(words.split()) for _ in range(40)).capitalize() + "."
    high = next(k for k in range(20, 999) if hashlib.md5(str(k).encode()).hexdigest() > "f8")
    data = [(k, t, "x") for k in range(10) for t in [text("aa bb cc dd ee ff" if k % 2 else "gg hh ii jj kk")] * 70]
    data += [(high, text("lll mmm nnn ooo"), "y")] * 1300
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    some = quality.references(docs.selectExpr("doc_id _id", "text _text", "lang _lang"), quality.REFERENCE_ROWS)
    assert [(z.lang, sum(z.bins)) for z in some] == [("x", 40 * quality.REFERENCE_ROWS), ("y", 40 * quality.REFERENCE_ROWS)]
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(quality.sql())
    names = [z[0] for z in cur.description]
    got = quality.op10_quality_rules(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))


def test_decontamination(spark):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(t))
    span = prose(12, 1)
    texts = [prose(30, 2) + " " + span.upper().replace(" ", "-") + " " + prose(9, 3), span, None, "", prose(40, 4), " ".join(span.split()[:9]), "short item here", "x short item here short item here", span + " " + span, "a a a a a a a a a a a a a a"]
    items = [(10, span), (9, "Short item, here"), (None, span), (3, None), (4, ""), (5, "a " * 10), (9, "Short item, here")]
    got = rows(decontamination.decontaminate(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")))
    for i, t in enumerate(texts, 1):
        w, hit, found = words(t), set(), set()
        for item, x in items:
            v = words(x)
            n = min(10, len(v))
            for a in {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else ():
                for s in range(len(w) - n + 1):
                    if tuple(w[s : s + n]) == a:
                        hit |= set(range(s, s + n))
                        if item is not None:
                            found.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items, got[i].contaminated) == (len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)), t
    assert decontamination.decontaminate(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontamination.decontaminate(frame(spark, texts), spark.createDataFrame([], "item_id long, text string")).where("contaminated").count() == 0


def test_decontamination_rows_of_one_id_and_shuffled_joins(spark, monkeypatch):
    """Rows that share a doc_id but not the text keep their own hits, repeated rows have equal ones; the same rows without broadcasts."""
    span, few = prose(14, 61), prose(4, 62)
    texts = [(1, span), (1, "nothing at all"), (1, None), (None, f"x {few} y"), (None, "clean"), (2, span), (2, span), (3, f"{prose(30000, 63)} {span}")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, _id string")
    items = spark.createDataFrame([(7, span), (8, span + " more"), (9, few)], "item_id long, text string")
    want = sorted([(1, 14, 14, "7,8"), (1, 3, 0, ""), (1, 0, 0, ""), (-1, 6, 4, "9"), (-1, 1, 0, ""), (2, 14, 14, "7,8"), (2, 14, 14, "7,8"), (3, 30014, 14, "7,8")])
    for rows_ in (decontamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows_)
        got = decontamination.decontaminate(docs, items).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == want
        stay = decontamination.without_contaminated(docs, items)
        assert stay.columns == docs.columns and sorted(r.text or "" for r in stay.collect()) == ["", "clean", "nothing at all"]


def test_packing_of_one_very_long_document():
    """Cutting takes time in proportion to the length."""
    import time

    p = packing.Packer(0, 2048, 48, 2048, 512, True)
    began = time.time()
    p.add(1, np.arange(16_000_001, dtype="<u4").tobytes())
    p.drain(0)
    assert time.time() - began < 5
    out = p.taken()
    assert sum(r[2] for r in out) == 16_000_001 and [r[1] for r in out] == list(np.cumsum([0] + [r[2] for r in out[:-1]]))

"""Phrase mining against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from threadloom.llm import collocations as m

DOCS = "doc_id long, text string, lang string, phrase string, _lang string, n string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, least, top, cover=m.COVER):
    out = []
    for lang in {r[2] or "und" if r[2] is None else r[2] for r in rows}:
        f = collections.Counter()
        for r in rows:
            if (r[2] if r[2] is not None else "und") == lang:
                for w in pieces(r[1]):
                    f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        hidden = {g[i : i + k] for g, c in found.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if 100 * c >= cover * f[g[i : i + k]]}
        scores = []
        for g, a in found.items():
            if g not in hidden:
                s, _, x, y = min((m.SCALE * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                scores.append((-s, -a, " ".join(g).encode(), x, y))
        out += [(lang, k, p.decode(), -a, x, y, n, -s) for k, (s, a, p, x, y) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, t, g, "x", "y", "z") for i, t, g in rows], DOCS)
    return sorted(map(tuple, m.collocations(df, **options).collect()))


def corpus(n, seed):
    r = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "é", "É", "ÉCLAT", "w x", "\x00", "a\x1fb", "a-b", "…"] + [f"v{i}" for i in range(12)]
    ends = [" ", "  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "; ", "!?"]
    weights = [40, 2, 3, 1] + [1] * 8
    text = lambda: "".join(r.choice(words) + r.choices(ends, weights)[0] for _ in range(r.randrange(60)))
    return [(i, text(), r.choice(["en", "en", "en", "und", None, "fr", ""])) for i in range(n)]


ROWS = corpus(120, 1) + [(500, None, "en"), (501, "", "en"), (502, " \t\n", None), (503, "new york " * 3000, "en"), (504, "x" * 9000, "fr"), (505, "the of. " * 4000, "en")] + [(7, "same words again, same words", "fr")] * 9 + [(None, "same words again", None)] * 3


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 300, "sieve_bits": (7, 7)}, {"shard_bytes": 5000}])
def test_phrases(spark, options):
    for least, top in [(5, 15)] if options else [(5, 15), (2, 2000)]:
        assert mined(spark, ROWS, min_count=least, top=top, **options) == brute(ROWS, least, top)


def test_no_rows_and_no_phrases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None), (2, "one two. three", "en")]) == []


def test_products_beyond_64_bits(spark):
    big = 2**62
    counts = [("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "a b", 2, big), ("en", "b a", 2, 10), ("en", "a b a", 3, 7)]
    got = {r.phrase: r for r in m.scored(spark.createDataFrame(counts, "lang string, phrase string, k int, c bigint")).collect()}
    assert got["a b"].score == m.SCALE * big // (2 * big + 3) and got["b a"].score == 0
    assert (got["a b a"].l, got["a b a"].r, got["a b a"].score) == (big + 1, 10, 0)  # both cuts give 0; the shorter first part counts


def test_intervals_by_brute_force():
    texts = [b"a b a b a b c", b"b a. b a b", b"", b"c"]
    w = m.Words(texts)
    words = [w.vocabulary[int(i)].as_py() for i in w.ids]
    ranks = m.suffix_ranks(w.ids + 1, w.left, 4)
    order = np.argsort(ranks[-1], kind="stable")
    common = m.lcp(order, ranks, w.left, 4)
    for n in range(1, 5):
        want = collections.Counter(tuple(words[i : i + n]) for i in range(len(words)) if w.left[i] >= n)
        at, size = m.intervals(order, common, w.left, n)
        assert {tuple(words[i : i + n]): int(c) for i, c in zip(at, size)} == want


def test_bitmap_holds_all_keys(spark):
    rows = [(lang, f"w{i} v{i}" if i % 2 else f"w{i}") for i in range(2500) for lang in ("en", "")]
    keys = spark.createDataFrame(rows, "lang string, phrase string")
    h = np.array([r.h for r in keys.mapInArrow(m.phrase_hashes, "h bigint").collect()])
    bits = m.bitmap(keys)
    assert m.member(bits, h.view(np.uint64)).all() and len(set(h)) == 5000
    assert m.member(bits, np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.2

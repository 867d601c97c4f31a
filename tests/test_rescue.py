"""Rescue in rounds against a sequential model."""

import random

import pytest

from threadloom.functions import candidates
from threadloom.operators import rescue as m


def model(queue, outcomes, pages, limit=3):
    attempts, tried, read = [], set(), 0
    queue = list(queue)
    for url, kind in queue:  # grows while it is walked
        if not url or url in tried:
            continue
        tried.add(url)
        status = outcomes.get(url, "failed")
        attempts.append((url, kind, status))
        if status in ("ok", "quota_exhausted"):
            return status, attempts
        if status == "invalid_content" and read < limit:
            read += 1
            if url in pages:
                found = sorted(enumerate(candidates.read_page(url, pages[url])), key=lambda x: (-x[1]["score"], x[0]))
                queue += [(c["url"], kind + "_page") for _, c in found if c["url"] not in tried]
    return "failed", attempts


def world(seed, n=25):
    r = random.Random(seed)
    urls = [f"https://x.org/{k}" for k in range(40)]
    outcomes = {u: r.choices(["ok", "invalid_content", "http_error", "too_large"], [1, 6, 3, 2])[0] for u in urls[:35]}
    pages = {u: "".join(f'<img src="{r.choice(urls)}">' for _ in range(r.randrange(5))) + f'<meta property="og:image" content="{r.choice(urls)}">' for u in urls if r.random() < 0.7}
    hashes = {f"h{k}": [(r.choice(urls + [""]), r.choice(["stage", "other"])) for _ in range(r.randint(1, 7))] for k in range(n)}
    return outcomes, pages, hashes


@pytest.mark.parametrize("seed, ahead", [(1, 1), (2, 4), (3, 100)])
def test_rounds_equal_the_sequence(spark, seed, ahead):
    outcomes, pages, hashes = world(seed)
    rows = [(h, k, u, c) for h, q in hashes.items() for k, (u, c) in enumerate(q, 1)]
    answers = spark.createDataFrame(list(outcomes.items()), "url string, status string")
    texts = spark.createDataFrame(list(pages.items()), "url string, html string")
    asked = []

    def fetch(urls):
        asked.append({r.url for r in urls.collect()})
        return urls.join(answers, "url")

    attempts, states = m.rescue(spark.createDataFrame(rows, "hash string, rank int, url string, source_class string"), fetch, lambda urls: urls.join(texts, "url"), ahead=ahead)
    want = {h: model(q, outcomes, pages) for h, q in hashes.items()}
    got = {}
    for r in attempts.orderBy("hash", "rank").collect():
        got.setdefault(r.hash, []).append((r.url, r.source_class, r.status))
    assert got == {h: a for h, (_, a) in want.items() if a}
    assert {r.hash: r.status for r in states.collect()} == {h: s for h, (s, a) in want.items() if a}
    assert any("_page" in c for a in got.values() for _, c, _ in a)
    if ahead == 1:  # nothing is fetched that the sequence wouldn't, and rounds shrink
        assert set().union(*asked) == {u for _, a in want.values() for u, _, _ in a} and len(asked[-1]) < len(asked[0])


def test_a_quota_leaves_the_rest_open(spark):
    rows = [("a", 1, "u1", "s"), ("a", 2, "u2", "s"), ("b", 1, "q", "s"), ("c", 1, "u3", "s"), ("c", 2, "u4", "s"), ("d", 1, None, "s")]
    answers = spark.createDataFrame([("u1", "ok"), ("q", "quota_exhausted"), ("u3", "http_error"), ("u4", "ok")], "url string, status string")
    none = spark.createDataFrame([], "url string, html string")
    attempts, states = m.rescue(spark.createDataFrame(rows, "hash string, rank int, url string, source_class string"), lambda u: u.join(answers, "url"), lambda u: u.join(none, "url"))
    assert {r.hash: r.status for r in states.collect()} == {"a": "ok", "b": "quota_exhausted", "c": "open"}
    assert attempts.count() == 3
    attempts, states = m.rescue(spark.createDataFrame([], "hash string, rank int, url string, source_class string"), lambda u: u.join(answers, "url"), lambda u: u.join(none, "url"))
    assert attempts.count() == states.count() == 0

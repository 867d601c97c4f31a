"""Streams that stop, fail and go on: the open-set scan and the fetch loop, against the same on tables."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions import urls
from threadloom.operators import decisions, recovery
from threadloom.streaming import fetching, scan
from threadloom.streaming.ledger import Ledger


def corpus(spark, n, seed):
    r = random.Random(seed)
    names = ["".join(r.choice("abc123") for _ in range(r.randint(3, 4))) + r.choice([".png", ".jpg", ""]) for _ in range(40)]
    line = lambda: " ".join(f"https://{r.choice([urls.PRIMARY_HOST, 'i.sstatic.net'])}/{r.choice(names)}" for _ in range(r.randrange(3)))
    lines = [(k, line()) for k in range(1, n + 1)]
    keys = spark.createDataFrame([(x,) for x in names[:25]], "name string").select(F.explode(urls.posts_candidates(F.col("name"))).alias("u")).select(urls.image_key(F.col("u")).alias("hash"))
    return lines, keys.where(F.substring("hash", 1, 1) < "a")


class Killed(Exception):
    pass


@pytest.mark.parametrize("in_order, files", [(True, 7), (True, 1), (False, 5)])
def test_scan_equals_the_match_over_all_lines(spark, tmp_path, in_order, files):
    lines, wanted = corpus(spark, 140, files)
    parts = [lines[k * len(lines) // files : (k + 1) * len(lines) // files] for k in range(files)]
    if not in_order:
        parts.reverse()
    import os
    import time

    for k, part in enumerate(parts):
        spark.createDataFrame(part, "line_no bigint, line string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for f in os.listdir(tmp_path / "in"):
            if f.endswith(".parquet") and not os.path.exists(tmp_path / "seen" / f):
                (tmp_path / "seen").mkdir(exist_ok=True)
                (tmp_path / "seen" / f).touch()
                os.utime(tmp_path / "in" / f, (time.time() - 1000 + k, time.time() - 1000 + k))
    want = {tuple(r) for r in recovery.match_posts(spark.createDataFrame(lines, "line_no bigint, line string"), wanted).collect()}
    assert want
    out, check, sizes = f"file://{tmp_path}/out", f"file://{tmp_path}/check", []

    def go(after=None):
        scan.scan_open(scan.line_stream(spark, f"file://{tmp_path}/in", 1), wanted, out, check, in_order, after=after)

    def die(number):  # the batch is written, its offsets aren't committed
        sizes.append(number)
        if number == 2:
            raise Killed()

    if files > 3:
        with pytest.raises(Exception, match="Killed"):
            go(die)
        ledger = Ledger(spark, out, scan.HITS)
        assert ledger.folders() == (-1, [0, 1, 2])
        ledger.compact(lambda rows: scan.first_of(rows, "hash", ["_first", "name"]))
        assert ledger.folders() == (1, [2])
    go()
    assert {tuple(r) for r in scan.found(spark, out).collect()} == want
    rows = Ledger(spark, out, scan.HITS).rows()
    assert not in_order or rows.count() == len(want)  # no key was looked for after it was found
    go()  # nothing new
    assert Ledger(spark, out, scan.HITS).rows().count() == rows.count()


def test_ledger_ignores_what_is_unfinished(spark, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/l", "k bigint")
    assert ledger.folders() == (-1, []) and ledger.rows().count() == 0
    for k in range(3):
        ledger.put(k, spark.range(k + 1).toDF("k"))
    ledger.put(1, spark.range(5).toDF("k"))
    assert ledger.rows().count() == 9 and ledger.rows(before=1).count() == 1
    (tmp_path / "l/batch-000000000002/_SUCCESS").unlink()
    assert ledger.folders() == (-1, [0, 1])
    ledger.put(2, spark.range(2).toDF("k"))
    ledger.compact(lambda rows: rows.distinct())
    assert ledger.folders() == (1, [2]) and sorted(r.k for r in ledger.rows().collect()) == [0, 0, 1, 1, 2, 3, 4]
    ledger.put(0, spark.range(9).toDF("k"))  # folded batches stay
    assert ledger.rows().count() == 7
    with pytest.raises(ValueError):
        ledger.rows(before=1)


def test_steps_are_those_of_the_decisions(spark):
    cases = [(s, a, w) for s in (200, 301, 400, 403, 404, 408, 425, 429, 500, 503) for a in range(4) for w in (True, False)]
    df = spark.createDataFrame(cases, "s int, a int, w boolean")
    for w in (True, False):
        for r in df.where(F.col("w") == w).select("s", "a", decisions.fetch(F.col("s"), F.col("a"), 3, w).alias("d")).collect():
            assert fetching.next_step(r.s, r.a, 3, w) == r.d, r
    assert [fetching.wait_before(a, 2.0, 503, 9.0) for a in range(6)] == [2, 4, 8, 16, 32, 60] and fetching.wait_before(0, 2.0, 429, 9.0) == 9 and fetching.wait_before(0, 2.0, 429, 900.0) == 60


def answers(url, attempt):
    """The address says what comes: 503-200 is a failure, then success; x is no answer."""
    codes = url.rsplit("/", 1)[-1].split("-")
    code = codes[min(attempt, len(codes) - 1)]
    return (None if code == "x" else int(code)), b"payload", 0.01


def sequential(url, retries):
    for attempt in range(retries + 1):
        status, _, _ = answers(url, attempt)
        if (step := fetching.next_step(status, attempt, retries)) != "retry":
            return step, attempt + 1


def test_fetch_loop_with_a_restart(spark, tmp_path):
    plans = ["200", "503-200", "x-x-200", "404", "503", "408-503-429-200", "425-404", "x"]
    items = [(f"h{i}", f"https://host{i % 3}/{i}/{plans[i % len(plans)]}", f"host{i % 3}") for i in range(24)]
    spark.createDataFrame(items * 2, "hash string, url string, host string").repartition(2).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema("hash string, url string, host string").parquet(f"{tmp_path}/in")
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    options = {"retries": 3, "base": 0.01, "pace": 0.0, "per_batch": 5}
    fetching.run(source, out, check, answers, lambda ledger: ledger.rows().count() >= 5, **options)
    early = Ledger(spark, out, fetching.OUTCOMES).rows().count()
    fetching.run(source, out, check, answers, lambda ledger: fetching.settled(ledger, len(items)), **options)
    rows = Ledger(spark, out, fetching.OUTCOMES).rows().collect()
    assert 5 <= early and len(rows) == len(items)  # one outcome each
    assert {r.hash: (r.status, r.attempts) for r in rows} == {h: sequential(u, 3) for h, u, _ in items}
    assert all((r.bytes == 7) == (r.status == "ok") for r in rows)


def test_a_quota_stops_its_host(spark, tmp_path):
    items = [("a1", "https://a/1/429", "a"), ("a2", "https://a/2/200", "a"), ("b1", "https://b/1/200", "b")]
    spark.createDataFrame(items, "hash string, url string, host string").coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema("hash string, url string, host string").parquet(f"{tmp_path}/in")
    fetching.run(source, f"file://{tmp_path}/out", f"file://{tmp_path}/check", answers, lambda ledger: fetching.settled(ledger, 3), retries=0, base=0.01, pace=0.0)
    got = {r.hash: r.status for r in fetching.results(spark, f"file://{tmp_path}/out").collect()}
    assert got == {"a1": "stop", "b1": "ok"}  # a2 is still open


def lists(spark, tmp_path, items, name="in"):
    spark.createDataFrame(items, "hash string, url string, host string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return spark.readStream.schema("hash string, url string, host string").parquet(f"{tmp_path}/{name}")


def test_a_large_host_takes_few_micro_batches_and_few_stores(spark, tmp_path):
    items = [(f"h{i}", f"https://a/{i}/{['200', '503-200'][i % 2]}", "a") for i in range(300)]
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    dealt = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        fetching.run(lists(spark, tmp_path, items), out, check, answers, lambda ledger: fetching.settled(ledger, 300), retries=3, base=0.001, pace=0.0, per_batch=5)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", dealt)
    ledger = Ledger(spark, out, fetching.OUTCOMES)
    assert {r.hash: (r.status, r.attempts) for r in ledger.rows().collect()} == {h: sequential(u, 3) for h, u, _ in items}
    assert len(ledger.folders()[1]) <= 12  # 450 attempts; with 5 in a micro-batch these were 90
    assert len([x for x in (tmp_path / "check/state/0").iterdir() if x.name.isdigit()]) == fetching.PER_CORE * spark.sparkContext.defaultParallelism


def test_a_spell_of_nothing_ends_after_one_block_and_later_copies_are_not_fetched(spark, tmp_path):
    items = [(f"h{i}", f"https://a/{i}/200", "a") for i in range(12)]
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    options = {"retries": 3, "base": 0.01, "pace": 0.0, "per_batch": 4, "spell": 0.0}
    source = lists(spark, tmp_path, items)
    fetching.run(source, out, check, answers, lambda ledger: ledger.rows().count() >= 4, **options)
    lists(spark, tmp_path, [*items[:6], ("h0", "https://b/0/200", "b"), ("h12", "https://a/12/404", "a")] * 2)
    fetching.run(source, out, check, answers, lambda ledger: fetching.settled(ledger, 14), **options)
    rows = Ledger(spark, out, fetching.OUTCOMES).rows().withColumn("batch", F.input_file_name()).collect()
    assert sorted((r.host, r.hash, r.status) for r in rows) == sorted([("a", f"h{i}", "fail" if i == 12 else "ok") for i in range(13)] + [("b", "h0", "ok")])
    files = [r.batch.rsplit("/", 2)[1] for r in rows if r.host == "a"]
    assert max(map(files.count, files)) <= 4

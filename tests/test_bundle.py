"""Bundles and runs of workers on small fixtures."""

from threadloom.functions import pages
from threadloom.operators import bundle, worker


def test_entries_by_type(spark):
    d = spark.createDataFrame([('{"entries": ["a/b", "", "/x", "\\\\x", "a/../b", "a\\\\..\\\\b", "a\\\\b", ".", "..x", ".../y", null, 3]}',)], "json string")
    got = {r.entry: r.problem for r in bundle.entries(d).collect()}
    assert got == {"a/b": None, "": "not-a-path", "/x": "absolute", "\\x": "absolute", "a/../b": "escapes", "a\\..\\b": "escapes", "a\\b": None, ".": "escapes", "..x": None, ".../y": None, None: "not-a-path"}
    for json, want in (("{}", []), ('{"entries": null}', []), ('{"entries": []}', []), ('{"entries": "a"}', ["not-a-list"]), ("{", ["unreadable"])):
        assert [r.problem for r in bundle.entries(spark.createDataFrame([(json,)], "json string")).collect()] == want


def test_layout(spark):
    def status(*paths):
        return {r.check: (r.status, r.n) for r in bundle.layout(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}

    assert status() == {"required_files": ("FAIL", 3), "html_shards": ("FAIL", 0), "images": ("FAIL", 0), "sample_pages": ("FAIL", 0)}
    good = ["MANIFEST.json", "MANIFEST.sha256", "redis/baseline.rdb", "stage/html/0a/1/index.html", "stage/html/zz/1/index.html", "stage/images/x"]
    assert status(*good) == {"required_files": ("PASS", 0), "html_shards": ("PASS", 1), "images": ("PASS", 1), "sample_pages": ("PASS", 1)}
    # The only page stands behind three other entries of its shard.
    late = ["stage/html/0a/1/a", "stage/html/0a/2/a", "stage/html/0a/3/a", "stage/html/0a/4/index.html"]
    assert status(*late)["sample_pages"] == ("FAIL", 0)


def test_checksums(spark):
    a, b = "a" * 64, "b" * 64
    files = spark.createDataFrame([("x", a), ("y", b)], "path string, sha256 string")
    sums = spark.createDataFrame([(f"{a}  ./x",), (f"{a.upper()} *y",), (f"{a}  z",), ("junk",), ("",), ("# note",)], "line string")
    assert {r.path: r.status for r in bundle.checksums(files, sums).collect()} == {"x": "ok", "y": "mismatch", "z": "missing", "junk": "malformed"}


def test_runs_go_on_behind_a_quota(spark):
    items = [("h%d" % i, i, i % 2) for i in range(10)]
    outcome = {4: worker.QUOTA, 5: "rejected"}
    state = spark.createDataFrame([("h0", "ok", 1, 1, "", -1), ("h2", "http_error", 0, 0, "e", -1)], "hash string, status string, bytes_in long, bytes_out long, error string, at long")
    seen = []
    for quota in (True, False):
        out = spark.createDataFrame([(h, i, w, outcome.get(i, "ok") if quota or i != 4 else "ok", 10, 5, "x" * 2000) for h, i, w in items], "hash string, at long, worker int, status string, bytes_in long, bytes_out long, error string")
        ran = worker.until_quota(worker.pending(out, state, "at"), "worker", "at")
        seen.append({r.worker: r.asDict() for r in worker.counters(ran, "worker").collect()})
        state = spark.createDataFrame(worker.after(state, ran, "at").collect(), state.schema)
    assert (seen[0][0]["seen"], seen[0][0]["ok"], seen[0][0]["quota"], seen[0][0]["bytes_in"]) == (2, 1, 1, 10)
    assert (seen[0][1]["seen"], seen[0][1]["ok"], seen[0][1]["rejected"]) == (5, 4, 1)
    assert (seen[1][0]["seen"], seen[1][0]["ok"], seen[1][1]["seen"]) == (3, 3, 1)
    got = {r.hash: (r.status, len(r.error)) for r in state.collect()}
    assert len(got) == 10 and got["h5"] == ("rejected", 1000) and all(v[0] == "ok" for k, v in got.items() if k != "h5")
    assert [r.at for r in worker.pending(out, state.limit(0), "at", 3).collect()] == [0, 1, 2]


def test_excerpt(spark):
    rows = spark.createDataFrame([("a\u00a0 b\x1fc <\"'&>",), ("word " * 60,), ("x" * 300,), ("",)], "t string").select(pages.excerpt(pages.F.col("t")).alias("e")).collect()
    assert [r.e for r in rows] == ["a b c &lt;&quot;&#x27;&amp;&gt;", "word " * 49 + "word…", "x" * 250 + "…", ""]

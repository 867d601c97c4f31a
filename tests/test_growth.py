"""Steps whose share of one process must not grow with the tables."""

import json
import time
from types import SimpleNamespace

from pyspark.sql import functions as F

from threadloom.functions import records
from threadloom.llm import collocations, line_dedup
from threadloom.operators import audit, recovery, rescue
from threadloom.plans import bindings, pictures
from threadloom.sources import nested, packed
from threadloom.streaming import fetching


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_digests_of_files_are_not_broadcast(spark):
    files = spark.range(20).select(F.col("id").cast("string").alias("dir"), F.lit("a.html").alias("name"), F.lit("11").alias("sha256"))
    found = audit.manifest_digests(files.select("dir", F.lit('{"a_sha256": "11"}').alias("json")), files)
    assert "BroadcastHashJoin" not in plan(found)
    assert found.where("matches").count() == 20


def test_phrases_are_not_broadcast(spark):
    rows = [("en", "a", 1, 60), ("en", "b", 1, 40), ("en", "a b", 2, 35), ("en", "a b a", 3, 30), ("en", "b a", 2, 30)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, k int, c bigint")
    scored, covered = collocations.scored(counts), collocations.covered(counts, 80)
    assert "BroadcastHashJoin" not in plan(scored) + plan(covered)
    assert {r.phrase: (r.l, r.r, r.score) for r in scored.collect()} == {"a b": (60, 40, 700_000), "b a": (40, 60, 600_000), "a b a": (35, 60, 631_578)}
    assert {r.phrase for r in covered.collect()} == {"a b", "b a"}


def test_archives_and_tasks_are_bounded(spark, tmp_path, monkeypatch):
    text = lambda c: F.lit(c).cast("string")
    path = F.concat(F.lit("questions/"), F.col("id").cast("string"))
    items = spark.range(600).select(F.lit("C").alias("namespace"), path.alias("path"), F.lit("t").alias("title"), F.lit("text/html").alias("mime"), F.encode(path, "utf-8").alias("content"), text(None).alias("target"))
    short = spark.range(0, 600, 3).select(F.lit("C").alias("namespace"), F.concat(F.lit("a/"), F.col("id").cast("string")).alias("path"), F.lit("").alias("title"), text(None).alias("mime"), F.lit(None).cast("binary").alias("content"), path.alias("target"))
    packed.write_packed(items.unionByName(short), f"file://{tmp_path}", 2, archive_bytes=100_000)
    counts = [r.entry_count for r in packed.heads(spark, f"file://{tmp_path}").collect()]
    assert len(counts) > 6 and sum(counts) == 800 and max(counts) < 250
    monkeypatch.setattr(packed, "TASKS", 3)
    reader = packed.PackedReader({"path": f"file://{tmp_path}", "splitentries": "10"})
    runs = [r for p in reader.partitions() for r in p.runs]
    assert len(reader.partitions()) <= 3 and sum(r.high - r.low for r in runs) == 800
    listing = packed.entries(spark, f"file://{tmp_path}", content=True, split_entries=10)
    got = packed.with_targets(listing, packed.entries(spark, f"file://{tmp_path}")).collect()
    assert {r.path: r.target for r in got if r.kind == "redirect"} == {f"a/{i}": f"questions/{i}" for i in range(0, 600, 3)}
    assert {r.path: bytes(r.content).decode() for r in got if r.kind == "item"} == {f"questions/{i}": f"questions/{i}" for i in range(600)}


def test_costly_columns_are_dealt_to_tasks(spark, tmp_path):
    rows = spark.range(30).select(F.lit("h").alias("hash"), F.col("id").alias("seq"), F.concat(F.lit("https://i.imgur.com/"), F.col("id"), F.lit(".png")).alias("source_url"), F.lit("").alias("source_class"))
    edges = recovery.edge_candidates(rows.coalesce(1))
    assert "REPARTITION_BY_COL" in plan(edges) and "size(array_append" not in plan(edges)
    assert edges.select("url").distinct().count() >= 30
    spark.range(1, 13).coalesce(1).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    sizes = pictures.image_limits(spark, str(tmp_path))
    assert "REPARTITION_BY_COL" in plan(sizes)
    assert {r.p_partkey: (r.width, r.height) for r in sizes.collect()} == {k: (1 + k * 37, 1 + k * 91) for k in range(1, 13)}


def test_beginnings_of_lines_are_counted_not_joined(spark):
    base = "a line of which there are very many near copies, each with a change of its own somewhere"
    lines = [base] * 2 + [f"{base[:k]}#{base[k + 1 :]}" for k in range(0, 80, 2)]
    rows = spark.createDataFrame([(7, i, x) for i, x in enumerate(lines)], "_list long, _h long, _line string")
    heads = line_dedup.typical(rows)
    joins = [x for x in plan(heads).splitlines() if "Join" in x]
    assert len(joins) == 1 and "_cut" not in joins[0].split("Inner")[0]
    assert [(r._list, lines[r._head]) for r in heads.collect()] == [(7, base)]


def test_keys_of_lines_are_shuffled_once(spark):
    rows = [(1, 10, 40), (1, 11, -41), (2, 10, 40), (2, 10, 40), (3, 10, -40), (3, 12, -41), (4, 13, -40), (4, 13, 40), (4, 14, -40)]
    shared = line_dedup.shared_keys(spark.createDataFrame(rows, "_key long, _h long, _x int"))
    got = {(r._key, r._h, r._len, r._index) for r in shared.collect()}
    assert got == {(1, 10, 40, True), (1, 11, 41, False), (4, 13, 40, True), (4, 14, 40, False)}
    final = plan(shared).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "BroadcastHashJoin" not in final


def test_elements_of_a_dump_are_parsed_once(spark, tmp_path):
    posts = '<post Id="1"/><post Id="2" Score="3"/><post Id="3" Title="t"><answers><answer Id="5" Score="1"/><answer Id="4" Score="2"/></answers></post><post Id="4"><broken></post>'
    (tmp_path / "a.xml").write_text(posts)
    good, bad = nested.questions(spark, f"file://{tmp_path}")
    optimized = good._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_xml(") == 1 and optimized.count("regexp_replace(") == 1 and optimized.count("regexp_extract_all(") == 1
    assert {(r.Id, r.Score, tuple(a.Id for a in r.answers)) for r in good.collect()} == {(1, 0, ()), (2, 3, ()), (3, 0, (4, 5))}
    assert [r._corrupt_record for r in bad.collect()] == ['<post Id="4"><broken></post>']


def test_titles_go_through_python_only_where_they_must(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        texts = [None, "", "ab", " a\tb \n c ", "x" * 700, "\x00ti  tle\x7f", "ﬁne  one", "été", "​ab", "é" * 700, "  ab  c"]
        d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        out = d.select("doc_id", records.sanitize_title(spark, F.col("text"), "doc_id").alias("title"))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= records.TITLE_ROWS
        assert {r.doc_id: r.title for r in out.collect()} == {i: records.clean_title(x, f"Question {i}") for i, x in enumerate(texts)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


class Kept:
    """Map and value state of one key, which counts the items that are read."""

    def __init__(self):
        self.map, self.value, self.read = {}, None, 0

    def getMapState(self, *_):
        return Kept()

    getValueState = getMapState

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, k):
        return k in self.map

    def updateValue(self, k, v):
        self.map[k] = v

    def getValue(self, k):
        self.read += len(self.map[k][0])
        return self.map[k]

    def removeKey(self, k):
        del self.map[k]

    def iterator(self):
        self.read += len(self.map)
        return iter(list(self.map.items()))

    def listTimers(self):
        return []

    def registerTimer(self, _):
        pass

    def getCurrentProcessingTimeInMs(self):
        return int(time.time() * 1000) + 1000


def test_a_host_s_open_items_are_not_read_in_every_batch():
    tried = []
    f = fetching.Fetching(lambda url, k: tried.append((url, k)) or ((200 if k == 2 or url == "u7" else 503), b"", None), 2, 0.001, 0.0, False, 10)
    state = Kept()
    f.init(state)
    rows = [SimpleNamespace(hash=f"h{i % 400}", url=f"u{i % 400}") for i in range(800)]
    out = list(f.handleInputRows(("host",), iter(rows), state))
    for _ in range(200):
        out += list(f.handleExpiredTimer(("host",), state, None))
    assert sorted(r.hash for r in out) == sorted(f"h{i}" for i in range(400)) and all(r.status == "ok" and r.attempts == (1 if r.url == "u7" else 3) for r in out)
    assert len(tried) == 1 + 399 * 3 and tried[:400] == [(f"u{i}", 0) for i in range(400)]
    assert sum(x.read for x in vars(f).values() if isinstance(x, Kept)) < 4 * len(tried)


def test_addresses_are_not_broadcast(spark):
    rows = [("a", 0, "u0"), ("a", 1, "u1"), ("b", 0, "u2")]
    open_ = spark.createDataFrame([(h, p, u, "x", None, False) for h, p, u in rows], "hash string, pos long, url string, source_class string, status string, page boolean")
    answers = spark.createDataFrame([("u0", "http_error"), ("u1", "ok")], "url string, status string")
    tried = rescue._tried(open_, lambda urls: answers, 2)
    assert "BroadcastHashJoin" not in plan(tried) + plan(rescue._with_pages(open_, tried, 3))
    assert {(r.hash, r.url, r.status) for r in tried.collect()} == {("a", "u0", "http_error"), ("a", "u1", "ok"), ("b", "u2", "failed")}


def test_escapes_are_looked_for_once_and_backslashes_are_text(spark):
    texts = [None, "", "a\x1f\x1fb", "\\u001F", "\\\x1f", "\\\\u001F\x0b", '\x00\x0e"\n\x7f\u2028 é', "\\" * 20001 + "\x1a", "u00 \\u00"]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", records.canonical_json(F.struct("t")).alias("j"))
    assert {r.i: r.j for r in d.collect()} == {i: json.dumps({"t": t}, separators=(",", ":"), ensure_ascii=False) for i, t in enumerate(texts)}
    assert "CASE WHEN Contains(" in plan(d)


def test_answers_of_a_post_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame([(k, k, "O", 1.5, "p") for k in range(4)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 2, 0.5), (1, 2, 0.75), (1, 1, 0.25), (3, 1, 2.0)], "l_orderkey long, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    posts = bindings.posts(spark, str(tmp_path))
    assert plan(posts.select("answers")).count("Exchange hashpartitioning(post") == 1 and "l_linenumber#" not in "".join(x for x in plan(posts).splitlines() if "Exchange" in x)
    answers = {r.Id: sorted((a.Id, a.Score, a.Body, a.comments) for a in r.answers or []) for r in posts.collect()}
    assert answers == {0: [], 1: [("1", "25", "a", []), ("2", "75", "a", [])], 2: [], 3: [("1", "200", "a", [])]}

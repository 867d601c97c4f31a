"""Audits, state sets, byte kinds and page fields on the driver's tables: a query and its SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import media, pages, records, urls
from ..operators import archive, audit, incremental, recovery
from .bindings import query, t

MANIFEST_SQL = """(SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN '{"answer_redirects":[1]}' WHEN 1 THEN '{"answer_redirects":3}' WHEN 2 THEN 'x' WHEN 3 THEN '{"answer_redirects":[]}' ELSE NULL END AS j FROM orders)"""


def manifests_of(spark, d):
    k = F.col("o_orderkey")
    j = F.when(k % 5 == 0, '{"answer_redirects":[1]}').when(k % 5 == 1, '{"answer_redirects":3}').when(k % 5 == 2, "x").when(k % 5 == 3, '{"answer_redirects":[]}')
    return t(spark, d, "orders").select(F.lpad(k.cast("string"), 12, "0").alias("path"), j.alias("json"))


@query("audit_redirects", f"""
SELECT 'answer_redirects' AS check, 'FAIL' AS status, count(*) FILTER (k % 5 IN (1, 2, 4)) AS n FROM {MANIFEST_SQL}
UNION ALL SELECT 'answer_redirects', CASE WHEN count(*) FILTER (k % 5 IN (1, 2, 4)) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FILTER (k % 5 IN (1, 2, 4)) FROM (SELECT k, row_number() OVER (ORDER BY lpad(k::VARCHAR, 12, '0')) - 1 AS pos, count(*) OVER () AS total FROM {MANIFEST_SQL})
WHERE pos IN (SELECT (i * (SELECT count(*) FROM orders)) // 47 FROM range(47) r(i))
UNION ALL SELECT 'answer_redirects', 'WARN', 0""")
def audit_redirects(spark, d):
    """Strict, by an even sample of 47, and without any manifest."""
    m = manifests_of(spark, d)
    return audit.report(audit.answer_redirects(m), audit.answer_redirects(m, 47), audit.answer_redirects(m.where("false")))


PAYLOADS = {0: "89504E470D0A1A0A", 1: "FFD8FFE0", 2: "474946383961", 3: "52494646AAAAAAAA57454250", 4: "424D0000", 5: "00000100", 6: "20203C7376673E", 7: "3C68746D6C3E", 8: "DEADBEEF", 9: ""}
EXTENSIONS = [".png", ".jpg", ".gif", ".webp", ".html"]


def payloads(spark, d):
    k = F.col("p_partkey")
    code = F.get(F.array(*[F.lit(PAYLOADS[i]) for i in range(10)]), (k % 10).cast("int"))
    ext = F.get(F.array(*map(F.lit, EXTENSIONS)), (F.floor(k / 10) % 5).cast("int"))
    return t(spark, d, "part").select("p_partkey", F.concat(k.cast("string"), ext).alias("name"), F.unhex(code).alias("content"), ext.alias("ext"))


KIND = {0: "image/png", 1: "image/jpeg", 2: "image/gif", 3: "image/webp", 4: "image/bmp", 5: "image/x-icon"}
CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in KIND.items())


@query("sniff_kinds", f"""
SELECT p_partkey, CASE p_partkey % 10 {CASE} WHEN 6 THEN 'image/svg+xml' ELSE 'unknown' END AS kind,
  CASE p_partkey % 10 {CASE} WHEN 6 THEN 'image/svg+xml' WHEN 7 THEN 'text/html' WHEN 9 THEN 'empty' ELSE 'unknown' END AS payload, p_partkey % 10 < 6 AS valid FROM part""")
def sniff_kinds(spark, d):
    """Both rules for kinds of bytes, and whether they are an image."""
    c = F.col("content")
    return payloads(spark, d).select("p_partkey", media.sniff(c).alias("kind"), media.sniff_payload(c).alias("payload"), media.is_valid_image(c).alias("valid"))


@query("payload_validation", f"""
WITH p AS (SELECT p_partkey, CASE p_partkey % 10 {CASE} WHEN 6 THEN 'image/svg+xml' WHEN 7 THEN 'text/html' WHEN 9 THEN 'empty' ELSE 'unknown' END AS mime, p_partkey % 10 AS k FROM part)
SELECT p_partkey, mime, CASE WHEN k = 9 THEN 'empty' WHEN k = 3 THEN 'too-large' WHEN k IN (6, 7, 8) THEN 'not-an-image:' || mime ELSE '' END AS reason FROM p""")
def payload_validation(spark, d):
    v = media.validate_payload(F.col("content"), 11)
    return payloads(spark, d).select("p_partkey", v.alias("v")).select("p_partkey", "v.mime", "v.reason")


@query("audit_magic", """
WITH p AS (SELECT p_partkey % 10 AS k, (p_partkey // 10) % 5 AS e FROM part)
SELECT 'mime_sample' AS check, 'FAIL' AS status, count(*) FILTER (NOT CASE e WHEN 0 THEN k = 0 WHEN 1 THEN k = 1 WHEN 2 THEN k = 2 WHEN 3 THEN k = 3 ELSE k IN (6, 7) END) AS n FROM p
UNION ALL SELECT 'mime_sample', 'PASS', 0 UNION ALL SELECT 'mime_sample', 'WARN', 0""")
def audit_magic(spark, d):
    p = payloads(spark, d)
    return audit.report(audit.magic_sample(p), audit.magic_sample(p.where("endswith(name, '0.png') and p_partkey % 100 = 0")), audit.magic_sample(p.where("false")))


@query("audit_digests", """
WITH m AS (SELECT c_custkey AS k FROM customer)
SELECT 'input_hashes' AS check, 'FAIL' AS status, (SELECT count(*) FROM m WHERE k % 4 = 1) + (SELECT count(*) FROM m WHERE k % 2 = 1) AS n
UNION ALL SELECT 'input_hashes', 'PASS', 0 UNION ALL SELECT 'input_hashes', 'INFO', 0""")
def audit_digests(spark, d):
    """Digests of a page (found as page.html, with a better named file for odd keys) and of data.json; some are wrong, some have no
    file."""
    k = F.col("c_custkey")
    c = t(spark, d, "customer").select(k.cast("string").alias("dir"), k.alias("k"))
    good = F.sha2(F.concat(F.lit("p"), F.col("k").cast("string")), 256)
    json = F.to_json(F.struct(F.upper(good).alias("page_sha256"), F.when(F.col("k") % 4 == 1, "00").otherwise(good).alias("data_sha256"), F.lit("11").alias("lost_sha256"), F.lit("").alias("none_sha256")))
    files = c.select("dir", F.lit("page.html").alias("name"), good.alias("sha256")).unionByName(c.select("dir", F.lit("data.json").alias("name"), good.alias("sha256")))
    files = files.unionByName(c.where("k % 2 = 1").select("dir", F.lit("page").alias("name"), F.lit("22").alias("sha256")))
    found = audit.manifest_digests(c.select("dir", json.alias("json")), files)
    return audit.report(audit.input_hashes(found), audit.input_hashes(found.where("matches")), audit.input_hashes(found.where("false")))


@query("audit_state", """
SELECT 'state' AS check, 'PASS' AS status, 3::BIGINT AS n UNION ALL SELECT 'state_orders', 'PASS', count(*) FROM orders UNION ALL SELECT 'state_none', 'FAIL', 0 UNION ALL SELECT 'state_unknown', 'FAIL', 0
UNION ALL SELECT 'state', 'FAIL', 2 UNION ALL SELECT 'state', 'INFO', 0""")
def audit_state(spark, d):
    sets = t(spark, d, "orders").agg(F.count(F.lit(1)).alias("value")).select(F.lit("orders").alias("key"), "value")
    sets = sets.unionByName(t(spark, d, "orders").where("o_orderkey < 0").agg(F.count(F.lit(1)).alias("value")).select(F.lit("none").alias("key"), "value"))
    return audit.report(audit.cardinalities(sets, ["orders", "none", "unknown"]), audit.cardinalities(sets, ["a", "b"], reachable=False), audit.cardinalities(sets, []))


ENTRIES_SQL = "(SELECT 'questions/' || o_orderkey || '/x' AS path FROM orders UNION ALL SELECT 'tags' UNION ALL SELECT 'index.html')"


@query("audit_archive", """
SELECT 'magic' AS check, 'PASS' AS status, 72173914::BIGINT AS n UNION ALL SELECT 'entry_count', CASE WHEN count(*) > 13500 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM orders
UNION ALL SELECT 'magic', 'WARN', 1 UNION ALL SELECT 'entry_count', 'FAIL', 0 UNION ALL SELECT 'magic', 'FAIL', 0 UNION ALL SELECT 'entry_count', 'FAIL', 0
UNION ALL SELECT 'required_paths', 'WARN', 1 UNION ALL SELECT 'required_paths', 'PASS', 0 UNION ALL SELECT 'required_paths', 'WARN', 0 UNION ALL SELECT 'degraded', 'WARN', 0
UNION ALL SELECT 'content_sample', CASE WHEN count(*) FILTER (p_partkey % 10 IN (0, 1, 3, 8, 9)) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FILTER (p_partkey % 10 IN (0, 1, 3, 8, 9)) FROM part
UNION ALL SELECT 'content_sample', 'WARN', 0 UNION ALL SELECT 'checker', 'PASS', 0 UNION ALL SELECT 'checker', 'FAIL', -1""")
def audit_archive(spark, d):
    n = t(spark, d, "orders").count()
    paths = t(spark, d, "orders").select(F.concat(F.lit("questions/"), "o_orderkey", F.lit("/x")).alias("path"))
    paths = paths.unionByName(archive.fixed_entries(spark, ["tags", "index.html"]).select("path"))
    homes = ["index"]
    return audit.report(
        audit.archive_header(spark, {"magic": audit.ARCHIVE_MAGIC, "entry_count": n}, 15_000), audit.archive_header(spark, {"magic": 1, "entry_count": 0}, 10, tolerate=True), audit.archive_header(spark, None, 1),
        audit.required_paths(paths, spark, ["tags", "users"], homes), audit.required_paths(paths, spark, ["tags"], homes), audit.required_paths(None, spark, ["tags"], homes),
        audit.content_sample(payloads(spark, d).select(F.col("name").alias("path"), "content"), spark), audit.content_sample(None, spark), audit.checker(spark, 0), audit.checker(spark, None),
    )


@query("audit_snapshot", """
SELECT 'pages' AS check, CASE WHEN abs(count(*) - 15000) * 50 <= 15000 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n FROM orders UNION ALL SELECT 'images', CASE WHEN abs(count(*) - 25) * 50 <= 25 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM nation
UNION ALL SELECT 'state_keys', 'WARN', 0 UNION ALL SELECT 'done', 'WARN', 5 UNION ALL SELECT 'done', 'FAIL', 1000
UNION ALL SELECT 'structure', 'PASS', 2 UNION ALL SELECT 'structure_pages', 'PASS', count(*) FILTER (c_custkey % 3 = 0 AND c_custkey % 2 = 0) FROM customer
UNION ALL SELECT 'marker', 'PASS', 0 UNION ALL SELECT 'staged_pages', 'FAIL', 0 UNION ALL SELECT 'state', 'PASS', 0 UNION ALL SELECT 'snapshot', 'PASS', 0 UNION ALL SELECT 'free_space', 'FAIL', 149""")
def audit_snapshot(spark, d):
    def one(table, name):
        return t(spark, d, table).agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")

    def known(name, value):
        return spark.range(1).select(F.lit(name).alias("metric"), F.lit(value).cast("bigint").alias("value"))

    counts = one("orders", "pages").unionByName(one("nation", "images")).unionByName(known("state_keys", None)).unionByName(known("done", 5))
    k = F.col("c_custkey")
    folders = t(spark, d, "customer").select(F.when(k % 3 == 0, "0a").when(k % 3 == 1, "ff").otherwise("zz").alias("shard"), k.alias("post"), ((k % 3 == 0) & (k % 2 == 0)).alias("has_page"))
    return audit.report(
        audit.snapshot(counts, {"pages": 15_000, "images": 25, "state_keys": 9}), audit.snapshot(known("done", 1000), {"pages": 10_000_000}), audit.structure(folders),
        audit.preflight(spark, True, 0, True, True, 149, 100),
    )


@query("seen_set", """
SELECT 's2' AS snapshot_id, o_orderkey AS post_id FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 UNION ALL SELECT 's1', o_orderkey FROM orders WHERE o_orderkey % 7 = 0""")
def seen_set(spark, d):
    """A pass begins anew, posts are marked twice, another snapshot's marks stay."""
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id"))
    seen = o.where("post_id % 7 = 0").withColumn("snapshot_id", F.lit("s1")).unionByName(o.withColumn("snapshot_id", F.lit("s2")))
    seen = incremental.begin_seen(seen.select("snapshot_id", "post_id"), "s2")
    marked = incremental.mark_seen(incremental.mark_seen(seen, "s2", o.where("post_id % 3 = 0")), "s2", o.where("post_id % 5 = 0"))
    return incremental.members_seen(marked, "s2").select(F.lit("s2").alias("snapshot_id"), "post_id").unionByName(incremental.members_seen(marked, "s1").select(F.lit("s1").alias("snapshot_id"), "post_id"))


@query("done_after_resume", "SELECT o_orderkey AS post_id FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0")
def done_after_resume(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id"))
    done = o.where("post_id % 2 = 0")
    return incremental.after_resume(done, incremental.resume(o, done, o.where("post_id % 3 = 0")))


@query("staged_page_fields", """
SELECT c_custkey, 'Name ' || c_custkey || ' & more' AS excerpt, CASE WHEN c_custkey % 2 = 0 THEN 'user' || c_custkey END AS owner, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2021-03-05 10:20:00' END AS created,
  CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 9 END AS answers, CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 5 = 0 END AS accepted, CASE WHEN c_custkey % 4 > 0 THEN 'a,b-' || c_custkey END AS tags FROM customer""")
def staged_page_fields(spark, d):
    k = F.col("c_custkey").cast("string")
    n = (F.col("c_custkey") % 9).cast("string")
    tag = lambda x: F.concat(F.lit('<a href="../../questions/tagged/'), x, F.lit('" class="post-tag">t</a>'))
    html = F.concat(
        F.lit('<div class="s-prose js-post-body" itemprop="text"><p>Name '), k, F.lit("</p>\n <b>&</b> more</div>"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('<time class="s-user-card--time" datetime="asked Mar 05 \'21 at 10:20">x</time><div class="s-user-card--info"> <a href="u">user'), k, F.lit("</a></div>"))).otherwise(""),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('<span itemprop="answerCount">'), n, F.lit("</span>"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('<div data-answercount="'), n, F.lit('">'))).otherwise(""),
        F.when(F.col("c_custkey") % 5 == 0, "accepted-answer").otherwise(""), F.when(F.col("c_custkey") % 4 > 0, F.concat(tag(F.lit("a")), tag(F.concat(F.lit("b-"), k)))).otherwise(""),
    )
    f = t(spark, d, "customer").select("c_custkey", pages.staged_fields(html).alias("f"))
    return f.select("c_custkey", "f.excerpt", F.col("f.owner_user_id").alias("owner"), F.col("f.creation_date").cast("timestamp_ntz").alias("created"), F.col("f.nb_answers").alias("answers"), F.col("f.has_accepted").alias("accepted"), F.array_join("f.tags", ",").alias("tags"))


@query("tag_id_names", """
SELECT c_custkey, string_agg(n_name, ',' ORDER BY pos) AS tags FROM (SELECT c_custkey, pos, (c_custkey * (pos + 1)) % 40 AS id FROM customer, range(3) r(pos)) LEFT JOIN nation ON n_nationkey = id GROUP BY c_custkey""")
def tag_id_names(spark, d):
    ids = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: (F.col("c_custkey") * i) % 40)
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("post_id"), ids.alias("tags"))
    out = incremental.tag_names(c, t(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("tag_id"), F.col("n_name").alias("name")))
    return out.select(F.col("post_id").alias("c_custkey"), F.nullif(F.array_join("tags", ","), F.lit("")).alias("tags"))


@query("bundle_entries", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'absolute' WHEN 2 THEN 'escapes' WHEN 3 THEN 'not-a-path' END AS problem FROM part""")
def bundle_entries(spark, d):
    k = F.col("p_partkey")
    path = F.when(k % 5 == 0, F.concat(F.lit("stage/"), k)).when(k % 5 == 1, F.concat(F.lit("/etc/"), k)).when(k % 5 == 2, F.concat(F.lit("a/../../"), k)).when(k % 5 == 4, F.lit("a\\\\b"))
    return t(spark, d, "part").select("p_partkey", urls.bundle_entry_problem(path).alias("problem"))


@query("prune_problems", """
SELECT p_partkey AS post_id, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'not-numeric' WHEN 2 THEN 'id-mismatch' ELSE 'wrong-shard' END AS problem FROM part""")
def prune_problems(spark, d):
    k = F.col("p_partkey")
    path = F.when(k % 4 == 0, F.concat(F.lit("00/"), k)).when(k % 4 == 1, F.concat(F.lit("00/x"), k)).when(k % 4 == 2, F.concat(F.lit("00/"), k + 1)).otherwise(F.concat(F.lit("7f/"), k))
    return incremental.prune_problem(t(spark, d, "part").select(k.alias("post_id"), path.alias("path"))).select("post_id", "problem")


@query("shard_members", """
SELECT p_partkey, CASE WHEN s = 3 THEN 'missing_zip' WHEN s = 2 THEN 'error' WHEN p_partkey % 3 = 2 THEN 'missing_member' ELSE 'ok' END AS status, CASE WHEN s < 2 AND p_partkey % 3 < 2 THEN 'new' || p_partkey END AS content FROM (SELECT p_partkey, p_partkey % 4 AS s FROM part)""")
def shard_members(spark, d):
    """A member that stands twice in its shard, missing ones, missing shards and one that can't be read."""
    k = F.col("p_partkey")
    rows = t(spark, d, "part").select(k.alias("hash"), F.concat(F.lit("s"), k % 4).alias("shard"), F.concat(k.cast("string"), F.lit(".png")).alias("basename"))
    have = rows.where("hash % 4 < 2 and hash % 3 < 2")
    member = lambda pos, name: have.select("shard", "basename", F.lit(pos).cast("bigint").alias("pos"), F.concat(F.lit(name), "hash").cast("binary").alias("content"), F.lit(None).cast("string").alias("error"))
    bad = spark.range(1).select(F.lit("s2").alias("shard"), F.lit(None).cast("string").alias("basename"), F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("content"), F.lit("no zip").alias("error"))
    out = recovery.shard_members(rows, member(1, "old").unionByName(member(2, "new")).unionByName(bad))
    return out.select(F.col("hash").alias("p_partkey"), "status", F.col("content").cast("string").alias("content"))


@query("old_sizes", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN p_size WHEN p_partkey % 3 = 0 THEN 0 WHEN p_partkey % 3 = 1 THEN 0 ELSE 7 END AS old_bytes, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN md5(p_name) WHEN p_partkey % 3 = 1 THEN 'd' ELSE '' END AS old_sha256 FROM part""")
def old_sizes(spark, d):
    k = F.col("p_partkey")
    p = t(spark, d, "part")
    small = p.select(k.alias("hash"), F.when(k % 3 == 2, 7).otherwise(0).alias("old_bytes"), F.when(k % 3 == 1, "d").otherwise("").alias("old_sha256"))
    return recovery.old_sizes(small, p.where("p_partkey % 2 = 0").select(k.alias("hash"), F.col("p_size").alias("size"), F.md5("p_name").alias("sha256"))).withColumnRenamed("hash", "p_partkey")


@query("recovery_totals", """
WITH i AS (SELECT DISTINCT l_partkey AS h FROM lineitem), r AS (SELECT DISTINCT l_partkey AS h FROM lineitem WHERE l_quantity > 45)
SELECT (SELECT count(*) FROM i) AS initial, (SELECT count(*) FROM r) AS recovered, round(100.0 * (SELECT count(*) FROM r) / (SELECT count(*) FROM i), 1)::DOUBLE AS percent,
  (SELECT count(*) FROM lineitem) AS total, (SELECT count(*) FROM i) AS "distinct", (SELECT count(*) FROM i WHERE h % 2 = 0) AS before, (SELECT count(*) FROM i WHERE h % 10 = 0) AS after""")
def recovery_totals(spark, d):
    """Recovery rate, totals of references, placeholders before and after."""
    li = t(spark, d, "lineitem").select(F.col("l_partkey").alias("hash"), "l_quantity")
    listing = t(spark, d, "part").select(F.col("p_partkey").alias("hash"))
    twins = recovery.twins_before_after(li, listing.withColumn("placeholder", F.expr("hash % 2 = 0")), listing.withColumn("placeholder", F.expr("hash % 10 = 0")))
    return recovery.recovery_rate(li, li.where("l_quantity > 45")).join(recovery.reference_totals(li)).join(twins)  # single rows


@query("grouped_rows", """
SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ' ' ORDER BY l_linenumber, l_partkey) AS rows FROM lineitem GROUP BY l_orderkey""")
def grouped_rows(spark, d):
    g = recovery.grouped(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", ["l_partkey"])
    return g.select("l_orderkey", F.array_join(F.transform("rows", lambda r: F.concat(r["l_linenumber"].cast("string"), F.lit(":"), r["l_partkey"].cast("string"))), " ").alias("rows"))


@query("namespace_strip", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN '9/' || p_partkey ELSE p_partkey::VARCHAR END AS path FROM part")
def namespace_strip(spark, d):
    k = F.col("p_partkey")
    return t(spark, d, "part").select("p_partkey", records.strip_namespace(F.when(k % 3 == 0, F.concat(F.lit("A/"), k)).when(k % 3 == 1, k.cast("string")).otherwise(F.concat(F.lit("9/"), k))).alias("path"))


@query("top_users", """
SELECT c_custkey AS user_id, c_name AS name, (c_custkey * 7) % 101 AS score FROM customer ORDER BY score DESC, user_id LIMIT 10""")
def top_users(spark, d):
    """A top-k report; its table without rows gives one row that says so (unit tests)."""
    return archive.top_users(t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), ((F.col("c_custkey") * 7) % 101).alias("score")), 10)

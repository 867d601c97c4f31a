"""Bundles and runs of workers on the driver's tables: a query and its SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pages
from ..operators import bundle, worker
from .bindings import query, t

FILES_SQL = """f AS (SELECT 'stage/html/' || substr(md5(o_orderkey::VARCHAR), 1, 2) || '/' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '/other.html' ELSE '/index.html' END AS path FROM orders
  UNION ALL SELECT 'stage/images/' || md5(p_name) FROM part UNION ALL SELECT CASE n_nationkey WHEN 0 THEN 'MANIFEST.json' WHEN 1 THEN 'MANIFEST.sha256' ELSE 'assets/' || n_name END FROM nation)"""


def bundle_files(spark, d):
    k = F.col("o_orderkey").cast("string")
    html = F.concat(F.lit("stage/html/"), F.substring(F.md5(k), 1, 2), F.lit("/"), k, F.when(F.col("o_orderkey") % 3 == 0, "/other.html").otherwise("/index.html"))
    n = F.col("n_nationkey")
    top = F.when(n == 0, "MANIFEST.json").when(n == 1, "MANIFEST.sha256").otherwise(F.concat(F.lit("assets/"), "n_name"))
    out = t(spark, d, "orders").select(html.alias("path")).unionByName(t(spark, d, "part").select(F.concat(F.lit("stage/images/"), F.md5("p_name")).alias("path")))
    return out.unionByName(t(spark, d, "nation").select(top.alias("path")))


@query("bundle_layout", f"""
WITH {FILES_SQL}, h AS (SELECT split_part(path, '/', 3) AS shard, split_part(path, '/', 4) AS post, path LIKE '%/index.html' AS page FROM f WHERE path LIKE 'stage/html/%'),
few AS (SELECT page FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY post) AS rn FROM h WHERE shard IN (SELECT DISTINCT shard FROM h ORDER BY 1 LIMIT 3)) WHERE rn <= 3),
c AS (SELECT 'required_files' AS check, 3 - count(DISTINCT path) AS n FROM f WHERE path IN ('MANIFEST.json', 'MANIFEST.sha256', 'redis/baseline.rdb')
  UNION ALL SELECT 'html_shards', count(DISTINCT shard) FROM h UNION ALL SELECT 'images', count(*) FROM f WHERE path LIKE 'stage/images/%' UNION ALL SELECT 'sample_pages', count(*) FILTER (page) FROM few)
SELECT "check", CASE WHEN (n > 0) = ("check" <> 'required_files') THEN 'PASS' ELSE 'FAIL' END AS status, n::BIGINT AS n FROM c""")
def bundle_layout(spark, d):
    """A bundle that lacks one required file."""
    return bundle.layout(bundle_files(spark, d))


@query("bundle_checksums", """
SELECT CASE WHEN c_custkey % 10 = 5 THEN left(sha256(c_name), 60) || '  assets/' || c_custkey ELSE 'assets/' || c_custkey END AS path,
  CASE c_custkey % 10 WHEN 3 THEN 'mismatch' WHEN 4 THEN 'missing' WHEN 5 THEN 'malformed' ELSE 'ok' END AS status FROM customer""")
def bundle_checksums(spark, d):
    """A line for each file, some wrong, cut or of files that aren't there."""
    c, k = t(spark, d, "customer"), F.col("c_custkey")
    path, digest = F.concat(F.lit("assets/"), k), F.sha2(F.col("c_name"), 256)
    files = c.where(k % 10 != 4).select(path.alias("path"), F.when(k % 10 == 3, F.sha2(F.col("c_mktsegment"), 256)).otherwise(digest).alias("sha256"))
    line = F.when(k % 10 == 5, F.concat(F.substring(digest, 1, 60), F.lit("  "), path)).when(k % 2 == 0, F.concat(F.upper(digest), F.lit(" *./"), path)).otherwise(F.concat(digest, F.lit("  "), path))
    return bundle.checksums(files, c.select(line.alias("line")))


@query("bundle_manifest", """
SELECT CASE WHEN p_partkey % 8 NOT IN (3, 7) THEN CASE p_partkey % 8 WHEN 1 THEN '/' || p_name WHEN 2 THEN 'a/../../' || p_name WHEN 4 THEN 'a' || chr(92) || p_name WHEN 5 THEN chr(92) || p_name WHEN 6 THEN './.'
  ELSE 'stage/' || p_name END END AS entry,
  CASE p_partkey % 8 WHEN 1 THEN 'absolute' WHEN 2 THEN 'escapes' WHEN 3 THEN 'not-a-path' WHEN 5 THEN 'absolute' WHEN 6 THEN 'escapes' WHEN 7 THEN 'not-a-path' END AS problem FROM part""")
def bundle_manifest(spark, d):
    """Entries of manifests, a manifest for each part, by the types of JSON."""
    k, name = F.col("p_partkey") % 8, F.col("p_name")
    entry = F.when(k == 1, F.concat(F.lit("/"), name)).when(k == 2, F.concat(F.lit("a/../../"), name)).when(k == 4, F.concat(F.lit("a\\"), name)).when(k == 5, F.concat(F.lit("\\"), name)).when(k == 6, "./.").otherwise(F.concat(F.lit("stage/"), name))
    json = F.when(k == 3, '{"entries": [null]}').when(k == 7, '{"entries": [7]}').otherwise(F.to_json(F.struct(F.array(entry).alias("entries"))))
    return bundle.entries(t(spark, d, "part").select(json.alias("json")))


RUN_SQL = """i AS (SELECT o_orderkey AS k, md5(o_orderkey::VARCHAR) AS hash, o_orderkey % 16 AS worker, o_custkey AS bytes_in, o_custkey // 2 AS bytes_out,
  CASE WHEN o_orderkey % 5003 = 4999 THEN 'quota_exhausted' WHEN o_orderstatus = 'O' THEN 'ok' WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'http_error' END AS status FROM orders),
p AS (SELECT * FROM i WHERE k % 5 <> 0), r AS (SELECT * FROM p WHERE k <= coalesce((SELECT min(q.k) FROM p q WHERE q.status = 'quota_exhausted' AND q.worker = p.worker), k))"""


def run_of(spark, d):
    """State and outcomes: orders as items of sixteen workers, a fifth of them had, a fifth failed before."""
    k = F.col("o_orderkey")
    o = t(spark, d, "orders").withColumn("hash", F.md5(k.cast("string")))
    state = o.where(k % 5 < 2).select("hash", F.when(k % 5 == 0, "ok").otherwise("http_error").alias("status"), F.lit(0).cast("long").alias("bytes_in"), F.lit(0).cast("long").alias("bytes_out"), F.lit(-1).cast("long").alias("at"))
    status = F.when(k % 5003 == 4999, worker.QUOTA).when(F.col("o_orderstatus") == "O", "ok").when(F.col("o_orderstatus") == "P", "rejected").otherwise("http_error")
    items = o.select("hash", k.cast("long").alias("at"), (k % 16).alias("worker"), status.alias("status"), F.col("o_custkey").cast("long").alias("bytes_in"), F.expr("cast(o_custkey div 2 as long)").alias("bytes_out"))
    return state, worker.until_quota(worker.pending(items, state, "at"), "worker", "at")


@query("worker_counters", f"""
WITH {RUN_SQL} SELECT worker, count(*) AS seen, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'quota_exhausted') AS quota,
  count(*) FILTER (status = 'http_error') AS fail, coalesce(sum(bytes_in) FILTER (status = 'ok'), 0)::BIGINT AS bytes_in, coalesce(sum(bytes_out) FILTER (status = 'ok'), 0)::BIGINT AS bytes_out FROM r GROUP BY worker""")
def worker_counters(spark, d):
    """What each worker counts, up to its quota."""
    return worker.counters(run_of(spark, d)[1], "worker")


@query("worker_state", f"""
WITH {RUN_SQL} SELECT i.hash, coalesce(r.status, CASE i.k % 5 WHEN 0 THEN 'ok' ELSE 'http_error' END) AS status, coalesce(r.bytes_out, 0)::BIGINT AS bytes_out
FROM i LEFT JOIN r USING (k) WHERE r.k IS NOT NULL OR i.k % 5 < 2""")
def worker_state(spark, d):
    """The state after a run, from which the next one goes on."""
    state, outcomes = run_of(spark, d)
    return worker.after(state, outcomes, "at").select("hash", "status", "bytes_out")


@query("excerpts", """
WITH f AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'), ' ') AS t FROM documents),
c AS (SELECT doc_id, CASE WHEN length(t) <= 250 THEN t ELSE regexp_replace(left(t, 250), ' [^ ]*$', '') || '…' END AS t FROM f)
SELECT doc_id, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') AS excerpt FROM c""")
def excerpts(spark, d):
    """An excerpt of each whole text, escaped for a page."""
    return t(spark, d, "documents").select("doc_id", pages.excerpt(F.coalesce("text", F.lit(""))).alias("excerpt"))

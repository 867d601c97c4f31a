"""The archive's operators on the driver's tables: a query and its SQL for each.

Relations that the tables don't have are derived from keys, by the same rule on both sides: hashes of pages' links,
addresses and file names made from part keys, snapshots and decision flags made from remainders. The rules stand in
for data; every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import candidates, host_rules, media, pages, records, urls
from ..operators import archive, audit, decisions, incremental, manifests, ranking, recovery

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


# --- inventory and classes ---------------------------------------------------------------------------------------------------


@query("inventory_refs", """
SELECT md5(u) AS hash, page_id AS page, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS u FROM pages) GROUP BY ALL""")
def inventory_refs(spark, d):
    """References of each page, keyed by digest."""
    links = t(spark, d, "pages").select("page_id", F.explode_outer(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("u")).where("u is not null")
    return links.groupBy(urls.image_key(F.col("u")).alias("hash"), F.col("page_id").alias("page")).agg(F.count(F.lit(1)).alias("n"))


IMAGE_PAGES_SQL = """(SELECT p_partkey AS k, '<p><a href="//host' || p_partkey % 7 || '.org/' || p_partkey || '"><img src="../images/' || md5(p_name) || '"></a></p>'
  || '<img src="../../images/' || substr(md5(p_brand), 1, 16) || '?x"><img src="images/' || upper(md5(p_brand)) || '"> ' AS html FROM part)"""


def image_pages(spark, d):
    html = F.concat(
        F.lit('<p><a href="//host'), F.col("p_partkey") % 7, F.lit(".org/"), F.col("p_partkey"), F.lit('"><img src="../images/'), F.md5("p_name"), F.lit('"></a></p>'),
        F.lit('<img src="../../images/'), F.substring(F.md5("p_brand"), 1, 16), F.lit('?x"><img src="images/'), F.upper(F.md5("p_brand")), F.lit('"> '),
    )
    return t(spark, d, "part").select(F.col("p_partkey").alias("k"), html.alias("html"))


@query("stage_inventory", f"""
SELECT lower(h) AS hash, 'p' || k AS page_path, count(*) AS count, 'stage' AS source_class,
  CASE WHEN lower(h) = lower(regexp_extract(any_value(html), '<a href="[^"]+"><img src="[^"]*/images/([0-9a-f]+)"', 1)) THEN regexp_extract(any_value(html), '<a href="([^"]+)"', 1) ELSE '' END AS anchor_href
FROM (SELECT k, html, unnest(regexp_extract_all(html, '(?i)images/([0-9a-f]{{16,32}})["?]', 1)) AS h FROM {IMAGE_PAGES_SQL}) GROUP BY lower(h), k""")
def stage_inventory(spark, d):
    """The inventory of image references with the address of the anchor around them."""
    return recovery.inventory(image_pages(spark, d).select(F.concat(F.lit("p"), "k").alias("page_path"), "html"))


@query("audit_image_refs", f"""
SELECT h AS hash, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '/images/([0-9a-f]{{16,32}})', 1)) AS h FROM {IMAGE_PAGES_SQL}) GROUP BY h""")
def audit_image_refs(spark, d):
    refs = image_pages(spark, d).select(F.explode_outer(pages.audit_refs(F.col("html"))).alias("hash")).where("hash is not null")
    return refs.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))


SYNTH_SQL = """(SELECT p_partkey AS k, p_partkey % 11 AS g, CASE p_partkey % 6 WHEN 0 THEN 'https://i.stack.imgur.com/' || substr(md5(p_partkey::VARCHAR), 1, 5) || '.PNG'
  WHEN 1 THEN '//i.sstatic.net/' || substr(md5(p_partkey::VARCHAR), 1, 6) || '.png' WHEN 2 THEN ' http://Host' || p_partkey % 13 || '.org:8080/a/' || p_partkey || '.jpg?q=1 '
  WHEN 3 THEN 'ftp://x/' || p_partkey WHEN 4 THEN '' ELSE 'https://i.stack.imgur.com/' || substr(md5(p_partkey::VARCHAR), 1, 4) || '.gif' END AS url FROM part)"""
CLASS_SQL = """(SELECT k, g, u, CASE WHEN regexp_matches(u, '(?i)^https?://i\\.stack\\.imgur\\.com/[A-Za-z0-9]{5}\\.(png|jpe?g|gif)$') THEN 'ia_stack_imgur' WHEN h = 'i.sstatic.net' THEN 'sstatic_candidate'
  WHEN regexp_matches(u, '^https?://') THEN 'other_http' ELSE 'no_original_url' END AS c, h FROM (SELECT *, lower(regexp_extract(u, '(?i)^https?://([^/]+)', 1)) AS h
  FROM (SELECT k, g, CASE WHEN starts_with(trim(url), '//') THEN 'https:' || trim(url) ELSE trim(url) END AS u FROM """ + SYNTH_SQL + ")))"


def synth_urls(spark, d):
    k = F.col("p_partkey")
    h = lambda n: F.substring(F.md5(k.cast("string")), 1, n)
    url = (
        F.when(k % 6 == 0, F.concat(F.lit("https://i.stack.imgur.com/"), h(5), F.lit(".PNG"))).when(k % 6 == 1, F.concat(F.lit("//i.sstatic.net/"), h(6), F.lit(".png")))
        .when(k % 6 == 2, F.concat(F.lit(" http://Host"), k % 13, F.lit(".org:8080/a/"), k, F.lit(".jpg?q=1 "))).when(k % 6 == 3, F.concat(F.lit("ftp://x/"), k)).when(k % 6 == 4, "")
        .otherwise(F.concat(F.lit("https://i.stack.imgur.com/"), h(4), F.lit(".gif")))
    )
    return t(spark, d, "part").select(k.alias("k"), (k % 11).alias("g"), url.alias("url"))


@query("classify_urls", f"SELECT k, c AS source_class, CASE WHEN c = 'no_original_url' THEN '' ELSE h END AS host, u AS url FROM {CLASS_SQL}")
def classify_urls(spark, d):
    return synth_urls(spark, d).select("k", urls.classify_url(F.col("url")).alias("c")).select("k", "c.source_class", "c.host", "c.url")


@query("class_counts", f"SELECT c AS source_class, count(*) AS n, count(DISTINCT h) AS hosts FROM {CLASS_SQL} GROUP BY c")
def class_counts(spark, d):
    c = synth_urls(spark, d).select(urls.classify_url(F.col("url")).alias("c"), urls.host_of(urls.normalize_url(F.col("url"))).alias("h"))
    return c.groupBy("c.source_class").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("hosts"))


@query("classify_missing", f"""
WITH r AS (SELECT *, u <> '' AS has, max((u <> '')::INT) OVER (PARTITION BY g) = 1 AS anyone FROM {CLASS_SQL} WHERE g % 3 <> 0)
SELECT md5(g::VARCHAR) AS hash, u AS source_url, CASE WHEN has THEN c ELSE 'no_original_url' END AS source_class, 'missing' AS status, 'p' || k AS page
FROM (SELECT *, row_number() OVER (PARTITION BY g, u ORDER BY k) AS rn FROM r WHERE has OR NOT anyone) WHERE rn = 1""")
def classify_missing(spark, d):
    """Missing hashes with their distinct addresses, first page of each."""
    inv = synth_urls(spark, d).select(F.md5(F.col("g").cast("string")).alias("hash"), F.concat(F.lit("p"), "k").alias("page_path"), F.col("k").alias("seq"), F.col("url").alias("anchor_href"), "g")
    return recovery.classify_missing(inv.drop("g"), inv.where("g % 3 <> 0").select("hash"))


@query("host_counts_topk", """
SELECT host, count(*) AS count, substr(min_by(url, page_id), 1, 120) AS sample_url FROM (SELECT page_id, url, regexp_extract(url, '(?i)https?://([^/]+)', 1) AS host FROM pages) WHERE host <> ''
GROUP BY host ORDER BY count(*) DESC, min(page_id) LIMIT 20""")
def host_counts_topk(spark, d):
    """Hosts by number of addresses; ties in order of first sight."""
    return recovery.host_counts(t(spark, d, "pages").select(F.col("page_id").alias("seq"), "url"), 20)


@query("ia_manifest", f"""
SELECT k, u AS source_url, regexp_extract(u, '([^/?#]*)$', 1) AS ia_filename FROM {CLASS_SQL} WHERE c = 'ia_stack_imgur'""")
def ia_manifest(spark, d):
    c = synth_urls(spark, d).select("k", urls.classify_url(F.col("url")).alias("c")).select("k", F.col("c.url").alias("source_url"), F.col("c.source_class").alias("source_class"))
    return recovery.archive_manifest(c).select("k", "source_url", "ia_filename")


FORMS_SQL = """(SELECT k, name, i, CASE i WHEN 0 THEN 'https://i.sstatic.net/' || name WHEN 1 THEN 'https://i.stack.imgur.com/' || name WHEN 2 THEN 'http://i.stack.imgur.com/' || name
  WHEN 3 THEN 'http://i.sstatic.net/' || name ELSE 'https://i.sstatic.net/' || name || '.png' END AS u
  FROM (SELECT min(p_partkey) AS k, substr(md5(p_name), 1, 5) || CASE WHEN p_partkey % 2 = 0 THEN '.png' ELSE '' END AS name FROM part GROUP BY 2), (SELECT unnest(range(5)) AS i) WHERE i < 4 OR NOT contains(name, '.'))"""


def part_names(spark, d):
    name = F.concat(F.substring(F.md5("p_name"), 1, 5), F.when(F.col("p_partkey") % 2 == 0, ".png").otherwise(""))
    return t(spark, d, "part").select(name.alias("name"), "p_partkey").groupBy("name").agg(F.min("p_partkey").alias("k"))


@query("wanted_md5_match", f"""
WITH f AS (SELECT *, md5(u) AS h FROM {FORMS_SQL}), w AS (SELECT DISTINCT h FROM f WHERE (k + i) % 5 < 2)
SELECT h AS hash, 'https://i.sstatic.net/' || min_by(name, row(k, i)) AS source_url FROM f SEMI JOIN w USING (h) GROUP BY h""")
def wanted_md5_match(spark, d):
    """Wanted keys matched by the forms of file names; the first name that fits counts."""
    names = part_names(spark, d)
    forms = names.select("k", F.posexplode(urls.posts_candidates(F.col("name"))).alias("i", "u"))
    wanted = forms.where((F.col("k") + F.col("i")) % 5 < 2).select(urls.image_key(F.col("u")).alias("hash"))
    return recovery.match_names(names.select("name", F.col("k").alias("_at")), wanted)


@query("history_scan_match", """
WITH l AS (SELECT l_orderkey AS line_no, 'n' || l_partkey % 500 AS name, 'png' AS ext FROM lineitem),
s AS (SELECT name, ext, count(DISTINCT line_no) AS n FROM l GROUP BY ALL),
f AS (SELECT *, CASE i WHEN 0 THEN 'https://i.sstatic.net/' WHEN 1 THEN 'https://i.stack.imgur.com/' ELSE 'http://i.stack.imgur.com/' END || name || '.' || ext AS u FROM s, (SELECT unnest(range(3)) AS i)),
h AS (SELECT *, row_number() OVER (PARTITION BY name, ext ORDER BY i) AS rn FROM f WHERE substr(md5(u), 1, 1) IN ('0', '3', '7', 'a', 'c', 'f'))
SELECT md5(u) AS hash, u AS source_url FROM h WHERE rn <= n""")
def history_scan_match(spark, d):
    """A line takes one wanted form of a name at most."""
    li = t(spark, d, "lineitem")
    lines = li.select(F.col("l_orderkey").alias("line_no"), F.concat(F.lit("see i.stack.imgur.com/n"), F.col("l_partkey") % 500, F.lit(".png &amp; more")).alias("line"))
    names = li.select(F.concat(F.lit("n"), F.col("l_partkey") % 500).alias("name")).distinct()
    forms = names.select(F.explode(urls.history_candidates(F.col("name"), F.lit("png"))).alias("u")).select(urls.image_key(F.col("u")).alias("hash"))
    return recovery.match_history(lines, forms.where(F.substring("hash", 1, 1).isin("0", "3", "7", "a", "c", "f")))


# --- manifests ---------------------------------------------------------------------------------------------------------------


@query("manifest_dedup", "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def manifest_dedup(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "event_type")
    old = manifests.append(e.where("false"), e.where("event_id < 1000"), ["user_id", "event_type"], ["event_id"])
    return manifests.append(old, e.where("event_id >= 500"), ["user_id", "event_type"], ["event_id"])


@query("manifest_append", """
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY (event_id % 3 <> 0), event_id) AS rn FROM events) WHERE rn = 1""")
def manifest_append(spark, d):
    """New rows appended to old ones; old ones win."""
    e = t(spark, d, "events").select("event_id", "user_id", "event_type")
    return manifests.append(e.where("event_id % 3 = 0"), e.where("event_id % 3 <> 0"), ["user_id", "event_type"], ["event_id"])


@query("manifest_rejects", "SELECT count(*) AS accepted, sum(n) - count(*) AS rejected FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)")
def manifest_rejects(spark, d):
    return manifests.rejected(t(spark, d, "events"), ["user_id", "event_type"])


@query("best_row_per_hash", """
SELECT user_id, event_id, digest FROM (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN md5(event_id::VARCHAR) ELSE '' END AS digest,
  row_number() OVER (PARTITION BY user_id ORDER BY (event_id % 4 <> 0), event_id) AS rn FROM events) WHERE rn = 1""")
def best_row_per_hash(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 4 == 0, F.md5(F.col("event_id").cast("string"))).otherwise("").alias("digest"))
    return manifests.best_per_hash(e, "user_id", "digest", ["event_id"])


@query("pending_last_url", "SELECT user_id, max_by(event_type || event_id, event_id) AS url FROM events GROUP BY user_id")
def pending_last_url(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.concat("event_type", F.col("event_id").cast("string")).alias("url"))
    return manifests.last_url(e, "user_id", "url", "event_id")


@query("hashes_in_order", "SELECT user_id FROM events GROUP BY user_id ORDER BY min(event_id), user_id LIMIT 50")
def hashes_in_order(spark, d):
    return manifests.in_order(t(spark, d, "events"), "user_id", "event_id", 50)


@query("state_upsert", "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS status FROM events GROUP BY user_id")
def state_upsert(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("status"))
    return manifests.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_id")


@query("tsv_escape", "SELECT doc_id, md5(replace(replace(replace(coalesce(text, ''), chr(9), '%09'), chr(10), '%0A'), chr(13), '%0D')) AS escaped_md5 FROM documents")
def tsv_escape(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(records.tsv_escape(F.col("text"))).alias("escaped_md5"))


@query("done_items", "SELECT o_orderkey FROM orders ANTI JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R') USING (o_orderkey)")
def done_items(spark, d):
    done = t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return manifests.done_filter(t(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@query("capped_per_key", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn <= 3")
def capped_per_key(spark, d):
    """At most three pages of a hash."""
    return manifests.capped_per_key(t(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], 3).select("l_orderkey", "l_linenumber", "l_partkey")


# --- joins, counts, order ----------------------------------------------------------------------------------------------------


@query("missing_left_join", """
WITH s AS (SELECT strlen(text) AS size, sha256(text) AS sha FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)),
j AS (SELECT text, size, sha FROM documents d LEFT JOIN (SELECT DISTINCT doc_id AS k FROM labels) ON k = doc_id, s WHERE true),
h AS (SELECT d.doc_id, CASE WHEN k IS NOT NULL THEN text END AS text FROM documents d LEFT JOIN (SELECT DISTINCT doc_id AS k FROM labels) ON k = d.doc_id)
SELECT CASE WHEN text IS NULL THEN 'absent' WHEN strlen(text) = size AND sha256(text) = sha THEN 'placeholder' ELSE 'present' END AS state,
  coalesce(strlen(text) = size AND sha256(text) <> sha, false) AS twin, count(*) AS n FROM h, s GROUP BY ALL""")
def missing_left_join(spark, d):
    """Documents as references; those with a label have a file; the first document's text stands for the placeholder."""
    docs = t(spark, d, "documents")
    spec = docs.orderBy("doc_id").select(F.octet_length("text").alias("size"), F.sha2("text", 256).alias("sha")).first()
    files = docs.join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("name"), F.col("text").cast("binary").alias("content"))
    out = recovery.missing(docs.select(F.col("doc_id").alias("hash")), files, spec.size, spec.sha)
    return out.groupBy("state", "twin").agg(F.count(F.lit(1)).alias("n"))


@query("placeholder_detect", """
WITH s AS (SELECT strlen(text) AS size, sha256(text) AS sha FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents))
SELECT count(*) FILTER (strlen(text) = size) AS sized, count(*) FILTER (strlen(text) = size AND sha256(text) = sha) AS confirmed, count(*) FILTER (strlen(text) = size AND sha256(text) <> sha) AS twins FROM documents, s""")
def placeholder_detect(spark, d):
    """Size candidates, confirmed placeholders and twins of the size only; content is hashed for the candidates alone."""
    docs = t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    spec = docs.orderBy("doc_id").select(F.octet_length("content").alias("size"), F.sha2("content", 256).alias("sha")).first()
    sized = F.octet_length("content") == spec.size
    same = media.is_placeholder(F.col("content"), spec.size, spec.sha.upper())
    return docs.agg(F.count_if(sized).alias("sized"), F.count_if(same).alias("confirmed"), F.count_if(sized & ~same).alias("twins"))


@query("not_recovered_anti", "SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def not_recovered_anti(spark, d):
    return t(spark, d, "orders").select("o_orderkey").join(t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


def questions(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id"), (F.col("o_orderstatus") == "F").alias("deleted"))
    a = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("post_id"), cents("l_extendedprice").alias("score"), F.col("l_linenumber").alias("no"), F.col("l_partkey").alias("part"))
    return incremental.nest(o, a, "post_id", "answers", ["score", "no", "part"], descending=True)


@query("unanswered_filter", "SELECT o_orderkey AS post_id, count(*) AS answers FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1")
def unanswered_filter(spark, d):
    return incremental.eligible(questions(spark, d), True).select("post_id", F.size("answers").cast("long").alias("answers"))


@query("answers_ranked", """
SELECT o_orderkey AS post_id, coalesce(string_agg(s || ':' || l_linenumber || ':' || l_partkey, ',' ORDER BY s DESC, l_linenumber DESC, l_partkey DESC), '') AS ranked
FROM orders LEFT JOIN (SELECT *, round(l_extendedprice * 100)::BIGINT AS s FROM lineitem) ON l_orderkey = o_orderkey GROUP BY 1""")
def answers_ranked(spark, d):
    """Answers nested into their question, best first."""
    q = questions(spark, d)
    return q.select("post_id", F.array_join(F.transform("answers", lambda a: F.concat_ws(":", a["score"].cast("string"), a["no"].cast("string"), a["part"].cast("string"))), ",").alias("ranked"))


@query("pagination", "SELECT c_custkey, rank, (rank + 99) // 100 AS page FROM (SELECT c_custkey, row_number() OVER (ORDER BY round(c_acctbal * 100)::BIGINT DESC, c_custkey) AS rank FROM customer)")
def pagination(spark, d):
    c = t(spark, d, "customer").select("c_custkey", (-cents("c_acctbal")).alias("neg"))
    return ranking.paged(c, ["neg", "c_custkey"], 100).select("c_custkey", "rank", "page")


@query("pagination_by_tag", "SELECT c_custkey, c_mktsegment, rank, (rank + 9) // 10 AS page FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY round(c_acctbal * 100)::BIGINT DESC, c_custkey) AS rank FROM customer)")
def pagination_by_tag(spark, d):
    c = t(spark, d, "customer").withColumn("neg", -cents("c_acctbal"))
    return ranking.paged(c, ["neg", "c_custkey"], 10, ["c_mktsegment"]).select("c_custkey", "c_mktsegment", "rank", "page")


@query("list_pages", "SELECT c_mktsegment, least(count(*) // 36, 100) AS pages FROM customer GROUP BY 1")
def list_pages(spark, d):
    return t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).select("c_mktsegment", ranking.page_count(F.col("n"), 36, 100).alias("pages"))


@query("even_sample", """
WITH n AS (SELECT count(*) AS c FROM documents) SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents), n
WHERE pos IN (SELECT unnest([(i * c) // 37 FOR i IN range(37)]) FROM n)""")
def even_sample(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    return ranking.even_sample(docs, ["doc_id"], docs.count(), 37)


@query("newest_pages", "SELECT o_orderkey AS post_id FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def newest_pages(spark, d):
    return archive.newest(t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id")), 100)


@query("external_sort", "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders")
def external_sort(spark, d):
    """A dump in the order of a numeric field."""
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("field"))
    return ranking.positions(o.withColumn("n", records.lenient_int(F.col("field"))), ["n", "o_orderkey"]).select("o_orderkey", (F.col("_pos") + 1).cast("long").alias("place"))


@query("status_totals", "SELECT event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS total, count(*) FILTER (event_id % 10 = 0) AS failed FROM events GROUP BY 1")
def status_totals(spark, d):
    return t(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("total"), F.count_if(F.col("event_id") % 10 == 0).alias("failed"))


@query("answered_share", "SELECT count(l) AS answered, count(*) AS total, count(l) * 1000 // greatest(1, count(*)) AS permille FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON l = o_orderkey")
def answered_share(spark, d):
    a = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("l", F.lit(1))
    j = t(spark, d, "orders").select("o_orderkey").join(a, "o_orderkey", "left").agg(F.count("l").alias("answered"), F.count(F.lit(1)).alias("total"))
    return j.withColumn("permille", F.expr("answered * 1000 div greatest(1, total)"))


# --- fingerprints and snapshots ----------------------------------------------------------------------------------------------


def posts(spark, d, edited: bool = False):
    """Orders as questions with line items as answers. ``edited``: the previous snapshot, with some titles changed and some posts absent."""
    none = F.lit(None).cast("string")
    o = t(spark, d, "orders")
    title = F.when(F.col("o_orderkey") % 7 == 0, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")) if edited else F.col("o_orderpriority")
    q = (o.where("o_orderkey % 11 <> 0") if edited else o).select(
        F.col("o_orderkey").alias("Id"), title.alias("Title"), F.lit("b").alias("Body"), cents("o_totalprice").alias("Score"), F.split(F.concat(F.lit("z|"), "o_orderstatus"), "\\|").alias("Tags"),
        F.col("o_custkey").cast("string").alias("OwnerUserId"), *[none.alias(f) for f in ("OwnerDisplayName", "CreationDate", "LastActivityDate", "ViewCount", "LastEditDate", "LastEditorUserId", "AcceptedAnswerId")],
        F.expr("cast(array() as array<struct<Id:string,PostId:string,UserId:string,Score:string,Text:string,CreationDate:string,ContentLicense:string>>)").alias("comments"),
        F.expr("cast(array() as array<struct<Id:bigint,Name:string>>)").alias("links"),
    )
    # Dealt by post at once, so that answers and their lists need no further shuffle; what all answers share joins them after it.
    a = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("post"), F.col("l_linenumber").cast("long").alias("Id"), cents("l_extendedprice").alias("Score")).repartition("post")
    a = a.groupBy("post", "Id").agg(F.max("Score").alias("Score"))
    full = lambda x: F.struct(x["Id"].cast("string").alias("Id"), x["Score"].cast("string").alias("Score"), F.lit("a").alias("Body"), *[none.alias(f) for f in ("OwnerUserId", "OwnerDisplayName", "CreationDate", "LastEditDate", "LastEditorUserId")], F.expr("cast(array() as array<struct<Id:string,PostId:string,UserId:string,Score:string,Text:string,CreationDate:string,ContentLicense:string>>)").alias("comments"))
    lists = a.groupBy(F.col("post").alias("Id")).agg(F.collect_list(F.struct("Id", "Score")).alias("_a")).select("Id", F.transform("_a", full).alias("answers"))
    return q.join(lists, "Id", "left")


def digests(spark, d, edited: bool = False):
    return posts(spark, d, edited).select(F.col("Id").alias("post_id"), records.fingerprint().alias("digest"))


def _digest_sql(edited: bool) -> str:
    title = "CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority || '!' ELSE o_orderpriority END" if edited else "o_orderpriority"
    where = "WHERE o_orderkey % 11 <> 0" if edited else ""
    return f"""(SELECT o_orderkey AS post_id, sha256('{{"AcceptedAnswerId":null,"Body":"b","CreationDate":null,"Id":' || o_orderkey || ',"LastActivityDate":null,"LastEditDate":null,"LastEditorUserId":null,"OwnerDisplayName":null,"OwnerUserId":"' || o_custkey
  || '","Score":' || round(o_totalprice * 100)::BIGINT || ',"Tags":["' || o_orderstatus || '","z"],"Title":"' || {title} || '","ViewCount":null,"answers":[' || coalesce(a, '') || '],"comments":[],"links":[]}}') AS digest
  FROM orders LEFT JOIN (SELECT l_orderkey, string_agg('{{"Body":"a","CreationDate":null,"Id":"' || l_linenumber || '","LastEditDate":null,"LastEditorUserId":null,"OwnerDisplayName":null,"OwnerUserId":null,"Score":"' || s || '","comments":[]}}', ',' ORDER BY l_linenumber) AS a
    FROM (SELECT l_orderkey, l_linenumber, max(round(l_extendedprice * 100)::BIGINT) AS s FROM lineitem GROUP BY ALL) GROUP BY 1) ON l_orderkey = o_orderkey {where})"""


@query("question_fingerprint", f"SELECT * FROM {_digest_sql(False)}")
def question_fingerprint(spark, d):
    return digests(spark, d)


@query("incremental_diff", f"""
SELECT post_id, CASE WHEN p.digest IS NULL THEN 'new' WHEN c.digest IS NULL THEN 'removed' WHEN c.digest = p.digest THEN 'unchanged' ELSE 'changed' END AS change
FROM (SELECT * FROM {_digest_sql(False)} WHERE post_id % 13 <> 0) c FULL JOIN {_digest_sql(True)} p USING (post_id)""")
def incremental_diff(spark, d):
    """Which posts to render, skip and prune: fingerprints of two snapshots, joined on the key."""
    return incremental.diff(digests(spark, d).where("post_id % 13 <> 0"), digests(spark, d, True))


@query("render_plan", f"""
SELECT post_id, CASE WHEN post_id % 5 <> 0 AND post_id % 17 <> 0 AND c.digest = p.digest THEN 'skip' ELSE 'render' END AS action FROM {_digest_sql(False)} c LEFT JOIN {_digest_sql(True)} p USING (post_id)""")
def render_plan(spark, d):
    k = F.col("post_id")
    m = digests(spark, d, True).select("post_id", F.when(k % 5 == 0, 1).otherwise(2).alias("schema_version"), F.lit(records.CONTRACT).alias("render_contract_version"), F.col("digest").alias("source_sha256"), (k % 17 != 0).alias("html_exists"))
    return incremental.plan_render(digests(spark, d), m)


def staged(spark, d):
    k = F.col("o_orderkey")
    return t(spark, d, "orders").select(k.alias("post_id"), F.when(k % 3 == 0, 1).otherwise(2).alias("schema_version"), F.concat(F.lit("html/"), records.shard_of(k), F.lit("/"), k).alias("path"))


@query("prune_candidates", """
SELECT o_orderkey AS post_id, 'html/' || substr(printf('%08x', o_orderkey), 1, 2) || '/' || o_orderkey AS path FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 3 <> 0""")
def prune_candidates(spark, d):
    seen = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("post_id"))
    return incremental.prune_problem(incremental.prune_plan(staged(spark, d), seen)).where("problem is null").drop("problem")


@query("resume_plan", "SELECT o_orderkey AS post_id, CASE WHEN o_orderkey % 2 = 0 AND l IS NOT NULL THEN 'skip' ELSE 'render' END AS action FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON l = o_orderkey")
def resume_plan(spark, d):
    q = t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id"))
    return incremental.resume(q, q.where("post_id % 2 = 0"), t(spark, d, "lineitem").select(F.col("l_orderkey").alias("post_id")))


@query("detail_fallback", """
SELECT o_orderkey AS post_id, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, '') AS owner,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, 0) AS answers FROM orders""")
def detail_fallback(spark, d):
    o = t(spark, d, "orders").withColumn("post_id", F.col("o_orderkey"))
    stored = o.where("post_id % 2 = 0").select("post_id", F.col("o_orderstatus").alias("owner"), F.col("o_custkey").alias("answers"))
    page = o.where("post_id % 3 = 0").select("post_id", F.col("o_orderpriority").alias("owner"), F.lit(None).cast("long").alias("answers"))
    return incremental.details(o, stored, page, {"owner": "", "answers": 0})


@query("answer_redirects", """
SELECT 'questions/' || o_orderkey || '/x' AS path, 'item' AS kind, NULL AS target FROM orders UNION ALL SELECT 'questions/' || o_orderkey, 'redirect', 'questions/' || o_orderkey || '/x' FROM orders
UNION ALL SELECT 'a/' || l_linenumber, 'redirect', 'questions/' || l_orderkey || '/x' FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey)""")
def answer_redirects(spark, d):
    a = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("post_id")).agg(F.collect_set("l_linenumber").alias("answer_redirects"))
    p = t(spark, d, "orders").select(F.col("o_orderkey").alias("post_id"), F.col("o_orderpriority").alias("title"), records.slug_path(F.col("o_orderkey"), F.lit("x")).alias("zim_path")).join(a, "post_id", "left")
    return archive.entries(p).select("path", "kind", "target")


@query("tag_pages", "SELECT tag, count(*) AS posts FROM (SELECT unnest(['z', o_orderstatus]) AS tag FROM orders) GROUP BY tag")
def tag_pages(spark, d):
    """Tags of raw dump strings."""
    raw = t(spark, d, "orders").select(F.concat(F.lit("<z><"), "o_orderstatus", F.lit(">")).alias("tags"))
    return raw.select(F.explode(records.split_tags(F.col("tags"))).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("posts"))


# --- audits ------------------------------------------------------------------------------------------------------------------


@query("duplicate_paths", "SELECT sum(n - 1)::BIGINT AS n FROM (SELECT count(*) AS n FROM documents WHERE text <> '' GROUP BY md5(text))")
def duplicate_paths(spark, d):
    return audit.duplicates(t(spark, d, "documents").select(F.md5("text").alias("p")), "p").select("n")


@query("ref_integrity", """
WITH r AS (SELECT DISTINCT u FROM (SELECT unnest(regexp_extract_all(html, 'href="/([^"]+)"', 1)) AS u FROM pages)),
f AS (SELECT u || CASE WHEN hash % 3 = 0 THEN '' ELSE '.png' END AS name FROM (SELECT u, ord(right(u, 1)) AS hash FROM r) WHERE hash % 2 = 0),
n AS (SELECT name FROM f UNION SELECT regexp_replace(name, '\\.[^.]*$', '') FROM f)
SELECT u AS hash FROM r ANTI JOIN n ON n.name = r.u""")
def ref_integrity(spark, d):
    refs = t(spark, d, "pages").select(F.explode_outer(F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), F.lit(1))).alias("hash")).where("hash is not null").distinct()
    last = F.ascii(F.substring("hash", -1, 1))
    files = refs.where(last % 2 == 0).select(F.concat("hash", F.when(last % 3 == 0, "").otherwise(".png")).alias("name"))
    return audit.unresolved(refs, files)


@query("audit_report", """
SELECT 'pages' AS check, CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS n FROM orders
UNION ALL SELECT 'missing_manifests', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT 'duplicate_paths', CASE WHEN sum(n - 1) > 0 THEN 'FAIL' ELSE 'PASS' END, sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM documents WHERE text <> '' GROUP BY md5(text))
UNION ALL SELECT 'empty_texts', CASE WHEN count(*) FILTER (text IS NULL OR text = '') > 0 THEN 'WARN' ELSE 'PASS' END, count(*) FILTER (text IS NULL OR text = '') FROM documents""")
def audit_report(spark, d):
    docs, orders = t(spark, d, "documents").select("text"), t(spark, d, "orders").select("o_orderkey")
    without = orders.join(t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return audit.report(
        audit.some_must(orders, "pages"), audit.none_may(without, "missing_manifests", F.lit(True)),
        audit.duplicates(docs.select(F.md5(F.when(F.col("text") != "", F.col("text"))).alias("p")), "p"), audit.none_may(docs, "empty_texts", F.col("text").isNull() | (F.col("text") == ""), "WARN"),
    )


@query("audit_summary", """
SELECT 2::BIGINT - f AS pass, 0::BIGINT AS warn, f AS fail, 0::BIGINT AS info, CASE WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END AS result FROM (SELECT (count(*) > 0)::BIGINT AS f FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey)""")
def audit_summary(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey")
    without = orders.join(t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return audit.summary(audit.report(audit.some_must(orders, "pages"), audit.none_may(without, "missing_manifests", F.lit(True))))


BASE = {"size": 10**9, "entries": 60_000, "pages": 15_000, "images": 20}


@query("baseline_compare", f"""
WITH a AS (SELECT 'size' AS metric, 20000000 AS value UNION ALL SELECT 'entries', count(*) FROM lineitem UNION ALL SELECT 'pages', count(*) FROM orders UNION ALL SELECT 'images', count(*) FROM nation)
SELECT metric, CASE metric WHEN 'size' THEN CASE WHEN value * 100 < {BASE['size']} THEN 'FAIL' ELSE 'PASS' END
  WHEN 'entries' THEN CASE WHEN value = 0 OR value < 1000 OR abs(value - {BASE['entries']}) * 100 > 50 * {BASE['entries']} THEN 'FAIL' ELSE 'PASS' END
  WHEN 'pages' THEN CASE WHEN value = 0 OR value < 100 THEN 'FAIL' WHEN abs(value - {BASE['pages']}) / {BASE['pages']} > 0.02 THEN 'WARN' ELSE 'PASS' END
  ELSE CASE WHEN value = 0 THEN 'FAIL' WHEN abs(value - {BASE['images']}) / {BASE['images']} > 0.02 THEN 'WARN' ELSE 'PASS' END END AS status,
  CASE metric WHEN 'size' THEN {BASE['size']} WHEN 'entries' THEN {BASE['entries']} WHEN 'pages' THEN {BASE['pages']} ELSE {BASE['images']} END::BIGINT AS expected, value::BIGINT AS actual FROM a""")
def baseline_compare(spark, d):
    n = lambda name, metric: t(spark, d, name).agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), "value", F.lit(metric).alias("rule"))
    size = spark.range(1).select(F.lit("size").alias("metric"), F.lit(20000000).cast("long").alias("value"), F.lit("size").alias("rule"))
    return audit.compare(size.unionByName(n("lineitem", "entries")).unionByName(n("orders", "pages")).unionByName(n("nation", "images")), BASE, least={"entries": 1000, "pages": 100})


@query("tolerance_check", "SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN p_partkey % 2 = 0 ELSE abs(p_size - (p_size // 10) * 10) / (p_size % 10)::DOUBLE <= 1.0 END AS ok FROM part")
def tolerance_check(spark, d):
    e, a = F.col("p_size") % 10, F.when(F.col("p_size") % 10 == 0, F.col("p_partkey") % 2).otherwise(0)
    return t(spark, d, "part").select("p_partkey", records.within_tolerance(e, a, 1.0).alias("ok"))


# --- decisions ---------------------------------------------------------------------------------------------------------------


def flag(n: int):
    return F.col("p_partkey") % n != 0


@query("sync_decisions", """
SELECT p_partkey, CASE WHEN r IN ('absent-target', 'placeholder-target') THEN 'applied' ELSE 'skipped' END AS status, r AS reason FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN 'missing-source'
  WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN 'sha-mismatch' WHEN p_partkey % 13 = 0 THEN 'absent-target' WHEN p_size % 3 = 0 THEN 'placeholder-target' WHEN p_size % 3 = 1 THEN 'already-real' ELSE 'not-placeholder' END AS r FROM part)""")
def sync_decisions(spark, d):
    sha = F.when(flag(7), F.lit("AB")).otherwise("")
    got = decisions.sync(flag(2), flag(3), ~flag(5), sha, F.when(flag(11), "ab").otherwise("cd"), flag(13), F.col("p_size") % 3 == 0, F.col("p_size") % 3 == 1)
    return t(spark, d, "part").select("p_partkey", got.alias("x")).select("p_partkey", "x.status", "x.reason")


@query("finalize_decisions", """
SELECT CASE WHEN p_partkey % 2 <> 0 AND p_size % 3 = 0 THEN 'already-placeholder' WHEN p_partkey % 2 <> 0 AND p_size % 3 = 1 THEN 'already-recovered' ELSE 'written' END AS status, count(*) AS n FROM part GROUP BY 1""")
def finalize_decisions(spark, d):
    s = decisions.finalize(flag(2), F.col("p_size") % 3 == 0, F.col("p_size") % 3 == 1, False)
    return t(spark, d, "part").groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("upgrade_decisions", """
SELECT CASE WHEN p_partkey % 5 = 0 THEN 'candidate' WHEN p_partkey % 3 <> 0 AND p_size > 25 THEN 'upgrade_candidate' WHEN p_partkey % 3 <> 0 THEN 'no_improvement' ELSE 'http-404' END AS status, count(*) AS n FROM part GROUP BY 1""")
def upgrade_decisions(spark, d):
    s = decisions.upgrade(flag(5), flag(3), F.lit(25), F.col("p_size"), F.lit("http-404"))
    return t(spark, d, "part").groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("fetch_outcomes", """
SELECT p_partkey, CASE s WHEN 200 THEN 'ok' WHEN 403 THEN CASE WHEN a >= 2 THEN 'stop' ELSE 'retry' END WHEN 429 THEN CASE WHEN a >= 2 THEN 'stop' ELSE 'retry' END
  WHEN 408 THEN CASE WHEN a >= 2 THEN 'fail' ELSE 'retry' END WHEN 503 THEN CASE WHEN a >= 2 THEN 'fail' ELSE 'retry' END ELSE 'fail' END AS outcome,
  CASE s WHEN 200 THEN 'ok' WHEN 403 THEN CASE WHEN a >= 2 THEN 'stop' ELSE 'retry' END WHEN 429 THEN CASE WHEN a >= 2 THEN 'stop' ELSE 'retry' END WHEN 503 THEN CASE WHEN a >= 2 THEN 'fail' ELSE 'retry' END ELSE 'fail' END AS worker_outcome
FROM (SELECT p_partkey, p_size % 4 AS a, CASE p_partkey % 6 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 408 WHEN 4 THEN 503 ELSE 404 END AS s FROM part)""")
def fetch_outcomes(spark, d):
    s = F.element_at(F.array(*[F.lit(x) for x in (200, 403, 429, 408, 503, 404)]), (F.col("p_partkey") % 6 + 1).cast("int"))
    a = F.col("p_size") % 4
    return t(spark, d, "part").select("p_partkey", decisions.fetch(s, a, 2).alias("outcome"), decisions.fetch(s, a, 2, True).alias("worker_outcome"))


# --- text --------------------------------------------------------------------------------------------------------------------


@query("title_sanitize", """
SELECT doc_id, CASE WHEN length(t) < 3 THEN 'Question ' || doc_id ELSE substr(t, 1, 500) END AS title FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x1F\\x7F]', '', 'g'), '[ ]+', ' ', 'g')) AS t FROM documents)""")
def title_sanitize(spark, d):
    return t(spark, d, "documents").select("doc_id", records.sanitize_title(spark, F.col("text"), "doc_id").alias("title"))


HOSTS = ["i.stack.imgur.com", "commons.wikimedia.org", "m.imgur.io", "i.sstatic.net", "elsewhere.org"]
HOST_SQL = "CASE p_partkey % 5 " + " ".join(f"WHEN {k} THEN '{h}'" for k, h in enumerate(HOSTS)) + " END"
HTML_SQL = """(SELECT p_partkey, '<p> <a class="x" href="https://' || """ + HOST_SQL + """ || '/' || p_partkey || '.png"> <img alt="" src="../images/' || md5(p_name) || '"> </a> </p><a href="//:None/../a/' || p_partkey || '">z</a><img src="../images/' || md5(p_brand) || '">' AS h FROM part)"""


def html_strings(spark, d):
    h = F.concat(F.lit('<p> <a class="x" href="https://'), F.get(F.array(*map(F.lit, HOSTS)), (F.col("p_partkey") % 5).cast("int")), F.lit("/"), "p_partkey", F.lit('.png"> <img alt="" src="../images/'), F.md5("p_name"), F.lit('"> </a> </p><a href="//:None/../a/'), "p_partkey", F.lit('">z</a><img src="../images/'), F.md5("p_brand"), F.lit('">'))
    return t(spark, d, "part").select("p_partkey", h.alias("h"))


@query("html_rewrite_nopic", f"SELECT p_partkey, '<p>{pages.NOTICE}</p><a href=\"../a/' || p_partkey || '\">z</a>{pages.NOTICE}' AS html FROM part")
def html_rewrite_nopic(spark, d):
    return html_strings(spark, d).select("p_partkey", pages.without_images(F.col("h")).alias("html"))


@query("html_rewrite_images", f"""
SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN replace(h, '//:None/', '') ELSE regexp_replace(replace(h, '//:None/', ''), '(<a [^>]*href=")https://[^"]*("[^>]*> <img [^>]*src=")([^"]*)(")', '\\1\\3\\2\\3\\4') END AS html FROM {HTML_SQL}""")
def html_rewrite_images(spark, d):
    return html_strings(spark, d).select("p_partkey", pages.link_local_images(F.col("h")).alias("html"))


@query("clean_url", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'https://h/' || p_partkey || '.png' WHEN 1 THEN 'https://h/[' || p_partkey || '](x)' WHEN 2 THEN 'https://h/' || p_partkey ELSE 'x' || p_partkey END AS url FROM part""")
def clean_url(spark, d):
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, F.concat(F.lit("![](http://https://h/"), k, F.lit(".png)'\""))).when(k % 4 == 1, F.concat(F.lit(" https://h/%5B"), k, F.lit("%5D%28x%29,"))).when(k % 4 == 2, F.concat(F.lit("http://http://h/"), k, F.lit(".;:"))).otherwise(F.concat(F.lit("x"), k, F.lit("...")))
    return t(spark, d, "part").select("p_partkey", urls.clean_url(raw).alias("url"))


@query("camo_decode", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'https://o.org/' || p_name WHEN 1 THEN NULL WHEN 2 THEN 'http://' || p_partkey || chr(65533) || 'x' || chr(65533) WHEN 3 THEN NULL ELSE 'https://é/' END AS url FROM part")
def camo_decode(spark, d):
    k = F.col("p_partkey")
    path = F.concat(F.lit("/d/"), F.when(k % 5 == 0, F.lower(F.hex(F.concat(F.lit("https://o.org/"), "p_name")))).when(k % 5 == 1, F.lit("zz"))
        .when(k % 5 == 2, F.concat(F.hex(F.concat(F.lit("http://"), k.cast("string"))), F.lit("ff78c3"))).when(k % 5 == 3, F.hex(F.lit("ftp://x"))).otherwise(F.hex(F.lit("https://é/"))))
    return t(spark, d, "part").select("p_partkey", urls.decode_camo(path).alias("url"))


#: Addresses by remainder of the part's key (its place marked by {}), and what the host rules make of each.
EDGES = [
    ("https://youtu.be/{}", [f"https://i.ytimg.com/vi/{{}}/{x}.jpg" for x in host_rules.THUMBS]),
    ("https://travis-ci.org/o/{}", ["https://travis-ci.org/o/{}.svg", "https://travis-ci.org/o/{}.png", "https://api.travis-ci.org/o/{}.svg?branch=master"]),
    ("https://github.com/o/r/tree/blob/main/{}.png", ["https://raw.githubusercontent.com/o/r/blob/main/{}.png"]),
    ("https://www.youtube.com/shorts/{}?v=xyz", [f"https://i.ytimg.com/vi/{{}}/{x}.jpg" for x in host_rules.THUMBS]),
    ("https://www.dropbox.com/s/x?b=1&dl=0&a=%20{}&b=2", ["https://www.dropbox.com/s/x?b=1&b=2&dl=1&a=+{}"]),
    ("https://m.imgur.com/gallery/{}.jpg", [f"https://i.imgur.com/{{}}{x}" for x in host_rules.PICTURE_EXT]),
    ("https://www.youtube.com/watch?a=1&v=a%2Db{}", [f"https://i.ytimg.com/vi/a-b{{}}/{x}.jpg" for x in host_rules.THUMBS]),
    ("http://www.plantuml.com/plantuml/uml/{}#x", ["http://www.plantuml.com/plantuml/png/{}#x", "http://www.plantuml.com/plantuml/svg/{}#x"]),
]
EDGES_SQL = ", ".join(f"({i}, {pos}, '{form}')" for i, (own, forms) in enumerate(EDGES) for pos, form in enumerate([*forms, own]))


@query("edge_candidates", f"""
WITH each AS (SELECT md5(p_name) AS hash, p_partkey AS seq, pos, replace(form, '{{}}', p_partkey::VARCHAR) AS url FROM part JOIN (VALUES {EDGES_SQL}) v(i, pos, form) ON p_partkey % {len(EDGES)} = i),
one AS (SELECT * FROM each QUALIFY row_number() OVER (PARTITION BY hash, url ORDER BY seq, pos) = 1)
SELECT hash, row_number() OVER (PARTITION BY hash ORDER BY seq, pos) AS rank, url, 'other_http' AS source_class FROM one""")
def edge_candidates(spark, d):
    """Special forms and cleaned addresses of each hash in order."""
    k = F.col("p_partkey")
    url = F.replace(F.get(F.array(*[F.lit(own) for own, _ in EDGES]), (k % len(EDGES)).cast("int")), F.lit("{}"), k.cast("string"))
    return recovery.edge_candidates(t(spark, d, "part").select(F.md5("p_name").alias("hash"), k.alias("seq"), url.alias("source_url"), F.lit("other_http").alias("source_class")))


@query("page_candidates")
def page_candidates(spark, d):
    """Image candidates of whole pages (needs an HTML parser)."""
    p = recovery.page_candidates(t(spark, d, "pages").select("page_id", F.col("url").alias("page_url"), "html"))
    return p.select("page_id", F.size("candidates").alias("n"), F.array_join("candidates", " ").alias("candidates"))


@query("url_safety", """
SELECT page_id, CASE page_id % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN true WHEN 4 THEN true ELSE false END AS rejected FROM pages""")
def url_safety(spark, d):
    """Private and mixed resolutions, credentials, other schemes and no host are rejected; a public one isn't."""
    k, public = F.col("page_id") % 6, F.lit("93.184.216.34")
    url = F.when(k == 2, F.lit("http://user:pw@h.org/")).when(k == 3, F.lit("ftp://h.org/")).when(k == 4, F.lit("http:///x")).otherwise(F.col("url"))
    ips = F.when(k == 0, F.array(F.lit("10.0.0.1"))).when(k == 1, F.array(public, F.lit("127.0.0.1"))).otherwise(F.array(public))
    p = t(spark, d, "pages").select("page_id", url.alias("u"), ips.alias("ips")).select("page_id", candidates.url_problem("u", "ips").alias("problem"))
    return p.select("page_id", (F.coalesce("problem", F.lit("")) != "").alias("rejected"))


@query("lenient_ints", "SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' || event_id WHEN event_id % 3 = 1 THEN '' ELSE event_id::VARCHAR END AS BIGINT), 0) AS n FROM events")
def lenient_ints(spark, d):
    k = F.col("event_id")
    return t(spark, d, "events").select("event_id", records.lenient_int(F.when(k % 3 == 0, F.concat(F.lit("x"), k)).when(k % 3 == 1, "").otherwise(k.cast("string"))).alias("n"))


@query("stream_scan", """
WITH f AS (SELECT *, md5(u) AS h FROM """ + FORMS_SQL + """) SELECT name, u AS url, h AS hash FROM f WHERE substr(h, 1, 1) IN ('0', '1', '2')""")
def stream_scan(spark, d):
    """The dump scan as a stream that runs till its input is used up: names once each, their forms, wanted keys."""
    from ..streaming import scan

    return scan.names_to_matches(spark, part_names(spark, d).select("name"), ["0", "1", "2"])

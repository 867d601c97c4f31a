"""Packed archives and nested dumps, written from the driver's tables and read back: a query and its SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit
from ..sources import nested, packed
from ..sources.scratch import folder
from .bindings import query, t

ARCHIVES = 4


def archive_of(spark, d) -> str:
    """A folder of archives: a page for each order, for every fourth one an address that leads to it, and a line of metadata."""
    o, k = t(spark, d, "orders"), F.col("o_orderkey").cast("string")
    page = F.concat(F.lit("questions/"), k, F.lit("/"), F.lower(F.substring("o_orderpriority", 3, 20)))
    text = lambda c: F.lit(c).cast("string")
    items = o.select(F.lit("C").alias("namespace"), page.alias("path"), F.col("o_orderpriority").alias("title"), F.lit("text/html").alias("mime"), F.concat(F.lit("<p>"), k, F.lit(" é "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 100 == 0, F.lit("")).otherwise(F.lit("</p>"))).cast("binary").alias("content"), text(None).alias("target"))
    short = o.where("o_orderkey % 4 = 0").select(F.lit("C").alias("namespace"), F.concat(F.lit("a/"), k).alias("path"), F.concat(F.lit("a/"), k).alias("title"), text(None).alias("mime"), F.lit(None).cast("binary").alias("content"), page.alias("target"))
    out = folder(spark, "archives")
    packed.write_packed(items.unionByName(short), out, ARCHIVES, 32_768)
    return out


@query("archive_listing", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, 'questions/' || o_orderkey || '/' || lower(substr(o_orderpriority, 3, 20)) AS page, o_orderdate AS made FROM orders)
SELECT page AS path, p AS title, 'item' AS kind, NULL AS target, sha256('<p>' || k || ' é ' || strftime(made, '%Y-%m-%d') || CASE WHEN k % 100 = 0 THEN '' ELSE '</p>' END) AS sha256 FROM o
UNION ALL SELECT 'a/' || k, 'a/' || k, 'redirect', page, NULL FROM o WHERE k % 4 = 0""")
def archive_listing(spark, d):
    """All entries of several archives, read in splits, redirects with what they lead to."""
    path = archive_of(spark, d)
    listing = packed.entries(spark, path, content=True, split_entries=1000).withColumn("sha256", F.sha2("content", 256)).drop("content")
    return packed.with_targets(listing, packed.entries(spark, path, split_entries=1000)).select("path", "title", "kind", "target", "sha256")


@query("archive_search", """
WITH o AS (SELECT o_orderkey AS k, 'questions/' || o_orderkey || '/' || lower(substr(o_orderpriority, 3, 20)) AS page FROM orders)
SELECT page AS path, 'prefix' AS found_by FROM o WHERE page LIKE 'questions/1%' UNION ALL SELECT 'a/' || k, 'path' FROM o WHERE k IN (4, 32, 5) AND k % 4 = 0""")
def archive_search(spark, d):
    """Entries by prefix and by path; both are found by bisection, not by a scan."""
    path = archive_of(spark, d)
    by_prefix = packed.entries(spark, path, split_entries=1000, prefixes=["questions/1"]).select("path", F.lit("prefix").alias("found_by"))
    return by_prefix.unionByName(packed.entries(spark, path, paths=["a/4", "a/32", "a/5"]).select("path", F.lit("path").alias("found_by")))


@query("audit_packed", """
WITH o AS (SELECT o_orderkey AS k, 'questions/' || o_orderkey || '/' || lower(substr(o_orderpriority, 3, 20)) AS page FROM orders), n AS (SELECT count(*) + count(*) FILTER (k % 4 = 0) AS n FROM o)
SELECT 'magic' AS check, 'PASS' AS status, 72173914::BIGINT AS n UNION ALL SELECT 'entry_count', 'PASS', n FROM n
UNION ALL SELECT 'required_paths', 'WARN', 1 + (SELECT count(*) FILTER (k = 4) = 0 FROM o)::INT
UNION ALL SELECT 'content_sample', 'PASS', 0""")
def audit_packed(spark, d):
    """The head, required paths and an even sample of contents, from the archives themselves."""
    path = archive_of(spark, d)
    head = packed.heads(spark, path).agg(F.max("magic").alias("magic"), F.sum("entry_count").alias("entry_count")).first()
    questions = t(spark, d, "orders").count()
    listing = packed.entries(spark, path)
    sample = audit.sampled_rows(listing.where("kind = 'item'").select("path", "archive", "pos"), ["path"], 50)
    contents = packed.entries(spark, path, content=True).join(F.broadcast(sample.select("archive", "pos")), ["archive", "pos"], "left_semi")
    return audit.report(audit.archive_header(spark, head.asDict(), questions), audit.required_paths(listing, spark, ["a/4"], ["index"]), audit.content_sample(contents, spark))


def posts_of(spark, d) -> str:
    """A dump: orders as questions, lines as answers; comments, links, tags and marks by remainders."""
    quoted = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    k, line = F.col("o_orderkey"), F.col("l_linenumber")
    s = lambda c: c.cast("string")
    note = F.when(F.col("l_returnflag") == "R", F.concat(F.lit('<comments><comment Id="'), s(line), F.lit('" Text="returned &amp; noted"/></comments>'))).otherwise(F.lit(""))
    answer = F.concat(F.lit('\n<answer Id="'), s(line), F.lit('" Score="'), s(F.col("l_quantity").cast("long")), F.lit('" Body="&lt;p&gt;'), s(F.col("l_partkey")), F.lit('&lt;/p&gt;">'), note, F.lit("</answer>"))
    lists = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(line, answer.alias("x")))), lambda a: a["x"]), "").alias("answers"))
    j = t(spark, d, "orders").join(lists, k == F.col("l_orderkey"), "left")
    tags = F.when(k % 3 == 0, F.lit("<b><a>")).when(k % 3 == 1, F.lit("|x|")).otherwise(F.lit(""))
    link = F.when(k % 2 == 0, F.concat(F.lit('<links><link Id="'), s(F.col("o_custkey")), F.lit('" LinkTypeId="'), F.when(k % 4 == 0, F.lit("3")).otherwise(F.lit("1")), F.lit('" Name="n"/></links>'))).otherwise(F.lit("<links/>"))
    deleted = F.when(k % 50 == 0, F.lit(' DeletionDate="2020"')).otherwise(F.lit(""))
    text = F.concat(F.lit('<post Id="'), s(k), F.lit('" Score="'), F.when(k % 7 == 0, F.lit("")).otherwise(s(k % 11)), F.lit('" Title="'), quoted(F.concat(F.col("o_orderpriority"), F.lit(' & <"x"> é'))), F.lit('" Tags="'), quoted(tags), F.lit('"'), deleted, F.lit(">"), F.when(F.col("o_orderstatus") == "F", F.lit('<comments><comment Id="2" Text="b"/>\n<comment Id="1" Text="a"/></comments>')).otherwise(F.lit("")), F.coalesce(F.concat(F.lit("<answers>"), F.col("answers"), F.lit("</answers>")), F.lit("")), link, F.lit("</post>"))
    out = folder(spark, "posts")
    j.select(text.alias("value")).write.text(out)
    return out


@query("nested_posts", """
WITH a AS (SELECT l_orderkey AS k, string_agg(l_linenumber || ':' || l_quantity::BIGINT || CASE WHEN l_returnflag = 'R' THEN 'returned & noted' ELSE '' END, ',' ORDER BY l_quantity::BIGINT DESC, l_linenumber, l_partkey::VARCHAR, l_returnflag = 'R') AS answers, count(*) AS n, min('<p>' || l_partkey || '</p>') AS body FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 11 END AS score, o_orderpriority || ' & <"x"> é' AS title, CASE o_orderkey % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x' ELSE '' END AS tags,
  coalesce(answers, '') AS answers, coalesce(n, 0) AS nb_answers, body, CASE WHEN o_orderstatus = 'F' THEN '2b,1a' ELSE '' END AS comments, CASE WHEN o_orderkey % 4 = 2 THEN o_custkey END AS linked, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS duplicate, o_orderkey % 50 = 0 AS deleted
FROM orders LEFT JOIN a ON a.k = o_orderkey""")
def nested_posts(spark, d):
    """Questions with comments, answers (by score) and links from one dump."""
    good, bad = nested.questions(spark, posts_of(spark, d))
    words = F.transform("answers", lambda a: F.concat(a["Id"].cast("string"), F.lit(":"), a["Score"].cast("string"), F.array_join(F.transform(a["comments"], lambda c: c["Text"]), "|")))
    notes = F.array_join(F.transform("comments", lambda c: F.concat(c["Id"].cast("string"), c["Text"])), ",")
    return good.select(F.col("Id").alias("id"), F.col("Score").alias("score"), F.col("Title").alias("title"), F.array_join("Tags", ",").alias("tags"), F.array_join(words, ",").alias("answers"), F.col("nb_answers").cast("long").alias("nb_answers"), F.array_min(F.transform("answers", lambda a: a["Body"])).alias("body"), notes.alias("comments"), F.get("links.linked", F.lit(0))["Id"].alias("linked"), F.get("links.duplicate", F.lit(0))["Id"].alias("duplicate"), "deleted")

"""Streams over the driver's tables that keep state: a query and its SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..sources.scratch import folder
from ..streaming import fetching, scan
from .bindings import FORMS_SQL, part_names, query, t


@query("open_scan", f"""
WITH f AS (SELECT *, md5(u) AS h FROM {FORMS_SQL}), w AS (SELECT DISTINCT h FROM f WHERE (k + i) % 5 < 2)
SELECT h AS hash, 'https://i.sstatic.net/' || min_by(name, row(k, i)) AS source_url FROM f SEMI JOIN w USING (h) GROUP BY h""")
def open_scan(spark, d):
    """The dump scan as a stream over several batches of lines in any order; a key's first place counts."""
    forms = part_names(spark, d).select("k", F.posexplode(urls.posts_candidates(F.col("name"))).alias("i", "u"))
    wanted = forms.where((F.col("k") + F.col("i")) % 5 < 2).select(urls.image_key(F.col("u")).alias("hash"))
    name = F.concat(F.substring(F.md5("p_name"), 1, 5), F.when(F.col("p_partkey") % 2 == 0, ".png").otherwise(""))
    src, out, check = folder(spark, "lines"), folder(spark, "hits"), folder(spark, "scan")
    t(spark, d, "part").select(F.col("p_partkey").alias("line_no"), F.concat(F.lit(f'<row Body="https://{urls.PRIMARY_HOST}/'), name, F.lit('" />')).alias("line")).repartition(3, "line_no").write.parquet(src)
    scan.scan_open(scan.line_stream(spark, src, 1), wanted, out, check, in_order=False)
    return scan.found(spark, out)


#: Answers to one address after another, by the page's remainder.
PLANS = ["200", "503-200", "404", "500-500-500-500", "408-200", "x-503-200", "301"]


def answer(url: str, attempt: int):
    codes = url.rsplit("/", 1)[-1].split("-")
    code = codes[min(attempt, len(codes) - 1)]
    return (None if code == "x" else int(code)), code.encode(), None


@query("fetch_stream", """
SELECT page_id, CASE WHEN page_id % 7 IN (0, 1, 4, 5) THEN 'ok' ELSE 'fail' END AS status, CASE page_id % 7 WHEN 1 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 2 WHEN 5 THEN 3 ELSE 1 END AS attempts,
  CASE page_id % 7 WHEN 2 THEN 'HTTP 404' WHEN 3 THEN 'HTTP 500' WHEN 6 THEN 'HTTP 301' ELSE '' END AS reason, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages""")
def fetch_stream(spark, d):
    """Pages fetched host by host with two retries, by a fetcher that answers from the address."""
    plan = F.get(F.array(*map(F.lit, PLANS)), (F.col("page_id") % len(PLANS)).cast("int"))
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    pages = t(spark, d, "pages")
    src, out, check = folder(spark, "items"), folder(spark, "outcomes"), folder(spark, "fetching")
    pages.select(F.col("page_id").cast("string").alias("hash"), F.concat(F.lit("https://"), host, F.lit("/"), plan).alias("url"), host.alias("host")).write.parquet(src)
    n = pages.count()
    items = spark.readStream.schema("hash string, url string, host string").parquet(src)
    fetching.run(items, out, check, answer, lambda ledger: fetching.settled(ledger, n), retries=2, base=0.001, pace=0.0, per_batch=1000)
    return fetching.results(spark, out).select(F.col("hash").cast("bigint").alias("page_id"), "status", "attempts", "reason", "host")

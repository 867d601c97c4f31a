"""Images' sizes, limits and verification on payloads made from parts' keys: a query and its SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dimensions
from ..operators import images, rescue
from .bindings import query, t

#: Sides of a part's picture; some pass the limits.
WIDE, HIGH = "1 + (p_partkey * 37) % 20000", "1 + (p_partkey * 91) % 20000"


def number(c, n: int, little: bool = False):
    h = F.lpad(F.hex(c), 2 * n, "0")
    return F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))]) if little else h


def payload(w, h):
    """A picture's first bytes in hex, of six kinds by the key."""
    pad = F.lit("00")
    kinds = [
        F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), number(w, 4), number(h, 4)), F.concat(F.lit("474946383961"), number(w, 2, True), number(h, 2, True), F.lit("0000003B")),
        F.concat(F.lit("FFD8FFE000044A46FFDB0002FFC0001108"), number(h, 2), number(w, 2), F.repeat(pad, 10)), F.concat(F.lit("424D"), F.repeat(pad, 12), F.lit("28000000"), number(w, 4, True), number(h, 4, True)),
        F.concat(F.lit("52494646FF0000005745425056503858"), F.repeat(pad, 8), number(w - 1, 3, True), number(h - 1, 3, True)), F.concat(F.lit("FFD8"), F.repeat(F.lit("FFE1000300"), 40), F.lit("FFC2001108"), number(h, 2), number(w, 2)),
    ]
    return F.get(F.array(*kinds), (F.col("p_partkey") % len(kinds)).cast("int"))


@query("image_limits", f"""
SELECT p_partkey, {WIDE} AS width, {HIGH} AS height, {WIDE} <= 16384 AND {HIGH} <= 16384 AND ({WIDE}) * ({HIGH}) <= 100000000 AS decodable FROM part""")
def image_limits(spark, d):
    """Sizes by the bytes of six kinds, JPEG's by its segments, and the limits of decoding."""
    c = F.unhex(payload(F.expr(WIDE), F.expr(HIGH)))
    # dealt anew: a small file of many rows is one task's, and bytes that come from a shuffle aren't made again for each use
    files = t(spark, d, "part").select("p_partkey", c.alias("c")).repartition("p_partkey")
    size = files.select("p_partkey", "c", dimensions.dimensions(F.col("c")).alias("s"))
    return size.select("p_partkey", "s.width", "s.height", dimensions.is_decodable_image(F.col("c")).alias("decodable"))


PLACEHOLDER = "47494638396101000100000000 3B".replace(" ", "")


@query("verify_images", """
WITH p AS (SELECT md5(p_name) AS h, min(p_partkey) AS k, bool_or(p_partkey % 4 < 2) AS rec FROM part GROUP BY 1),
s AS (SELECT *, k % 7 <> 0 AS there, CASE WHEN k % 7 = 0 THEN 'missing-file' WHEN k % 7 = 1 THEN 'empty-file' WHEN k % 7 = 2 THEN 'invalid-image' WHEN k % 7 = 3 AND rec THEN 'placeholder' END AS problem FROM p)
SELECT count(*) AS hashes_checked, count(*) FILTER (rec) AS recovered_entries, count(*) FILTER (k % 7 = 3) AS placeholders_remaining, count(problem) AS problems, count(*) FILTER (there) AS sampled,
  count(*) FILTER (k % 7 IN (1, 2, 5)) AS sample_issues, 'FAIL' AS result FROM s""")
def verify_images(spark, d):
    """A manifest's hashes against a stage's files: problems, and a deep check of a sample as large as the stage."""
    part = t(spark, d, "part")
    manifest = part.select(F.when(F.col("p_partkey") % 3 == 0, F.upper(F.md5("p_name"))).otherwise(F.md5("p_name")).alias("hash"), F.get(F.array(*map(F.lit, ["ok", "recovered", "candidate", "fail"])), (F.col("p_partkey") % 4).cast("int")).alias("status"))
    k = F.col("k")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), number(k % 999 + 1, 4), F.lit("00000010"))
    gif = F.concat(F.lit("474946383961"), number(k % 999 + 2, 2, True), F.lit("01000000003B"))
    content = F.when(k % 7 == 1, "").when(k % 7 == 2, F.lit("3C68746D6C3E")).when(k % 7 == 3, PLACEHOLDER).when(k % 7 == 5, png).otherwise(gif)
    files = part.groupBy(F.md5("p_name").alias("name")).agg(F.min("p_partkey").alias("k")).where("k % 7 <> 0").select("name", F.unhex(content).alias("content"))
    import hashlib

    twin = bytes.fromhex(PLACEHOLDER)
    return images.summary(images.states(manifest, files, len(twin), hashlib.sha256(twin).hexdigest()), images.deep_sample(files, part.count(), 7))


@query("rescue_rounds", """
SELECT p_partkey::VARCHAR AS hash, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 OR p_partkey % 14 = 0 THEN 'ok' ELSE 'failed' END AS status,
  CASE WHEN p_partkey % 3 = 0 THEN 2 WHEN p_partkey % 5 = 0 THEN 3 WHEN p_partkey % 2 = 0 THEN 4 ELSE 3 END AS attempts, 'https://x.org/' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '/1' WHEN p_partkey % 5 = 0 OR p_partkey % 2 = 1 THEN '/2' ELSE '/9' END AS last_url FROM part""")
def rescue_rounds(spark, d):
    """Three candidates of each hash, one of which may be a page with a fourth; outcomes and pages come from tables."""
    k = F.col("p_partkey")
    at = lambda i: F.concat(F.lit("https://x.org/"), k.cast("string"), F.lit("/"), i)
    part = t(spark, d, "part").select("p_partkey").repartition("p_partkey")  # one small file of many rows would be one task's work
    candidates = part.select(k.cast("string").alias("hash"), F.explode(F.expr("sequence(0, 2)")).alias("rank"), k).select("hash", "rank", at(F.col("rank").cast("string")).alias("url"), F.lit("stage").alias("source_class"))
    ok = lambda n, other: F.when(k % n == 0, "ok").otherwise(other)
    first = F.when(k % 2 == 0, "invalid_content").otherwise("http_error")
    answers = part.select(k, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), s.alias("status")) for i, s in [("0", first), ("1", ok(3, "too_large")), ("2", ok(5, "http_error")), ("9", ok(7, "http_error"))]])).alias("a")).select(at(F.col("a.i")).alias("url"), "a.status")
    pages = part.select(at(F.lit("0")).alias("url"), F.concat(F.lit('<img src="/'), k.cast("string"), F.lit('/9"><img src="/'), k.cast("string"), F.lit('/1">')).alias("html"))
    attempts, states = rescue.rescue(candidates, lambda u: u.join(answers.hint("merge"), "url"), lambda u: u.join(pages.hint("merge"), "url"), ahead=8)
    seen = attempts.groupBy("hash").agg(F.count(F.lit(1)).alias("attempts"), F.max_by("url", "rank").alias("last_url"))
    return states.join(seen.hint("merge"), "hash")

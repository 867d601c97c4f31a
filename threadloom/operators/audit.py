"""Audit checks. Each is a one-row frame (check, status, detail); a report is their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import media, records
from . import ranking


def check(df: DataFrame, name: str, n: Column, status: Column, **counts: Column) -> DataFrame:
    row = df.agg(n.alias("n"), *[c.alias(k) for k, c in counts.items()])
    return row.select(F.lit(name).alias("check"), status.alias("status"), F.col("n").cast("long").alias("n"))


def none_may(df: DataFrame, name: str, bad: Column, worst: str = "FAIL") -> DataFrame:
    """PASS if no row is bad."""
    return check(df, name, F.count_if(bad), F.when(F.col("n") > 0, worst).otherwise("PASS"))


def some_must(df: DataFrame, name: str) -> DataFrame:
    """FAIL without rows."""
    return check(df, name, F.count(F.lit(1)), F.when(F.col("n") == 0, "FAIL").otherwise("PASS"))


def duplicates(df: DataFrame, key: str, name: str = "duplicate_paths") -> DataFrame:
    """Each occurrence of a path after its first; empty ones don't count."""
    per = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("_more"))
    return check(per, name, F.coalesce(F.sum("_more"), F.lit(0)), F.when(F.col("n") > 0, "FAIL").otherwise("PASS"))


def unresolved(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References (hash) that no file has, by its name or by its name without extension."""
    names = files.select(F.explode(F.array("name", F.regexp_replace("name", r"\.[^.]*$", ""))).alias("hash")).distinct()
    return refs.join(names, "hash", "left_anti")


def placeholders(df: DataFrame, size_equal: Column, confirmed: Column, has_digest: bool) -> DataFrame:
    return check(df, "placeholders", F.count_if(confirmed), F.lit("PASS" if has_digest else "WARN"), sized=F.count_if(size_equal))


def compare(actual: DataFrame, baseline: dict[str, int], tolerance: float = 0.02, large_percent: float = 50, least: dict[str, int] | None = None, allow_large: bool = False) -> DataFrame:
    """``actual``: (metric, value, rule). ``metric, status, expected, actual``. Rules: size (fails under 1 % of the baseline), entries (fails
    without a value, under a minimum or beyond a large difference), pages (fails empty or under a minimum, warns beyond the
    tolerance), images (fails empty, warns beyond the tolerance), info."""
    least = least or {}
    expected = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in baseline.items()], F.lit(None)).cast("long")
    minimum = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in least.items()], F.lit(0)).cast("long")
    d = actual.withColumn("expected", expected).withColumn("_min", minimum)
    v, e, rule = F.col("value"), F.col("expected"), F.col("rule")
    off = ~records.within_tolerance(e, v, tolerance)
    large = (F.abs(v - e) * 100 > large_percent * e) & F.lit(not allow_large)
    status = (
        F.when(rule == "info", "INFO").when(e.isNull(), "INFO")
        .when(rule == "size", F.when(v * 100 < e, "FAIL").otherwise("PASS"))
        .when(rule == "entries", F.when(v.isNull() | (v == 0) | (v < F.col("_min")) | large, "FAIL").otherwise("PASS"))
        .when(rule == "pages", F.when((v == 0) | (v < F.col("_min")), "FAIL").when(off, "WARN").otherwise("PASS"))
        .when(rule == "images", F.when(v == 0, "FAIL").when(off, "WARN").otherwise("PASS"))
    )
    return d.select("metric", status.alias("status"), "expected", v.alias("actual"))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summary(checks: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL", "INFO")]
    return checks.agg(*counts, F.when(F.bool_or(F.col("status") == "FAIL"), "FAIL").otherwise("PASS").alias("result"))


def listing_digest(files: DataFrame) -> str:
    """Digest of the lines ``sha256  path`` in the order of paths: 64 bytes and a path of each file pass through the driver, in the
    order of a distributed sort."""
    import hashlib

    out = hashlib.sha256()
    for r in files.select("path", "sha256").orderBy("path").toLocalIterator():
        out.update(f"{r.sha256}  {r.path}\n".encode())
    return out.hexdigest()


def row(spark, name: str, status: str, n: int = 0) -> DataFrame:
    """A check whose outcome is known without a table."""
    return spark.range(1).select(F.lit(name).alias("check"), F.lit(status).alias("status"), F.lit(n).cast("long").alias("n"))


def sampled_rows(df: DataFrame, order: list[str], sample: int | None) -> DataFrame:
    return df if sample is None else ranking.even_sample(df, order, df.count(), sample)


def answer_redirects(manifests: DataFrame, sample: int | None = None) -> DataFrame:
    """``manifests``: (path, json text or null). Fails if one of the sample (all, if strict) has no list of redirects; n counts those."""
    bad = F.try_variant_get(F.try_parse_json("json"), "$.answer_redirects", "array<variant>").isNull()
    some = sampled_rows(manifests, ["path"], sample)
    return check(some.select(bad.alias("_bad")), "answer_redirects", F.count_if("_bad"), F.when(F.col("rows") == 0, "WARN").when(F.col("n") > 0, "FAIL").otherwise("PASS"), rows=F.count(F.lit(1)))


def magic_sample(files: DataFrame) -> DataFrame:
    """``files``: (name, content). Fails if a file's first bytes don't suit its extension; warns without files; n counts misfits."""
    ext = F.lower(F.regexp_extract("name", r"(\.[^./]*)$", 1))
    d = files.select(media.ext_matches(ext, F.substring("content", 1, 16)).alias("_ok"))
    return check(d, "mime_sample", F.count_if(~F.col("_ok")), F.when(F.col("rows") == 0, "WARN").when(F.col("n") > 0, "FAIL").otherwise("PASS"), rows=F.count(F.lit(1)))


def manifest_digests(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """``manifests``: (dir, json); ``files``: (dir, name, sha256). Rows (dir, name, matches) for each recorded ``x_sha256`` whose file is
    there as ``x``, ``x.html`` or ``x.json``, in this order."""
    fields = manifests.select("dir", F.explode_outer(F.from_json("json", "map<string,string>")).alias("_key", "_value"))
    fields = fields.where(F.col("_key").endswith("_sha256") & (F.coalesce("_value", F.lit("")) != ""))
    base = F.expr("substring(_key, 1, length(_key) - 7)")
    each = fields.select("dir", "_key", "_value", F.posexplode(F.array(base, F.concat(base, F.lit(".html")), F.concat(base, F.lit(".json")))).alias("_pos", "name"))
    # digests of all files: never broadcast, though few bytes of a compressed table may look like little
    best = each.hint("merge").join(files, ["dir", "name"]).groupBy("dir", "_key", "_value").agg(F.min(F.struct("_pos", "name", "sha256")).alias("_f"))
    return best.select("dir", F.col("_f.name").alias("name"), (F.col("_f.sha256") == F.lower("_value")).alias("matches"))


def input_hashes(digests: DataFrame) -> DataFrame:
    """Of ``manifest_digests``: INFO without any, FAIL with a difference; n counts differences."""
    return check(digests, "input_hashes", F.count_if(~F.col("matches")), F.when(F.col("rows") == 0, "INFO").when(F.col("n") > 0, "FAIL").otherwise("PASS"), rows=F.count(F.lit(1)))


def cardinalities(sets: DataFrame, required: list[str], reachable: bool = True) -> DataFrame:
    """``sets``: (key, value), value null where it can't be read. A row for each required key; zero, unread and unknown ones fail, and all
    of them in one row if the state can't be reached. Without required keys, one INFO row."""
    spark = sets.sparkSession
    if not required:
        return row(spark, "state", "INFO")
    if not reachable:
        return row(spark, "state", "FAIL", len(required))
    keys = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in required])).alias("key"))
    j = keys.join(sets.groupBy("key").agg(F.max("value").alias("value")), "key", "left")
    n = F.coalesce("value", F.lit(0)).cast("long")
    each = j.select(F.concat(F.lit("state_"), "key").alias("check"), F.when(n > 0, "PASS").otherwise("FAIL").alias("status"), n.alias("n"))
    return row(spark, "state", "PASS", len(required)).unionByName(each)


#: The archive format's number, paths that an archive should have and names of its first page.
ARCHIVE_MAGIC = 0x044D495A


def archive_header(spark, header: dict | None, questions: int, tolerate: bool = False) -> DataFrame:
    """Magic number and entry count of an archive's header: none or a wrong number fails (warns if tolerated), and so does an entry
    count of 0 or not above 90 % of the questions of the baseline."""
    worst = "WARN" if tolerate else "FAIL"
    if header is None:
        return row(spark, "magic", worst).unionByName(row(spark, "entry_count", worst))
    n = header["entry_count"]
    return row(spark, "magic", "PASS" if header["magic"] == ARCHIVE_MAGIC else worst, header["magic"]).unionByName(row(spark, "entry_count", "PASS" if n > questions * 9 // 10 and n else "FAIL", n))


def required_paths(entries: DataFrame | None, spark, required: list[str], homes: list[str]) -> DataFrame:
    """``entries``: (path), or none if no listing could be had. Missing paths, a missing folder of questions or first page warn only;
    n counts what is missing."""
    if entries is None:
        return row(spark, "required_paths", "WARN").unionByName(row(spark, "degraded", "WARN"))
    p = F.col("path")
    home = F.lit(False)
    for h in homes:
        home = home | (p == h) | p.startswith(f"{h}/") | F.element_at(F.split(p, "/"), -1).contains(h)
    tests = [F.bool_or(p == r) for r in required] + [F.bool_or((p == "questions") | p.startswith("questions/")), F.bool_or(home)]
    n = sum((F.when(F.coalesce(t, F.lit(False)), 0).otherwise(1) for t in tests), F.lit(0))
    return check(entries, "required_paths", n, F.when(F.col("n") > 0, "WARN").otherwise("PASS"))


def content_sample(entries: DataFrame | None, spark, sample: int | None = None) -> DataFrame:
    """``entries``: (path, content). Fails if one of the sample is missing, empty or no UTF-8; n counts those. Warns without any."""
    if entries is None:
        return row(spark, "content_sample", "WARN")
    c = F.col("content")
    bad = c.isNull() | (F.octet_length(c) == 0) | ~F.is_valid_utf8(c.cast("string"))
    some = sampled_rows(entries, ["path"], sample)
    return check(some.select(bad.alias("_bad")), "content_sample", F.count_if("_bad"), F.when(F.col("rows") == 0, "WARN").when(F.col("n") > 0, "FAIL").otherwise("PASS"), rows=F.count(F.lit(1)))


def checker(spark, exit_code: int | None) -> DataFrame:
    """An external checker's exit code; null if it ran out of time."""
    return row(spark, "checker", "PASS" if exit_code == 0 else "FAIL", -1 if exit_code is None else exit_code)


def snapshot(counts: DataFrame, baseline: dict[str, int], tolerance: float = 0.02) -> DataFrame:
    """``counts``: (metric, value), value null where it can't be read. Pages and images: above 0 and within the tolerance; state keys:
    within it, or WARN if unread; done: above 1000, but only for a baseline of 10 million pages and more, else WARN."""
    expected = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in baseline.items()], F.lit(0)).cast("long")
    v, m = F.col("value"), F.col("metric")
    fits = records.within_tolerance(expected, v, tolerance)
    large = baseline.get("pages", 0) >= 10_000_000
    done = F.when(F.coalesce(v, F.lit(0)) > 1000, "PASS").otherwise("FAIL") if large else F.lit("WARN")
    status = F.when(m == "done", done).when(m == "state_keys", F.when(v.isNull(), "WARN").when(fits, "PASS").otherwise("FAIL")).otherwise(F.when((F.coalesce(v, F.lit(0)) > 0) & fits, "PASS").otherwise("FAIL"))
    return counts.select(m.alias("check"), status.alias("status"), F.coalesce(v, F.lit(0)).cast("long").alias("n"))


def structure(folders: DataFrame) -> DataFrame:
    """``folders``: (shard, post, has_page). Two rows: shards of two hex digits, and pages in them; none fails."""
    d = folders.where(F.col("shard").rlike("^[0-9a-f]{2}$"))
    shards = check(d, "structure", F.countDistinct("shard"), F.when(F.col("n") > 0, "PASS").otherwise("FAIL"))
    return shards.unionByName(check(d, "structure_pages", F.count_if("has_page"), F.when(F.col("n") > 0, "PASS").otherwise("FAIL")))


def preflight(spark, marker: bool, pages: int, state_up: bool, snapshot_ok: bool, free_bytes: int, last_bytes: int) -> DataFrame:
    """What must hold before an archive is built: a marker, staged pages, state, a good snapshot, and free space of one and a half times
    the last output."""
    tests = [("marker", marker, 0), ("staged_pages", pages > 0, pages), ("state", state_up, 0), ("snapshot", snapshot_ok, 0), ("free_space", 2 * free_bytes >= 3 * last_bytes, free_bytes)]
    return report(*[row(spark, k, "PASS" if ok else "FAIL", n) for k, ok, n in tests])


def new_artifact(before: list[str], after: list[str]) -> str:
    """The one file that a build has made; any other number is an error."""
    made = sorted(set(after) - set(before))
    if len(made) != 1:
        raise ValueError(f"expected one new file, found {len(made)}")
    return made[0]

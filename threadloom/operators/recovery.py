"""Recovery of missing images: inventory, classes, matching of candidates by key, edge cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import candidates, host_rules, media, pages, urls
from . import ranking


def inventory(staged: DataFrame) -> DataFrame:
    """``staged``: (page_path, html). ``hash, page_path, count, source_class, anchor_href``: references of each page, and the first
    address that an anchor around the image links to."""
    refs = staged.select("page_path", F.explode_outer(pages.image_refs(F.col("html"))).alias("hash")).where("hash is not null")
    counts = refs.groupBy("hash", "page_path").agg(F.count(F.lit(1)).alias("count"))
    links = staged.select("page_path", F.posexplode_outer(pages.anchor_images(F.col("html"))).alias("_pos", "_a")).where("_a is not null")
    first = links.groupBy("page_path", F.col("_a.hash").alias("hash")).agg(F.min_by(F.col("_a.href"), "_pos").alias("_href"))
    out = counts.join(first, ["hash", "page_path"], "left")
    return out.select("hash", "page_path", "count", F.lit("stage").alias("source_class"), F.coalesce(pages.unescape(urls.strip(F.col("_href"))), F.lit("")).alias("anchor_href"))


def missing(inventory_rows: DataFrame, files: DataFrame, size: int, sha256: str | None) -> DataFrame:
    """Hashes of the inventory with ``state``: absent, placeholder or present, and ``twin`` for a file of the placeholder's size
    only. ``files``: (name, content)."""
    hashes = inventory_rows.select("hash").distinct()
    j = hashes.join(files.select(F.col("name").alias("hash"), "content"), "hash", "left")
    ph = media.is_placeholder(F.col("content"), size, sha256)
    state = F.when(F.col("content").isNull(), "absent").when(ph, "placeholder").otherwise("present")
    return j.select("hash", state.alias("state"), F.coalesce((F.octet_length("content") == size) & ~ph, F.lit(False)).alias("twin"))


def classify_missing(inventory_rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``inventory_rows`` with ``seq``; ``gone``: (hash). ``hash, source_url, source_class, status, page``: a row for each distinct
    address of a hash, or one without an address where no anchor has one."""
    rows = inventory_rows.join(gone.select("hash").distinct(), "hash", "left_semi").withColumn("_c", urls.classify_url(F.col("anchor_href")))
    rows = rows.withColumn("_has", urls.strip(F.coalesce("anchor_href", F.lit(""))) != "")
    some = rows.withColumn("_any", F.max("_has").over(Window.partitionBy("hash")))
    kept = some.where("_has or not _any").withColumn("_url", F.when(F.col("_has"), F.col("_c.url")).otherwise(""))
    one = ranking.first_wins(kept, ["hash", "_url"], ["seq"])
    kind = F.when(F.col("_has"), F.col("_c.source_class")).otherwise("no_original_url")
    return one.select("hash", F.col("_url").alias("source_url"), kind.alias("source_class"), F.lit("missing").alias("status"), F.col("page_path").alias("page"))


def archive_manifest(classified: DataFrame) -> DataFrame:
    """Rows whose address names a file of the five-letter archive, with that name."""
    u = F.col("source_url")
    return classified.where((F.col("source_class") == "ia_stack_imgur") | u.rlike(urls.SHARD_NAME)).withColumn("ia_filename", urls.ia_filename(u))


def match_posts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``lines``: (line_no, line); ``wanted``: (hash). ``hash, source_url``: a name counts where it is first seen, a hash with the
    first name whose candidates have it, and the address is always the live one."""
    return match_names(first_seen(lines), wanted)


def first_seen(lines: DataFrame) -> DataFrame:
    """``name, _at``: each name of the lines with the place where it is first seen."""
    names = lines.select("line_no", F.posexplode_outer(urls.dump_names(F.col("line"))).alias("_pos", "name")).where("name is not null")
    return names.groupBy("name").agg(F.min(F.struct("line_no", "_pos")).alias("_at"))


def match_names(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """``names``: (name, _at), distinct. Names are deduplicated before candidates multiply them."""
    best = first_hits(names, wanted)
    return best.select("hash", F.concat(F.lit(f"https://{urls.PRIMARY_HOST}/"), F.col("name")).alias("source_url"))


def first_hits(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """``hash, name, _first``: the first name whose candidates have a hash, and its place (of the name, then of the candidate)."""
    forms = names.select("name", "_at", F.posexplode(urls.posts_candidates(F.col("name"))).alias("_form", "_url")).withColumn("hash", urls.image_key(F.col("_url")))
    hit = forms.join(wanted.select("hash").distinct(), "hash", "left_semi")
    return hit.groupBy("hash").agg(F.min(F.struct("_at", "_form", "name")).alias("_m")).select("hash", "_m.name", F.struct("_m._at", "_m._form").alias("_first"))


def match_history(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``hash, source_url`` from history lines (unescaped). Each line takes one form of a name at most, so a name on n lines gives its
    first n wanted forms. ``wanted`` holds what is still open."""
    names = lines.select("line_no", F.explode_outer(urls.history_names(pages.unescape(F.col("line")))).alias("_n")).where("_n is not null")
    seen = names.groupBy(F.col("_n.name").alias("name"), F.col("_n.ext").alias("ext")).agg(F.countDistinct("line_no").alias("_lines"))
    forms = seen.select("name", "ext", "_lines", F.posexplode(urls.history_candidates(F.col("name"), F.col("ext"))).alias("_form", "source_url"))
    hit = forms.withColumn("hash", urls.image_key(F.col("source_url"))).join(wanted.select("hash").distinct(), "hash", "left_semi")
    w = Window.partitionBy("name", "ext").orderBy("_form")
    return hit.withColumn("_rn", F.row_number().over(w)).where("_rn <= _lines").select("hash", "source_url")


def host_counts(sources: DataFrame, n: int | None = None) -> DataFrame:
    """``sources``: (seq, url). ``host, count, sample_url``: first address of each host cut to 120; ties in order of first sight."""
    host = F.regexp_extract("url", "(?i)https?://([^/]+)", 1)
    per = sources.select("seq", "url", host.alias("host")).where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct("seq", F.substring("url", 1, 120).alias("u"))).alias("_f"))
    out = per.select("host", "count", F.col("_f.u").alias("sample_url"), F.col("_f.seq").alias("_seq"))
    return (ranking.top_with_ties(out, n, "count", "_seq") if n else out).drop("_seq")


def edge_candidates(classified: DataFrame) -> DataFrame:
    """``classified``: (hash, seq, source_url, source_class). ``hash, rank, url, source_class``: for each row the special forms and then
    the cleaned address; an address counts once for a hash."""
    # dealt anew, as a small file of many rows is one task's; explode_outer, as for explode the optimizer computes the array a second time
    c = classified.repartition("hash", "seq").withColumn("_u", urls.clean_url(F.col("source_url")))
    c = c.where(urls.worth_trying(F.col("_u")))
    forms = c.withColumn("_all", F.array_append(host_rules.special_candidates(F.col("_u")), F.col("_u")))
    each = forms.select("hash", "seq", F.coalesce(F.nullif("source_class", F.lit("")), F.lit("other_http")).alias("source_class"), F.posexplode_outer("_all").alias("_pos", "url"))
    one = ranking.first_wins(each, ["hash", "url"], ["seq", "_pos"])
    return one.withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("seq", "_pos"))).select("hash", "rank", "url", "source_class")


def page_candidates(page: DataFrame) -> DataFrame:
    """``page``: (page_url, html). Adds ``candidates``, best first."""
    return page.withColumn("candidates", candidates.ranked(candidates.page_scored("page_url", "html")))


def resolve(open_: DataFrame, page: DataFrame, rounds: int = 3) -> DataFrame:
    """``open_``: (hash, rank, url). Pages (a fixture or a fetched table) that candidates name give further candidates, for at most
    ``rounds`` pages of a hash."""
    named = ranking.first_wins(open_.join(page_candidates(page.withColumnRenamed("page_url", "url").withColumn("page_url", F.col("url"))).select("url", "candidates"), "url"), ["hash", "url"], ["rank"])
    capped = named.withColumn("_rn", F.row_number().over(Window.partitionBy("hash").orderBy("rank"))).where(F.col("_rn") <= rounds)
    more = capped.select("hash", F.lit(1).alias("_late"), "rank", F.posexplode("candidates").alias("_pos", "url"))
    both = open_.select("hash", F.lit(0).alias("_late"), "rank", F.lit(0).alias("_pos"), "url").unionByName(more)
    return ranking.first_wins(both, ["hash", "url"], ["_late", "rank", "_pos"]).withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("_late", "rank", "_pos"))).select("hash", "rank", "url")


def shard_members(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows (hash, shard, basename) against members (shard, basename, pos, content, error): all rows, with ``status`` ok, missing_zip,
    missing_member or error. Of members with one basename the last in the shard counts; a shard that can't be read is an error."""
    shards = members.groupBy("shard").agg(F.max(F.when(F.col("basename").isNull(), F.col("error"))).alias("_bad"))
    last = members.where("basename is not null").groupBy("shard", "basename").agg(F.max_by(F.struct("content", "error"), "pos").alias("_m"))
    j = rows.join(shards.withColumn("_there", F.lit(True)), "shard", "left").join(last, ["shard", "basename"], "left")
    failed = F.coalesce("_bad", "_m.error").isNotNull()
    status: Column = F.when(F.col("_there").isNull(), "missing_zip").when(failed, "error").when(F.col("_m").isNull(), "missing_member").otherwise("ok")
    return j.select(*rows.columns, F.col("_m.content").alias("content"), F.coalesce("_bad", "_m.error").alias("error"), status.alias("status"))


def recovery_rate(initial: DataFrame, recovered: DataFrame) -> DataFrame:
    """``initial`` and ``recovered``: (hash). One row: counts and the share of initial hashes recovered, in percent to one digit."""
    r = initial.select("hash").distinct().join(recovered.select("hash").distinct().withColumn("_r", F.lit(1)), "hash", "left")
    n, k = F.count(F.lit(1)), F.count("_r")
    return r.agg(n.alias("initial"), k.alias("recovered"), F.when(n > 0, F.round(100 * k / n, 1)).alias("percent"))


def grouped(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Rows of each key as an array of structs, in order."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *columns))).alias("rows"))


def old_sizes(small: DataFrame, staged: DataFrame) -> DataFrame:
    """``small``: (hash, old_bytes, old_sha256); ``staged``: (hash, size, sha256). Size and digest of the staged file where a row has
    neither."""
    blank = (F.coalesce("old_bytes", F.lit(0)) == 0) & (F.coalesce("old_sha256", F.lit("")) == "")
    j = small.join(staged.select("hash", F.col("size").alias("_s"), F.col("sha256").alias("_d")), "hash", "left")
    new = {"old_bytes": F.coalesce("_s", F.lit(0)), "old_sha256": F.coalesce("_d", F.lit(""))}
    return j.select(*[F.when(blank, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in small.columns])


def twins_before_after(hashes: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Placeholders among ``hashes`` in two listings (hash, placeholder): one row, before and after."""
    def count(t: DataFrame, name: str) -> DataFrame:
        return t.join(hashes.select("hash").distinct(), "hash", "left_semi").agg(F.count_if("placeholder").alias(name))

    return count(before, "before").join(count(after, "after"))  # single rows


def reference_totals(refs: DataFrame, key: str = "hash") -> DataFrame:
    return refs.agg(F.count(key).alias("total"), F.countDistinct(key).alias("distinct"))

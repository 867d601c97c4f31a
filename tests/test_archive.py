"""Functions and operators of the archive engine on small cases."""

import json
import os
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from threadloom.functions import candidates, host_rules, media, pages, records, urls
from threadloom.operators import archive, audit, decisions, incremental, manifests, ranking, recovery
from threadloom.sources import readers, sinks


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_clean_url(spark):
    cases = {
        "https://example.com/a.png": "https://example.com/a.png",
        " https://example.com/a.png)'. ": "https://example.com/a.png",
        "![](https://example.com/a.png)": "https://example.com/a.png",
        "http://https://example.com/a": "https://example.com/a",
        "https://example.com/%5Ba%5D%28b%29": "https://example.com/[a](b)",
        "plain": "plain",
        "": "",
    }
    for raw, want in cases.items():
        assert one(spark, urls.clean_url(F.lit(raw))) == want
    assert one(spark, urls.clean_url(F.lit(None).cast("string"))) == ""


def test_camo(spark):
    good = "https://origin.org/x.png"
    assert one(spark, urls.decode_camo(F.lit(f"/abc/{good.encode().hex()}"))) == good
    for bad in ("/abc", "/abc/zz", "/abc/" + b"ftp://x".hex(), ""):
        assert one(spark, urls.decode_camo(F.lit(bad))) is None


def test_classes(spark):
    kinds = {"https://i.stack.imgur.com/AbC12.png": "ia_stack_imgur", "//i.sstatic.net/abcdef.png": "sstatic_candidate", "http://x.org/a": "other_http", "ftp://x": "no_original_url", "": "no_original_url"}
    for u, want in kinds.items():
        assert one(spark, urls.classify_url(F.lit(u)))["source_class"] == want
    assert one(spark, urls.host_of(F.lit("HTTP://User@Host:80/x"))) == "user@host:80"


def test_references(spark):
    h = "a" * 32
    text = f'<a href=" /x?a&amp;b "><img src="../images/{h}"></a> images/{h.upper()}? images/{"b" * 40}" /images/{"c" * 40}'
    assert one(spark, pages.image_refs(F.lit(text))) == [h, h]
    assert one(spark, pages.audit_refs(F.lit(text))) == [h, "c" * 32]
    rows = recovery.inventory(spark.createDataFrame([("p", text)], "page_path string, html string")).collect()
    assert [(r["hash"], r["count"], r["anchor_href"]) for r in rows] == [(h, 2, "/x?a&b")]


def test_prefilter_is_case_sensitive(spark):
    assert one(spark, urls.dump_names(F.lit("I.STACK.IMGUR.COM/abc.png"))) == []
    assert one(spark, urls.dump_names(F.lit("imgur I.STACK.IMGUR.COM/abc.png i.sstatic.net/abcdefghijklmnop"))) == ["abc.png", "abcdefghijkl"]


def test_posts_scan_first_name_decides(spark):
    lines = spark.createDataFrame([(1, "i.sstatic.net/abc x"), (2, "i.sstatic.net/abc.png")], "line_no long, line string")
    wanted = spark.range(1).select(F.md5(F.lit("https://i.sstatic.net/abc.png")).alias("hash"))
    assert [r.source_url for r in recovery.match_posts(lines, wanted).collect()] == ["https://i.sstatic.net/abc"]


def test_history_scan_one_form_a_line(spark):
    wanted = spark.createDataFrame([("https://i.sstatic.net/n.png",), ("http://i.stack.imgur.com/n.png",)], "u string").select(F.md5("u").alias("hash"))
    for n in (1, 2):
        lines = spark.createDataFrame([(i, "i.stack.imgur.com/n.png") for i in range(n)], "line_no long, line string")
        assert recovery.match_history(lines, wanted).count() == n


def test_sniffing(spark):
    cases = {b"\x89PNG\r\n\x1a\n....": "image/png", b"  \xff\xd8\xff.": "image/jpeg", b"GIF89a": "image/gif", b"RIFF....WEBP": "image/webp", b"BM..": "image/bmp", b"<svg/>": "image/svg+xml", b"<html>": "unknown", b"": "unknown"}
    for data, want in cases.items():
        assert one(spark, media.sniff(F.lit(bytearray(data)))) == want
    worker = {b"": "empty", b" <!DOCTYPE html>": "text/html", b"<title>Just a moment": "text/html", b" \xff\xd8\xff": "unknown", b"\xff\xd8\xff": "image/jpeg", b"<?xml": "image/svg+xml"}
    for data, want in worker.items():
        assert one(spark, media.sniff_payload(F.lit(bytearray(data)))) == want
    assert one(spark, media.is_valid_image(F.lit(bytearray(b"BM....")))) is True
    assert one(spark, media.is_valid_image(F.lit(bytearray(b"BM <html>")))) is False
    assert one(spark, media.is_placeholder(F.lit(bytearray(b"abc")), 3, None)) is False
    assert one(spark, media.is_placeholder(F.lit(bytearray(b"abc")), 3, "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD")) is True
    assert one(spark, media.ext_matches(F.lit(".webp"), F.lit(bytearray(b"RIFF....WEBP")))) is True


SPECIAL = {
    "https://www.youtube.com/watch?v=k1": [f"https://i.ytimg.com/vi/k1/{x}.jpg" for x in host_rules.THUMBS],
    "https://youtu.be/k1/": [f"https://i.ytimg.com/vi/k1/{x}.jpg" for x in host_rules.THUMBS],
    "https://www.youtube.com/shorts/abc?v=xyz": [f"https://i.ytimg.com/vi/abc/{x}.jpg" for x in host_rules.THUMBS],
    "https://www.youtube.com/watch?v=&t=1&v=a%2Db+c": [f"https://i.ytimg.com/vi/a-b c/{x}.jpg" for x in host_rules.THUMBS],
    "https://www.youtube.com/watch?list=v": [],
    "https://www.youtube.com/shorts/": [],
    "https://travis-ci.org/o/r": ["https://travis-ci.org/o/r.svg", "https://travis-ci.org/o/r.png", "https://api.travis-ci.org/o/r.svg?branch=master"],
    "https://IMG.shields.io/x.svg?a": ["https://img.shields.io/x.svg.png", "https://IMG.shields.io/x.svg?a"],
    "https://img.shields.io/x": ["https://img.shields.io/x.svg", "https://img.shields.io/x.png", "https://img.shields.io/x", "https://img.shields.io/x?style=flat"],
    "https://codecov.io/gh/o/r/branch/x": ["https://codecov.io/gh/o/r/branch/x.svg", "https://codecov.io/gh/o/r/branch/x.png", "https://codecov.io/gh/o/r/branch/x/branch/master/graph/badge.svg"],
    "https://github.com/o/r/blob/main/a/b.png": ["https://raw.githubusercontent.com/o/r/main/a/b.png"],
    "https://github.com/o/r/tree/blob/main/x.png": ["https://raw.githubusercontent.com/o/r/blob/main/x.png"],
    "https://github.com/o/r/blob/main": [],
    "https://www.dropbox.com/s/x?dl=0": ["https://www.dropbox.com/s/x?dl=1"],
    "https://www.dropbox.com/s/x": ["https://www.dropbox.com/s/x?dl=1"],
    "https://www.dropbox.com/s/x?b=1&c=*~%20&dl=0&b=2#f": ["https://www.dropbox.com/s/x?b=1&b=2&c=%2A~+&dl=1#f"],
    "https://1drv.ms/a": ["https://1drv.ms/a?download=1"],
    "https://imgur.com/a/.abc.tar.gz/": [f"https://i.imgur.com/.abc.tar{e}" for e in host_rules.PICTURE_EXT],
    "https://i.imgur.com/abc": [],
    "https://imgur.com/": [],
    "https://www.plantuml.com/plantuml/uml/A?/plantuml/uml/": [f"https://www.plantuml.com/plantuml/{k}/A?/plantuml/{k}/" for k in ("png", "svg")],
    "https://mermaid.live/edit#pako:x#pako:y": ["https://mermaid.ink/img/pako:x#pako:y", "https://mermaid.ink/svg/pako:x#pako:y"],
    f"https://camo.githubusercontent.com/d/{b'https://o.org/a'.hex()}": ["https://o.org/a"],
    "https://camo.githubusercontent.com/d/zz": [],
    "no address": [],
    None: [],
}


def test_special_candidates(spark):
    got = spark.createDataFrame([(u,) for u in SPECIAL], "u string").select("u", host_rules.special_candidates(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in got} == SPECIAL


def test_largest_of_srcset():
    for value, want in {"a 1x, b 3x,c 2x": ("b", 3), "a 100w, b 100w": ("a", 100), "a, b": (None, 0), "a 0w, b -2x": (None, 0), "": (None, 0), "a 1.5x, b 1x": ("b", 1), "x y 7w": ("x y", 7)}.items():
        assert candidates.largest_of_srcset(value) == want


def test_eleven_edge_candidates(spark):
    rows = [("h1", 1, f"https://camo.githubusercontent.com/d/{b'https://o.org/a.png'.hex()}", "other_http"), ("h2", 2, "https://www.youtube.com/watch?v=k", "other_http"), ("h3", 3, "https://travis-ci.org/o/r", "other_http")]
    got = recovery.edge_candidates(spark.createDataFrame(rows, "hash string, seq int, source_url string, source_class string"))
    assert {r["hash"]: r["count"] for r in got.groupBy("hash").count().collect()} == {"h1": 2, "h2": 5, "h3": 4}


def test_page_candidates(spark):
    html = '<link rel="icon" href="/f.ico"><img src="a.png" srcset="s.png 100w, l.png 900w"><meta property="og:image" content="https://x.org/m.png"><a href="b.jpg">'
    got = recovery.page_candidates(spark.createDataFrame([("https://x.org/p/", html)], "page_url string, html string")).first()["candidates"]
    assert got == ["https://x.org/m.png", "https://x.org/p/l.png", "https://x.org/p/b.jpg", "https://x.org/p/a.png", "https://x.org/f.ico"]


def test_url_safety():
    assert candidates.address_problem("https://x.org/a", ["93.184.216.34"]) == ""
    for u, ips, why in (("ftp://x", ["1.1.1.1"], "scheme"), ("https://u:p@x.org", ["1.1.1.1"], "credentials"), ("//x.org", ["1.1.1.1"], "scheme"), ("http://127.0.0.1/", None, "not-global"), ("http://[::1]/", None, "not-global"), ("http://x.org", ["1.1.1.1", "10.0.0.1"], "not-global"), ("http://x.org", [], "unresolved")):
        assert candidates.address_problem(u, ips) == why


def test_titles():
    assert records.clean_title("a\nb​ c", "Q") == "ab c"
    assert records.clean_title("ab", "Question 7") == "Question 7"
    assert len(records.clean_title("x" * 600, "Q")) == 500


def question(**changes):
    q = {
        "Id": 1, "Title": "t\u000b\"é", "Body": "b", "Score": 3, "Tags": ["b", "a"], "OwnerUserId": "9", "OwnerDisplayName": None, "CreationDate": "c", "LastActivityDate": None, "ViewCount": "5", "LastEditDate": None, "LastEditorUserId": None, "AcceptedAnswerId": None,
        "comments": [{"Id": i, "PostId": "1", "UserId": None, "Score": "0", "Text": f"c{i}", "CreationDate": None, "ContentLicense": None} for i in ("10", "9")],
        "answers": [{"Id": i, "Score": "1", "Body": f"a{i}", "OwnerUserId": None, "OwnerDisplayName": None, "CreationDate": None, "LastEditDate": None, "LastEditorUserId": None, "comments": None} for i in ("12", "2")],
        "links": [{"Id": 5, "Name": "n"}, {"Id": 4, "Name": "m"}],
    }
    return q | changes


COMMENT = "struct<Id:string,PostId:string,UserId:string,Score:string,Text:string,CreationDate:string,ContentLicense:string>"
SCHEMA = f"Id bigint, Title string, Body string, Score bigint, Tags array<string>, OwnerUserId string, OwnerDisplayName string, CreationDate string, LastActivityDate string, ViewCount string, LastEditDate string, LastEditorUserId string, AcceptedAnswerId string, comments array<{COMMENT}>, answers array<struct<Id:string,Score:string,Body:string,OwnerUserId:string,OwnerDisplayName:string,CreationDate:string,LastEditDate:string,LastEditorUserId:string,comments:array<{COMMENT}>>>, links array<struct<Id:bigint,Name:string>>"


def test_fingerprint(spark):
    import hashlib

    base = question()
    other = question(Tags=["a", "b"], comments=base["comments"][::-1], answers=base["answers"][::-1], links=base["links"][::-1])
    changed = [question(Title="x"), question(Score=4), question(ViewCount="6"), question(links=base["links"][:1])]
    got = [r[0] for r in spark.createDataFrame([base, other, *changed], SCHEMA).select(records.fingerprint()).collect()]
    assert got[0] == got[1] and len(set(got[1:])) == 5
    want = dict(base, Tags=["a", "b"], comments=base["comments"][::-1], answers=[dict(a, comments=[]) for a in base["answers"][::-1]], links=base["links"][::-1])
    text = json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert got[0] == hashlib.sha256(text.encode()).hexdigest()


def test_tags_shard_casts(spark):
    assert one(spark, records.split_tags(F.lit("<b><a>"))) == ["a", "b"] == one(spark, records.split_tags(F.lit("|b|a|")))
    assert one(spark, records.shard_of(F.lit(1 << 24))) == "01"
    assert [one(spark, records.lenient_int(F.lit(x))) for x in ("7", "", "x")] == [7, 0, 0]
    assert one(spark, records.tsv_escape(F.lit("a\tb\nc\rd"))) == "a%09b%0Ac%0Dd"
    assert [one(spark, records.within_tolerance(F.lit(e), F.lit(a), 0.02)) for e, a in ((0, 0), (0, 1), (100, 102), (100, 103))] == [True, False, True, False]


def test_manifest_rules(spark):
    rows = spark.createDataFrame([(1, "a", "u"), (2, "a", "v"), (3, "b", "u"), (4, "a", "u")], "seq int, hash string, url string")
    assert manifests.rejected(rows, ["hash", "url"]).first().asDict() == {"accepted": 3, "rejected": 1}
    best = spark.createDataFrame([(1, "h", ""), (2, "h", "s1"), (3, "h", "s2")], "seq int, hash string, sha string")
    assert manifests.best_per_hash(best, "hash", "sha", ["seq"]).first().sha == "s1"
    for n, want in ((3, [0, 3, 6]), (20, list(range(10))), (0, [])):
        assert sorted(r.id for r in ranking.even_sample(spark.range(10), ["id"], 10, n).collect()) == want


def test_decisions(spark):
    t, f = F.lit(True), F.lit(False)
    sync = lambda *a: tuple(one(spark, decisions.sync(*a)))
    sha = F.lit("S")
    assert sync(t, t, f, sha, F.lit("s"), t, t, f) == ("applied", "placeholder-target")
    assert sync(t, t, f, sha, F.lit("s"), t, f, t) == ("skipped", "already-real")
    assert sync(t, f, f, sha, F.lit("s"), f, f, f) == ("skipped", "missing-source")
    assert sync(t, t, f, sha, F.lit("x"), f, f, f) == ("skipped", "sha-mismatch")
    assert one(spark, decisions.upgrade(t, t, F.lit(100), F.lit(50), F.lit("x"))) == "no_improvement"


def test_prune(spark, tmp_path):
    m = spark.createDataFrame([(2, 1, "00/1"), (2, 2, "00/2"), (1, 3, "00/3"), (2, None, "00/4")], "schema_version int, post_id long, path string")
    plan = incremental.prune_plan(m, spark.createDataFrame([(1,)], "post_id long"))
    assert [r.post_id for r in plan.collect()] == [2]
    failed = spark.createDataFrame([(1,)], "x int")
    assert incremental.prune_plan(m, spark.createDataFrame([(1,)], "post_id long"), failed).count() == 0
    for i in (2, 5, 6):
        os.makedirs(tmp_path / "00" / str(i))
    os.symlink(tmp_path / "00" / "6", tmp_path / "00" / "7")
    rows = [(2, "00/2", None), (7, "00/7", None), (5, "00/5", None)]
    got = sinks.prune(spark.createDataFrame(rows, "post_id long, path string, problem string").coalesce(1), str(tmp_path), str(tmp_path / "j"), os.rmdir)
    assert got == {"removed": 1, "failed": 1, "kept": 1} and (tmp_path / "00" / "5").exists()
    assert [json.loads(x)["status"] for x in (tmp_path / "j.results.jsonl").read_text().splitlines()] == ["removed", "failed", "kept"]
    assert spark.read.json(str(tmp_path / "j.plan")).count() == 3


def test_baseline_rules(spark):
    rows = [("e", 49, "entries"), ("s", 9, "size"), ("p", 103, "pages"), ("i", 0, "images")]
    got = audit.compare(spark.createDataFrame(rows, "metric string, value long, rule string"), {"e": 100, "s": 1000, "p": 100, "i": 5})
    assert {r.metric: r.status for r in got.collect()} == {"e": "FAIL", "s": "FAIL", "p": "WARN", "i": "FAIL"}


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"x\xff\xfey\xc3")
    (tmp_path / "b.html").write_bytes("good \ufffd é".encode())
    assert sorted(r.html for r in readers.pages(spark, str(tmp_path)).collect()) == ["good \ufffd é", "xy"]


def test_lines_of_many_splits(spark, tmp_path):
    """Numbers start at 1 and grow along each file, whatever its splits; the header is the first line of the file."""
    (tmp_path / "a.tsv").write_text("hash\tn\n" + "".join(f"h{k}\t{k}\n" for k in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = readers.lines(spark, str(tmp_path / "a.tsv"))
        assert rows.rdd.getNumPartitions() > 1
        got = [r.line for r in rows.orderBy("line_no").collect()]
        assert got == (tmp_path / "a.tsv").read_text().splitlines() and rows.agg({"line_no": "min"}).first()[0] == 1
        good, bad = readers.tsv(spark, str(tmp_path / "a.tsv"))
        assert good.count() == 4000 and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        for k in range(600):
            z.writestr(f"d{k % 2}/{k // 2}.png", bytes([k % 251]))
    (tmp_path / "t.zip").write_bytes(b"no zip")
    members = readers.zip_members(spark, str(tmp_path / "*.zip"))
    got = members.collect()
    assert len(got) == 601 and [r.shard for r in got if r.error] == ["t.zip"]
    rows = spark.createDataFrame([("a", "s.zip", "7.png"), ("b", "s.zip", "x.png"), ("c", "t.zip", "1.png"), ("d", "u.zip", "1.png")], "hash string, shard string, basename string")
    out = {r.hash: (r.status, r.content) for r in recovery.shard_members(rows, readers.zip_members(spark, str(tmp_path / "*.zip"), rows)).collect()}
    assert out["a"] == ("ok", bytes([15])) and [out[k][0] for k in "bcd"] == ["missing_member", "error", "missing_zip"]


def test_published_versions(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    assert sinks.current(spark, root) is None
    for n in (1, 2):
        sinks.publish(spark.range(n), root)
        assert sinks.current(spark, root).count() == n
    sinks.append_results(spark.createDataFrame([("b", "ok")], "hash string, status string"), root)
    final = sinks.compact_results(spark, spark.createDataFrame([("b", "ok"), ("a", "fail")], "hash string, status string"), root)
    assert [r.hash for r in final.collect()] == ["a", "b"]
    assert sinks.summary_text(final, "status") == "         1  fail\n         1  ok"


def test_run_rules(spark):
    assert incremental.argument_problem(True, True, "2026-07") is None and incremental.argument_problem(False, False, None) is None
    assert all(incremental.argument_problem(*a) for a in ((False, True, None), (True, False, None), (True, False, "a b")))
    assert audit.new_artifact(["a"], ["a", "b"]) == "b"
    with pytest.raises(ValueError):
        audit.new_artifact(["a"], ["a"])
    kept = incremental.reset({"tags": spark.range(3), "done": spark.range(2)}, ("tags",))
    assert kept["tags"].count() == 0 and kept["done"].count() == 2
    none = archive.top_users(spark.createDataFrame([], "user_id long, name string, score long"), 3).collect()
    assert [r.name for r in none] == ["no users"]
    stored = spark.createDataFrame([(1, "", None, None), (2, "t", "o", 3)], "post_id long, title string, owner string, answers long")
    staged = spark.createDataFrame([(1, "from page", "p", 9), (3, "x", "q", None)], "post_id long, title string, owner string, answers long")
    got = incremental.details(spark.createDataFrame([(1,), (2,), (3,), (4,)], "post_id long"), stored, staged, {"title": "", "owner": "", "answers": 0}).orderBy("post_id").collect()
    assert [tuple(r)[1:] for r in got] == [("from page", "", 0), ("t", "o", 3), ("x", "q", 0), ("", "", 0)]


def test_readers(spark, tmp_path):
    head = "schema_version\thash\tsource_url\tsource_class\tstatus\tcontent_sha256\tderived_sha256\tmime\tbytes\ttimestamp\ttool_version\textra"
    (tmp_path / "m.tsv").write_text(head + "\n" + "\t".join(["1", "a", "u"] + [""] * 9) + "\n\nshort\trow\n")
    good, bad = readers.manifest_tsv(spark, str(tmp_path / "m.tsv"))
    assert good.count() == 1 and bad.count() == 1 and good.first().source_url == "u"
    (tmp_path / "bad.tsv").write_text("hash\nx\n")
    with pytest.raises(ValueError):
        readers.manifest_tsv(spark, str(tmp_path / "bad.tsv"))
    (tmp_path / "m.jsonl").write_text('{"hash": "a", "source_url": "u"}\nnot json\n[1]\n\n{}\n')
    good, bad = readers.manifest_jsonl(spark, str(tmp_path / "m.jsonl"))
    assert good.count() == 2 and bad.count() == 2
    (tmp_path / "w").write_text(f"# c\n{'a' * 16}\thttp://x/b.png?q\n{'A' * 16}\thttp://x\nzz\thttp://x\n")
    assert [r.basename for r in readers.worker_manifest(spark, str(tmp_path / "w")).collect()] == ["b.png"]
    (tmp_path / "p").write_text("hash\tsource_url\nH\tu1\nh\tu2\n")
    assert readers.pending(spark, str(tmp_path / "p")).collect()[0].asDict() == {"hash": "h", "source_url": "u2"}
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("d/a.png", b"x")
    assert [(r.shard, r.basename) for r in readers.zip_members(spark, str(tmp_path / "s.zip")).collect()] == [("s.zip", "a.png")]
    os.makedirs(tmp_path / "st" / "00" / "1")
    os.makedirs(tmp_path / "st" / "00" / "2")
    (tmp_path / "st" / "00" / "1" / "manifest.json").write_text('{"schema_version": 2, "post_id": 1}')
    assert sorted((r["name"], r.has_manifest) for r in readers.folders(spark, str(tmp_path / "st")).collect()) == [("1", True), ("2", False)]
    assert readers.stage_manifests(spark, f"{tmp_path}/st").first().post_id == 1
    (tmp_path / "z").write_bytes(struct.pack("<IHH", 7, 1, 2) + bytes(16) + struct.pack("<II", 55, 3) + bytes(48))
    assert readers.archive_header(str(tmp_path / "z"))["entry_count"] == 55
    (tmp_path / "x.xml").write_text('<posts><row Id="1" Title="a &amp; b"/><row Id="2"/></posts>')
    assert {r.Id: r.Title for r in readers.posts_xml(spark, str(tmp_path / "x.xml"), "Id string, Title string").collect()} == {"1": "a & b", "2": None}
    with pytest.raises(ValueError):
        readers.config(None, {"TL_NOPE": "1"}, "TL_", {"delay": 0.5})
    assert readers.config(None, {"TL_FETCH": "yes"}, "TL_", {"fetch": False, "delay": 0.5}, delay=2) == {"fetch": True, "delay": 2.0}


def test_sinks(spark, tmp_path):
    new = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "seq int, hash string")
    root = f"{tmp_path}/m"
    assert sinks.append_manifest(spark, root, new, ["hash"], ["seq"]).count() == 2
    assert sorted((r.seq, r["hash"]) for r in sinks.append_manifest(spark, root, spark.createDataFrame([(9, "a"), (8, "c")], "seq int, hash string"), ["hash"], ["seq"]).collect()) == [(1, "a"), (3, "b"), (8, "c")]
    assert sinks.placeholder_png() == sinks.placeholder_png() and sinks.placeholder_png().startswith(b"\x89PNG")
    sinks.write_tsv(spark.createDataFrame([("a\tb",)], "x string"), f"{tmp_path}/t", ["x"])
    assert "a%09b" in "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert sinks.json_lines(spark.createDataFrame([(1, None)], "b int, a string")).first().value == '{"a":null,"b":1}'


def test_stream_equals_batch(spark):
    from threadloom.streaming import scan

    names = spark.createDataFrame([("abc",), ("abcd.png",), ("abc",)], "name string")
    a = {tuple(r) for r in scan.names_to_matches(spark, names, list("0123456789abcdef")).select("name", "url").collect()}
    b = {tuple(r) for r in scan.matches(names, list("0123456789abcdef")).select("name", "url").collect()}
    assert a == b and len(a) == 9


def test_redirects_are_a_list_by_their_type(spark):
    rows = [("a", '{"answer_redirects":[]}'), ("b", '{"answer_redirects":"[1]"}'), ("c", '{"answer_redirects":null}'), ("d", "[]"), ("e", None), ("f", '{"answer_redirects":[{"x":1},"y"]}'), ("g", '{"answer_redirects":{"0":1}}')]
    r = audit.answer_redirects(spark.createDataFrame(rows, "path string, json string")).first()
    assert (r.status, r.n) == ("FAIL", 5)

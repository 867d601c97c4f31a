"""Packed archives: splits, filters by bisection, compressions, damage."""

import random

import pytest

from threadloom.sources import packed as m


def fixture(n, seed=1):
    r = random.Random(seed)
    rows = [{"namespace": "C", "path": f"questions/{i}/s{'é' * (i % 3)}", "title": f"Title {i}" if i % 4 else f"questions/{i}/s{'é' * (i % 3)}", "mime": r.choice(["text/html", "image/png"]), "content": r.randbytes(r.randrange(400)), "target": None} for i in range(n)]
    rows += [{"namespace": "C", "path": f"a/{i}", "title": f"a/{i}", "mime": None, "content": None, "target": rows[i]["path"]} for i in range(0, n, 3)]
    rows += [{"namespace": "M", "path": "Title", "title": "Title", "mime": "text/plain", "content": b"name", "target": None}, {"namespace": "X", "path": "long/" + "p" * 3000, "title": "t" * 2000, "mime": "text/plain", "content": b"", "target": None}]
    return rows


def written(tmp, rows, **options):
    (tmp / "one.bin").write_bytes(m.packed(rows, **options))
    return f"file://{tmp}/one.bin"


@pytest.mark.parametrize("compression", [1, m.XZ, m.ZSTD])
def test_entries_in_splits(spark, tmp_path, compression):
    rows = fixture(500)
    uri = written(tmp_path, rows, cluster_bytes=5000, compression=compression)
    listing = m.entries(spark, uri, content=True, split_entries=37)
    assert listing.rdd.getNumPartitions() == -(-len(rows) // 37)
    got = m.with_targets(listing).collect()
    assert [(r.namespace, r.path) for r in sorted(got, key=lambda r: r.pos)] == sorted(((r["namespace"], r["path"]) for r in rows), key=lambda x: (x[0], x[1].encode()))
    want = {(r["namespace"], r["path"]): r for r in rows}
    assert max(r.cluster or 0 for r in got) > 10
    for r in got:
        w = want[r.namespace, r.path]
        assert (r.title, r.mime, None if r.content is None else bytes(r.content), r.target, r.error) == (w["title"], w["mime"], w["content"], w["target"], None)


def test_what_is_asked_for_is_found_by_bisection(spark, tmp_path):
    rows = fixture(3000)
    uri = written(tmp_path, rows)
    paths = [r["path"] for r in rows]
    cases = [
        ({"paths": ["a/9"]}, lambda p: p == "a/9"), ({"paths": ["a/10"]}, lambda p: False), ({"prefixes": ["questions/12"]}, lambda p: p.startswith("questions/12")),
        ({"paths": ["a/3", "Title", "nowhere", "a/3"]}, lambda p: p in ("a/3", "Title")), ({"namespaces": ["M"]}, lambda p: p == "Title"), ({"namespaces": ["X"], "prefixes": ["long/"]}, lambda p: p.startswith("long/")),
        ({"namespaces": ["M"], "prefixes": ["long/"]}, lambda p: False), ({"prefixes": ["a/1", "a/12"], "paths": ["a/12"]}, lambda p: p.startswith("a/1")), ({"paths": []}, lambda p: False),
    ]
    for asked, keep in cases:
        some = m.entries(spark, uri, split_entries=10, **asked)
        assert sorted(r.path for r in some.collect()) == sorted(filter(keep, paths)), asked
        assert some.rdd.getNumPartitions() <= 60, asked  # of more than 400
    both = m.entries(spark, uri, paths=["a/9"]).unionByName(m.entries(spark, uri, paths=["a/3"]))
    assert sorted(r.path for r in both.collect()) == ["a/3", "a/9"]


def test_what_is_no_archive(spark, tmp_path):
    good = m.packed(fixture(20))
    (tmp_path / "a.bin").write_bytes(good)
    (tmp_path / "b.bin").write_bytes(b"\0" * 100)
    (tmp_path / "c.bin").write_bytes(good[:50])
    (tmp_path / "d.bin").write_bytes(good[:90])
    (tmp_path / "e.bin").write_bytes(m.packed([]))
    got = m.entries(spark, f"file://{tmp_path}").collect()
    assert {r.archive: r.error for r in got if r.path is None} == {"b.bin": "not a packed archive", "c.bin": "not a packed archive", "d.bin": "the archive ends before its lists of pointers"}
    assert sum(r.archive == "a.bin" for r in got) == len(fixture(20)) and not any(r.archive == "e.bin" for r in got)
    assert [r.archive for r in m.entries(spark, f"file://{tmp_path}", paths=["a/3"]).collect()] == ["a.bin"]


def test_damaged_cluster_is_that_entry_s_error(spark, tmp_path):
    rows = [{"namespace": "C", "path": f"p{i}", "title": "t", "mime": "text/html", "content": b"x" * 50, "target": None} for i in range(40)]
    data = bytearray(m.packed(rows, cluster_bytes=500, compression=1))
    head = m.head(bytes(data))
    import struct

    second = struct.unpack_from("<Q", data, head["clusters"] + 8)[0]
    data[second] = 9
    (tmp_path / "one.bin").write_bytes(bytes(data))
    got = m.entries(spark, f"file://{tmp_path}/one.bin", content=True).collect()
    assert {r.error for r in got if r.cluster == 1} == {"cluster 1: unknown compression 9"} and all(r.error is None and bytes(r.content) == b"x" * 50 for r in got if r.cluster != 1)

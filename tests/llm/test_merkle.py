"""Manifests against brute force and the SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from threadloom.llm import merkle as m

DOCS = "doc_id long, source string, lang string, n_chars long, text string, _tree string, _hash string, leaf string"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, change=0):
    doc, source, lang, n, text = r
    values = [doc, source, lang, n if n is None else n + change, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, arity):
    """The root, and for each node the levels' siblings and the fold of another digest in its place."""
    paths = {i: [] for i in range(len(nodes))}
    level, at = list(nodes), {i: i for i in paths}
    while len(level) > 1:
        for i, k in at.items():
            run = level[k // arity * arity : k // arity * arity + arity]
            paths[i].append((run, k % arity))
            at[i] = k // arity
        level = [h("".join(level[k : k + arity])) for k in range(0, len(level), arity)]
    return level[0], paths


def brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]], arity)
    root, tops = climb([trees[g][0] for g in order], arity) if order else ("", {})
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            digest, proof = leaf(r, tampered), ""
            for run, slot in trees[g][1][i] + tops[k]:
                proof += "".join(run[:slot] + run[slot + 1 :])
                digest = h("".join(run[:slot] + [digest] + run[slot + 1 :]))
            out.append((r[0], leaf(r), trees[g][0], root, h(proof), digest, digest == root))
    return sorted(out, key=str)


def proved(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claim = F.when(hit, m.leaf_of([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in m.FIELDS]))
    proofs = m.manifest(df, claim=claim, **options)[2]
    return sorted((tuple(r) + (r._folded == r._root,) for r in proofs.collect()), key=str)


def corpus(n, seed):
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "é…" * r.randrange(5), "x" * r.randrange(40), "L" * 3000])
    rows = [(i, r.choice(["a", None, "b"]), r.choice(["en", "en", "en", "en", "é", None, ""]), r.choice([None, 5, -1, 0]), text()) for i in r.sample(range(10**6), n)]
    return rows + [rows[0]] * 3 + [(rows[1][0], "other", rows[1][2], 1, "tie")] * 2 + [(None, None, "en", None, None), (None, "x", None, 3, "y")] + [(77, "s", "alone", 1, "t")]


@pytest.mark.parametrize("arity, block", [(2, 4096), (2, 4), (3, 9), (5, 5)])
def test_proofs(spark, arity, block):
    rows = corpus(150, arity)
    got = proved(spark, rows, arity=arity, block=block)
    assert got == brute(rows, arity) and not all(r[-1] for r in got)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 1, "t")], [(1, "a", None, 1, None), (2, "a", "", 1, "t")], [(i, "a", "en", i, "t") for i in range(5)]])
def test_small_tables(spark, rows):
    assert proved(spark, rows, block=2) == brute(rows)


def test_query_and_sql(spark, tmp_path):
    rows = corpus(200, 9)
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, m.op12_merkle_manifest(spark, str(tmp_path)).select(*NAMES).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == brute(rows) == sorted(con.execute(m.sql()).fetchall(), key=str)


def test_stored_preimages_make_the_roots(spark):
    rows = corpus(60, 4)
    groups, over, _ = m.manifest(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS), block=8)
    parents = groups.parents().collect()
    assert all(h(p._preimage) == p._hash and len(p._preimage) in (64, 128) for p in parents)
    made = {p._hash for p in parents} | {leaf(r) for r in rows}
    assert all(p._preimage[k : k + 64] in made for p in parents for k in range(0, len(p._preimage), 64))
    assert {r._hash for r in over.roots().collect()} == {brute(rows)[0][3]}


def test_slots():
    a, b, c = h("a"), h("b"), h("c")
    assert m.siblings(1, a + b + c) == a + c and m.siblings(0, a) == "" and m.spliced(1, a + b + c, c) == a + c + c
    with pytest.raises(ValueError):
        m.levels(1, 10)

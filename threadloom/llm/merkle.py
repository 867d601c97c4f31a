"""A Merkle manifest of a table: a tree of hashes for each group of rows, and a tree over the groups' roots.

What is stored are parents' preimages: for each parent the concatenated hex digests of its children, at most ``arity`` of them, whose
hash the parent is. A leaf's proof needs nothing else: it joins its ancestors' preimages, and at each level its own slot of 64
characters, cut out, leaves the siblings, while a replacement spliced in gives the preimage of the parent that follows from it.

Trees are built in bands of BAND levels. A block is the subtree of a band's height over a run of consecutive nodes, so whatever
a task holds is bounded by a block, and a group that has a third of all rows is as many blocks. Blocks' tops are the nodes of the
next band: four bands are enough for some 10 ** 14 rows. Proofs come down the same way: a band's nodes meet, by block, the block's
preimages and the one chain of preimages above its top. Texts are hashed where they are read and never shuffled; every band is
written to the shared folder.

Defined results: a null is ``-`` in a leaf's preimage; a null group comes first and is a group of its own, other than the empty one; rows
of one key are ordered by their leaves, repeated rows are so many leaves; a null key comes first and is never tampered with; texts of
any length are hashed in whole; a group of one leaf has that leaf as its root, and a lone group's root is the manifest's; an empty
table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import guarded, importable, table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a parent; levels of a band (so many that a block has at most 4,096 nodes).
ARITY, BLOCK = 2, 4096
#: Characters of a digest, the width of a slot.
SLOT = 64
#: A row in so many is tampered with, by the checksum of its key.
TAMPERED = 7
NODE = "_tree string, _level int, _i bigint, _n bigint, _hash string, _preimage string"
CHAIN = "_tree string, _i bigint, _slots array<int>, _preimages array<string>, _subroot string, _root string"


def field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    """The hash of a row: each value as ``-`` or its bytes' number, a colon and itself."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(arity: int, block: int) -> int:
    """Levels of a band."""
    if arity < 2 or block < arity:
        raise ValueError("a parent has two children or more, and a block at least one parent")
    n, k = 1, 0
    while n * arity <= block:
        n, k = n * arity, k + 1
    return k


# --- places --------------------------------------------------------------------------------------------------------------


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``_i``, a row's place from 0 within its ``_tree``, and ``_n``, the tree's rows. Places are those in a range partition plus the sizes of
    what the partitions before have of the tree; rows are written in between, as a second run could draw other bounds."""
    ranged = df.repartitionByRange("_tree", *order).sortWithinPartitions("_tree", *order)
    placed = written(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)
    spans = placed.groupBy("_tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    w = Window.partitionBy("_tree")
    before = F.sum("_size").over(w.orderBy("_part")) - F.col("_size") - F.col("_first")
    spans = written(spans.select("_tree", "_part", before.alias("_shift"), F.sum("_size").over(w).alias("_n")), f"{name}-spans")
    return placed.join(guarded(spans, 400_000), ["_tree", "_part"]).withColumn("_i", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


# --- building ------------------------------------------------------------------------------------------------------------


def block_parents(block: pa.Table, arity: int, band: int, level: int) -> pa.Table:
    """The parents of a block's nodes, up to its top or the tree's root, and that top, as a row without preimage."""
    block = block.sort_by("_i")
    tree, i, n, digests = block["_tree"][0].as_py(), block["_i"][0].as_py(), block["_n"][0].as_py(), block["_hash"].to_pylist()
    rows = []
    for level in range(level, level + band):
        if n == 1:
            break
        i, n = i // arity, -(-n // arity)
        preimages = ["".join(digests[k : k + arity]) for k in range(0, len(digests), arity)]
        digests = list(map(hashed, preimages))
        rows += [(tree, level + 1, i + k, n, h, p) for k, (h, p) in enumerate(zip(digests, preimages))]
    top = rows[-1] if rows else (tree, level, i, n, digests[0], None)
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, (*top[:5], None)), NODES)], NODES_NAMES)


NODES, NODES_NAMES = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()], [c.split()[0] for c in NODE.split(", ")]


class Tree(NamedTuple):
    """``bands``: for each, its nodes (_tree, _i, _n, _hash) and the written rows of NODE: parents with their preimages, and blocks' tops
    without."""

    bands: list[tuple[DataFrame, DataFrame]]
    arity: int
    band: int

    def parents(self) -> DataFrame:
        """The manifest: ``_tree, _level, _i, _hash, _preimage`` of all parents."""
        out = [made.where("_preimage is not null").drop("_n") for _, made in self.bands]
        for more in out[1:]:
            out[0] = out[0].union(more)
        return out[0]

    def roots(self) -> DataFrame:
        """``_tree, _hash``."""
        out = [made.where("_preimage is null and _n = 1").select("_tree", "_hash") for _, made in self.bands]
        for more in out[1:]:
            out[0] = out[0].union(more)
        return out[0]


def in_blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("_block", F.expr(f"_i div {size}"))


def build(nodes: DataFrame, name: str, arity: int = ARITY, block: int = BLOCK) -> Tree:
    """The trees over ``nodes``: _tree, _i, _n, _hash, a written table."""
    band, bands = levels(arity, block), []
    while True:
        level = len(bands) * band
        made = written(in_blocks(nodes, arity**band).groupBy("_tree", "_block").applyInArrow(lambda t: block_parents(t, arity, band, level), NODE), f"{name}-band")
        bands.append((nodes, made))
        nodes = made.where("_preimage is null and _n > 1").select("_tree", "_i", "_n", "_hash")
        if nodes.isEmpty():
            return Tree(bands, arity, band)


# --- proving -------------------------------------------------------------------------------------------------------------


def ancestors(i: int, level: int, arity: int, preimages: dict) -> list[tuple[int, str]]:
    """A node's slots and preimages, from its parent to the block's top."""
    out = []
    while (p := preimages.get((level + 1, i // arity))) is not None:
        out.append((i % arity, p))
        i, level = i // arity, level + 1
    return out


def siblings(slot: int, preimage: str) -> str:
    return preimage[: slot * SLOT] + preimage[(slot + 1) * SLOT :]


def spliced(slot: int, preimage: str, digest: str) -> str:
    return preimage[: slot * SLOT] + digest + preimage[(slot + 1) * SLOT :]


def folded(digest: str, chain: list[tuple[int, str]]) -> str:
    """The root that follows if a leaf were ``digest`` and its siblings what they are."""
    for slot, preimage in chain:
        digest = hashed(spliced(slot, preimage, digest))
    return digest


def opened(above: pa.Table) -> tuple[dict, list[tuple[int, str]], str, str]:
    """A block's preimages by level and place, the chain above its top, its tree's root and the root of all."""
    preimages, chain, subroot, root = {}, [], None, None
    for r in above.to_pylist():
        if r["_preimage"] is not None:
            preimages[r["_level"], r["_i"]] = r["_preimage"]
        else:
            chain, subroot, root = list(zip(r["_slots"], r["_preimages"])), r["_subroot"], r["_root"]
    return preimages, chain, subroot, root


def block_chains(nodes: pa.Table, above: pa.Table, arity: int, level: int) -> pa.Table:
    """The chain of each of a block's nodes."""
    preimages, chain, subroot, root = opened(above)
    out = []
    for tree, i in zip(nodes["_tree"].to_pylist(), nodes["_i"].to_pylist()):
        whole = ancestors(i, level, arity, preimages) + chain
        out.append((tree, i, [s for s, _ in whole], [p for _, p in whole], subroot, root))
    types = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string(), pa.string()]
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], [c.split()[0] for c in CHAIN.split(", ")])


def block_proofs(leaves: pa.Table, above: pa.Table, arity: int) -> pa.Table:
    """Proofs and folded roots of a block's leaves. ``_claim`` takes the place of a leaf's own hash where it isn't null."""
    preimages, chain, subroot, root = opened(above)
    proofs, folds = [], []
    for i, leaf, claim in zip(leaves["_i"].to_pylist(), leaves["_hash"].to_pylist(), leaves["_claim"].to_pylist()):
        whole = ancestors(i, 0, arity, preimages) + chain
        proofs.append(hashed("".join(siblings(*x) for x in whole)))
        folds.append(folded(leaf if claim is None else claim, whole))
    n = len(proofs)
    out = leaves.select(["_id", "_hash"])
    for name, values in [("_subroot", [subroot] * n), ("_root", [root] * n), ("_proof", proofs), ("_folded", folds)]:
        out = out.append_column(name, pa.array(values, pa.string()))
    return out


def chained(tree: Tree, tops: DataFrame, last: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Brings chains down from band to band: ``tops`` has those of the roots (CHAIN, by _tree). The lowest band's nodes go, with what stands above
    them, to ``last``."""
    size, from_above = tree.arity**tree.band, None
    for j in reversed(range(len(tree.bands))):
        nodes, made = tree.bands[j]
        roots = made.where("_preimage is null and _n = 1").select("_tree", "_i").join(tops.drop("_i"), "_tree")
        upper = roots.select(*[c.split()[0] for c in CHAIN.split(", ")])
        upper = upper if from_above is None else upper.unionByName(from_above)
        # a top's place is in units of blocks, as is that of a root (0)
        upper = upper.withColumn("_block", F.col("_i"))
        parents = made.where("_preimage is not null").withColumn("_block", F.expr(f"_i div cast(pow({tree.arity}, {(j + 1) * tree.band} - _level) as bigint)"))
        above = parents.select("_tree", "_block", "_level", "_i", "_preimage").unionByName(upper, allowMissingColumns=True)
        pair = in_blocks(nodes, size).groupBy("_tree", "_block").cogroup(above.groupBy("_tree", "_block"))
        if j == 0:
            return pair.applyInArrow(last, schema)
        arity, level = tree.arity, j * tree.band  # written at once, so the function sees this band's
        from_above = written(pair.applyInArrow(lambda n, a: block_chains(n, a, arity, level), CHAIN), "chains")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", claim: Column | None = None, arity: int = ARITY, block: int = BLOCK) -> tuple[Tree, Tree, DataFrame]:
    """The trees of the groups, the tree over their roots, and a row for each leaf: ``_id, _hash`` (the leaf), ``_subroot, _root, _proof`` (the hash
    of its siblings from below), ``_folded`` (the root that follows from ``claim``, a leaf's hash said to be the row's; null: its own)."""
    importable(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # a null before all others, and no other
    claim = F.lit(None).cast("string") if claim is None else claim
    leaves = written(docs.select(tree.alias("_tree"), F.col(key).alias("_id"), leaf_of([F.col(c) for c in fields]).alias("_hash"), claim.alias("_claim")), "leaves")
    leaves = written(numbered(leaves, ["_id", "_hash"], "ordered"), "numbered")
    groups = build(leaves, "groups", arity, block)
    subroots = written(numbered(groups.roots().select(F.lit("").alias("_tree"), F.col("_tree").alias("_group"), "_hash"), ["_group"], "subroots"), "groups-numbered")
    over = build(subroots, "roots", arity, block)
    root = over.roots().select("_tree", F.lit(0).cast("bigint").alias("_i"), F.expr("cast(array() as array<int>)").alias("_slots"), F.expr("cast(array() as array<string>)").alias("_preimages"), F.lit(None).cast("string").alias("_subroot"), F.col("_hash").alias("_root"))

    def group_chains(nodes: pa.Table, above: pa.Table) -> pa.Table:
        """As ``block_chains``, by the groups' own names and with their roots."""
        out = block_chains(nodes, above, arity, 0)
        return out.set_column(0, "_tree", nodes["_group"]).set_column(4, "_subroot", nodes["_hash"])

    tops = written(chained(over, root, group_chains, CHAIN), "tops")
    kind = leaves.schema["_id"].dataType.simpleString()
    proofs = chained(groups, tops, lambda n, a: block_proofs(n, a, arity), f"_id {kind}, _hash string, _subroot string, _root string, _proof string, _folded string")
    return groups, over, proofs


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = leaf_of([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    _, _, proofs = manifest(docs, claim=F.when(hit, changed))
    return proofs.select(F.col("_id").alias("doc_id"), F.col("_hash").alias("leaf"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_proof").alias("proof_sha256"), F.col("_folded").alias("folded_root"), (F.col("_folded") == F.col("_root")).alias("verified"))


def sql() -> str:
    """The same over a table ``documents``, level by level; the checksum bit by bit."""
    parts = lambda changed: " || ".join(f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in [f"({f} + 1)" if changed and f == "n_chars" else f for f in FIELDS])
    return f"""
with recursive base as (
  select doc_id, coalesce('=' || lang, '') g, sha256({parts(False)}) leaf, sha256({parts(True)}) changed,
    xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(cast(doc_id as varchar)) + 1), lambda i: [ascii(substr(cast(doc_id as varchar), i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: case when xor(a, b) & 1 = 1 then xor(xor(a, b) >> 1, 3988292384) else xor(a, b) >> 1 end), 4294967295) % {TAMPERED} = 0 and doc_id is not null hit
  from documents
), leaves as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by g) n from base
), tree as (
  select g, 0 lvl, i, n, leaf h from leaves
  union all
  select g, min(lvl) + 1, i // 2, (min(n) + 1) // 2, sha256(string_agg(h, '' order by i)) from tree where n > 1 group by g, i // 2
), subroots as (
  select g, h, row_number() over (order by encode(g)) - 1 i, count(*) over () n from tree where n = 1
), top as (
  select 0 lvl, i, n, h from subroots
  union all
  select min(lvl) + 1, i // 2, (min(n) + 1) // 2, sha256(string_agg(h, '' order by i)) from top where n > 1 group by i // 2
), path as (
  select l.g, l.i, t.lvl step, ((l.i >> t.lvl) & 1) || coalesce(x.h, '') x
  from leaves l join (select distinct g, lvl from tree where n > 1) t on t.g = l.g left join tree x on x.g = l.g and x.lvl = t.lvl and x.i = xor(l.i >> t.lvl, 1)
  union all
  select l.g, l.i, 1000 + t.lvl, ((s.i >> t.lvl) & 1) || coalesce(x.h, '')
  from leaves l join subroots s on s.g = l.g cross join (select distinct lvl from top where n > 1) t left join top x on x.lvl = t.lvl and x.i = xor(s.i >> t.lvl, 1)
), paths as (
  select l.g, l.i, any_value(case when hit then changed else leaf end) claim, coalesce(list(x order by step) filter (x is not null), []) xs
  from leaves l left join path p on p.g = l.g and p.i = l.i group by l.g, l.i
), ends as (
  select g, i, sha256(array_to_string(list_transform(xs, lambda a: a[2:]), '')) proof,
    list_reduce(list_prepend(claim, xs), lambda a, b: sha256(case when b[1] = '0' then a || b[2:] else b[2:] || a end)) folded
  from paths
)
select l.doc_id, l.leaf, s.h subroot, r.h root, e.proof proof_sha256, e.folded folded_root, e.folded = r.h verified
from leaves l join subroots s on s.g = l.g join ends e on e.g = l.g and e.i = l.i cross join (select h from top where n = 1) r
"""

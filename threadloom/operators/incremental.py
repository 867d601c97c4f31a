"""Incremental updates: what to render, skip and prune between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records
from . import decisions


def diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """``current``: (post_id, digest); ``previous``: (post_id, digest). ``post_id, change``: unchanged, changed, new or removed, by
    one full join on the key."""
    c, p = current.select("post_id", F.col("digest").alias("_c")), previous.select("post_id", F.col("digest").alias("_p"))
    change = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "removed").when(F.col("_c") == F.col("_p"), "unchanged").otherwise("changed")
    return c.join(p, "post_id", "full").select("post_id", change.alias("change"))


def plan_render(questions: DataFrame, manifests: DataFrame, contract: str = records.CONTRACT) -> DataFrame:
    """``questions``: (post_id, digest); ``manifests``: (post_id, schema_version, render_contract_version, source_sha256, html_exists)."""
    j = questions.join(manifests, "post_id", "left")
    return j.select("post_id", decisions.render(F.col("schema_version"), F.col("render_contract_version"), F.col("source_sha256"), F.col("digest"), F.coalesce("html_exists", F.lit(False)), contract).alias("action"))


def prune_plan(manifests: DataFrame, seen: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """``post_id, path`` in the order of paths: pages of schema 2 whose post no longer exists. Nothing if the pass had failures."""
    m = manifests.where((F.col("schema_version") == 2) & F.col("post_id").isNotNull())
    gone = m.join(seen.select("post_id").distinct(), "post_id", "left_anti").select("post_id", "path")
    if failures is not None:
        clean = failures.agg(F.count(F.lit(1)).alias("_f")).where("_f = 0").select(F.lit(1).alias("_ok"))
        gone = gone.join(F.broadcast(clean)).drop("_ok")  # one row or none
    return gone.orderBy("path")


def prune_problem(plan: DataFrame) -> DataFrame:
    """Adds ``problem``: a path that isn't the canonical one of its id; null where it is."""
    name, shard = F.element_at(F.split("path", "/"), -1), F.element_at(F.split("path", "/"), -2)
    number = name.try_cast("bigint")
    return plan.withColumn("problem", F.when(number.isNull(), "not-numeric").when(number != F.col("post_id"), "id-mismatch").when(shard != records.shard_of(number), "wrong-shard"))


def resume(questions: DataFrame, done: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``action``: skip where the id is done and its page exists; else render."""
    d = done.select("post_id").distinct().withColumn("_d", F.lit(True))
    p = pages.select("post_id").distinct().withColumn("_p", F.lit(True))
    return questions.join(d, "post_id", "left").join(p, "post_id", "left").withColumn("action", F.when(F.col("_d") & F.col("_p"), "skip").otherwise("render")).drop("_d", "_p")


def eligible(questions: DataFrame, without_unanswered: bool) -> DataFrame:
    """Questions to render: not deleted, and answered if asked for."""
    out = questions.where("not coalesce(deleted, false)")
    return out.where(F.size("answers") > 0) if without_unanswered else out


def nest(parent: DataFrame, child: DataFrame, key: str, name: str, order: list[str], descending: bool = False) -> DataFrame:
    """Children as an array of structs in a total order; an empty array for parents without any."""
    rest = [c for c in child.columns if c != key and c not in order]
    lists = child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *rest)), not descending).alias(name))
    return parent.join(lists, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(lists.schema[name].dataType)))


def details(questions: DataFrame, stored: DataFrame, staged: DataFrame, fields: dict[str, object], texts: tuple[str, ...] = ("title", "excerpt")) -> DataFrame:
    """Fields of each question. Stored details count as a whole where there are any, a missing field having its default; without
    them the staged page's count. ``texts`` fall back on the staged page where they are empty, too."""
    s = stored.select("post_id", F.lit(True).alias("_has"), *[F.col(f).alias(f"_a_{f}") for f in fields])
    t = staged.select("post_id", *[F.col(f).alias(f"_b_{f}") for f in fields])
    j = questions.select("post_id").join(s, "post_id", "left").join(t, "post_id", "left")

    def one(f: str, default: object):
        own = F.nullif(f"_a_{f}", F.lit("")) if f in texts else F.col(f"_a_{f}")
        other = F.col(f"_b_{f}") if f in texts else F.when(F.col("_has").isNull(), F.col(f"_b_{f}"))
        return F.coalesce(own, other, F.lit(default)).alias(f)

    return j.select("post_id", *[one(f, d) for f, d in fields.items()])


def tag_names(questions: DataFrame, tags: DataFrame) -> DataFrame:
    """``questions``: (post_id, tags) with ids of tags; ``tags``: (tag_id, name). The names in the ids' order; unknown ids are left out."""
    each = questions.select("post_id", F.posexplode_outer("tags").alias("_pos", "tag_id")).join(tags, "tag_id", "left")
    names = each.groupBy("post_id").agg(F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("_pos", "name")))).alias("_n"))
    return names.select("post_id", F.transform("_n", lambda x: x["name"]).alias("tags"))


def begin_seen(seen: DataFrame, snapshot_id: str) -> DataFrame:
    """``seen``: (snapshot_id, post_id). What is left when a pass over a snapshot begins: its own marks go, others stay."""
    return seen.where(F.col("snapshot_id") != snapshot_id)


def mark_seen(seen: DataFrame, snapshot_id: str, posts: DataFrame) -> DataFrame:
    """Marks of a set: a post counts once however often it is marked."""
    return seen.unionByName(posts.select(F.lit(snapshot_id).alias("snapshot_id"), "post_id")).distinct()


def members_seen(seen: DataFrame, snapshot_id: str) -> DataFrame:
    return seen.where(F.col("snapshot_id") == snapshot_id).select("post_id").distinct()


def after_resume(done: DataFrame, plan: DataFrame) -> DataFrame:
    """The done set without what ``resume`` renders anew."""
    return done.join(plan.where("action = 'render'").select("post_id"), "post_id", "left_anti")


def reset(tables: dict[str, DataFrame], derived: tuple[str, ...]) -> dict[str, DataFrame]:
    """Tables before metadata passes: derived ones are emptied, all others stay."""
    return {k: v.where("false") if k in derived else v for k, v in tables.items()}


def argument_problem(incremental: bool, prune: bool, snapshot_id: str | None) -> str | None:
    """Why arguments of a run don't go together; null if they do."""
    import re

    if prune and not incremental:
        return "pruning needs an incremental run"
    if incremental and not snapshot_id:
        return "an incremental run needs a snapshot id"
    if snapshot_id and not re.fullmatch("[A-Za-z0-9._-]+", snapshot_id):
        return "a snapshot id has letters, digits, dots, dashes and underscores"
    return None

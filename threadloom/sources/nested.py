"""Questions from a dump of nested ``<post>`` elements: comments, answers with their own comments, and links.

A dump is read as text whose records end with ``</post>``, so files of any size are read in splits (Spark's XML source gives a file that isn't
one record per line to a single task). Each element is then parsed into one nested row, and nothing has to be joined afterwards. The schema is
given: attributes are text, as in the dump, and an element that comes once is an array like one that comes often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records

COMMENT = ("Id", "PostId", "UserId", "Score", "Text", "CreationDate", "ContentLicense")
ANSWER = ("Id", "Score", "Body", "OwnerUserId", "OwnerDisplayName", "CreationDate", "LastEditDate", "LastEditorUserId")
QUESTION = ("Id", "Title", "Body", "Score", "Tags", "OwnerUserId", "OwnerDisplayName", "CreationDate", "LastActivityDate", "ViewCount", "LastEditDate", "LastEditorUserId", "AcceptedAnswerId", "DeletionDate")
LINK = ("Id", "LinkTypeId", "Name")
#: A post without anything inside, which has no end of its own.
BARE = """<post(?:\\s+[\\w:.-]+\\s*=\\s*(?:"[^"]*"|'[^']*'))*\\s*/>"""
#: Marks attributes, which could otherwise clash with elements of the same name.
MARK = "_"
#: What a link's type means (fixed values of the dumps).
LINKED, DUPLICATE = "1", "3"


def _attributes(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{MARK}{n}` string" for n in names)


def schema() -> str:
    comments = f"comments struct<comment array<struct<{_attributes(COMMENT)}>>>"
    answers = f"answers struct<answer array<struct<{_attributes(ANSWER)}, {comments}>>>"
    links = f"links struct<link array<struct<{_attributes(LINK)}>>>"
    return f"{_attributes(QUESTION)}, {comments}, {answers}, {links}, _corrupt_record string"


def _plain(x: Column, names: tuple[str, ...]) -> list[Column]:
    """Attributes by their own names; Id and Score as numbers, 0 where they are none."""
    return [(records.lenient_int(x[f"{MARK}{n}"]) if n in ("Id", "Score") else x[f"{MARK}{n}"]).alias(n) for n in names]


def _list(c: Column, kind: str) -> Column:
    """An array, empty where the element is missing or empty."""
    return F.coalesce(c, F.array().cast(kind))


def _comments(parent: Column) -> Column:
    kind = f"array<struct<{_attributes(COMMENT)}>>"
    return F.transform(_list(parent["comments"]["comment"], kind), lambda c: F.struct(*_plain(c, COMMENT)))


def _answers(post: Column) -> Column:
    """By score, highest first, in the dump's order where equal."""
    kind = f"array<struct<{_attributes(ANSWER)}, comments struct<comment array<struct<{_attributes(COMMENT)}>>>>>"
    placed = F.transform(_list(post["answers"]["answer"], kind), lambda a, i: F.struct(-records.lenient_int(a[f"{MARK}Score"]), i, F.struct(*_plain(a, ANSWER), _comments(a).alias("comments")).alias("x")))
    return F.transform(F.sort_array(placed), lambda p: p["x"])


def _links(post: Column, kind: str) -> Column:
    every = _list(post["links"]["link"], f"array<struct<{_attributes(LINK)}>>")
    some = F.filter(every, lambda k: k[f"{MARK}LinkTypeId"] == kind)
    return F.transform(some, lambda k: F.struct(records.lenient_int(k[f"{MARK}Id"]).alias("Id"), k[f"{MARK}Name"].alias("Name")))


def questions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Questions (QUESTION, ``Tags`` as a sorted array, ``comments``, ``answers``, ``links`` as linked and duplicate, ``nb_answers``, ``deleted``), and the text
    of elements that can't be read. Dumps may have any number of files; elements may span lines."""
    # Columns are made once each: an outer explode has no filter that the optimizer would write the array out for a second time, and the id
    # keeps the one on parsed elements where it is. Most records are a single element with an end of its own.
    value = F.col("value")
    bare = F.when(value.rlike(BARE), F.struct(F.regexp_extract_all(value, F.lit(BARE), F.lit(0)).alias("x"), F.regexp_replace(value, BARE, "").alias("t")))
    record = spark.read.text(path, lineSep="</post>").select(F.coalesce(bare, F.struct(F.array().cast("array<string>").alias("x"), value.alias("t"))).alias("_b"))
    record = record.withColumn("_b", F.explode_outer(F.array("_b"))).withColumn("_at", F.locate("<post", F.col("_b.t")))
    whole = F.when(F.col("_at") > 0, F.array(F.concat(F.expr("substr(_b.t, _at)"), F.lit("</post>")))).otherwise(F.array().cast("array<string>"))
    element = record.select(F.explode_outer(F.concat("_b.x", whole)).alias("_x"))
    parsed = F.from_xml("_x", schema(), {"attributePrefix": MARK, "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    raw = element.select("_x", F.explode_outer(F.array(parsed)).alias("_p")).where("_x is not null")
    p = F.col("_p")
    good = raw.where("_p._corrupt_record is null")
    names = [n for n in QUESTION if n != "Tags"]
    out = good.select(*_plain(p, tuple(names)), records.split_tags(F.coalesce(p[f"{MARK}Tags"], F.lit(""))).alias("Tags"), _comments(p).alias("comments"), _answers(p).alias("answers"), F.struct(_links(p, LINKED).alias("linked"), _links(p, DUPLICATE).alias("duplicate")).alias("links"))
    out = out.withColumn("nb_answers", F.size("answers")).withColumn("deleted", F.coalesce(F.col("DeletionDate"), F.lit("")) != "")
    return out, raw.where("_p._corrupt_record is not null").select("_p._corrupt_record")

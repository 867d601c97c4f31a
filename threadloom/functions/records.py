"""Functions on records: lenient casts, tags, canonical JSON, fingerprints, titles, formats."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The render contract.
CONTRACT = "1"
QUESTION_FIELDS = ["Id", "Title", "Body", "Score", "Tags", "OwnerUserId", "OwnerDisplayName", "CreationDate", "LastActivityDate", "ViewCount", "LastEditDate", "LastEditorUserId", "AcceptedAnswerId"]
COMMENT_FIELDS = ["Id", "PostId", "UserId", "Score", "Text", "CreationDate", "ContentLicense"]
ANSWER_FIELDS = ["Id", "Score", "Body", "OwnerUserId", "OwnerDisplayName", "CreationDate", "LastEditDate", "LastEditorUserId"]


def lenient_int(c: Column) -> Column:
    """A whole number, or 0 for what is none."""
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def strict_bool(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("1", "true", "yes", "on"), True).when(low.isin("0", "false", "no", "off"), False).otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean"))


def split_tags(tags: Column) -> Column:
    """Sorted tags of ``<a><b>`` or ``|a|b|``, or of a plain list with bars."""
    wrapped = tags.rlike("(?s)^[<|].*[>|]\\z") & (F.length(tags) >= 2)
    inner = F.when(wrapped, tags.substr(F.lit(2), F.length(tags) - 2))
    return F.sort_array(F.when(wrapped, F.split(inner, "\\||><")).otherwise(F.split(tags, "\\|")))


def shard_of(post_id: Column) -> Column:
    """First two digits of the id in eight hex digits."""
    return F.substring(F.lpad(F.lower(F.hex(post_id)), 8, "0"), 1, 2)


def canonical_json(struct: Column) -> Column:
    """Compact JSON, nulls kept; control characters in small hex. The caller orders the fields."""
    out = F.to_json(struct, {"ignoreNullFields": "false"})
    small = out
    for n in (*range(0x00, 0x08), 0x0B, *range(0x0E, 0x20)):
        if f"{n:04X}" != f"{n:04x}":
            # An even number of backslashes before it is text: backslashes that are escaped themselves.
            small = F.regexp_replace(small, f"(?<!\\\\)((?:\\\\\\\\)*)\\\\u{n:04X}", f"$1\\\\u{n:04x}")
    # Few texts have control characters; the others are looked through once, not once for each of these.
    return F.when(F.contains(out, F.lit("\\u00")), small).otherwise(out)


def by_id(array: Column) -> Column:
    """Elements in the order of their numeric ids, as they came where these are equal."""
    keyed = F.transform(array, lambda x, i: F.struct(lenient_int(x["Id"].cast("string")).alias("k"), i.alias("i"), x.alias("x")))
    # Places differ, so elements themselves are never compared; array_sort would interpret a comparison for every two.
    return F.transform(F.sort_array(keyed), lambda s: s["x"])


def comment_json(c: Column) -> Column:
    return F.struct(*[c[f].alias(f) for f in sorted(COMMENT_FIELDS)])


def fingerprint() -> Column:
    """Digest of a question's contracted fields. Columns: QUESTION_FIELDS with ``Tags`` an array, ``comments``, ``answers`` (each
    with ``comments``) and ``links`` (array of structs with ``Id``, fields in order of their names). Order of elements doesn't count."""
    answer = lambda a: F.struct(*[(F.coalesce(F.transform(by_id(a["comments"]), comment_json), F.array()) if f == "comments" else a[f]).alias(f) for f in sorted([*ANSWER_FIELDS, "comments"])])
    own = {
        "Tags": F.array_sort("Tags"),
        "comments": F.coalesce(F.transform(by_id(F.col("comments")), comment_json), F.array()),
        "answers": F.coalesce(F.transform(by_id(F.col("answers")), answer), F.array()),
        "links": F.coalesce(by_id(F.col("links")), F.array()),
    }
    return F.sha2(canonical_json(F.struct(*[own.get(f, F.col(f)).alias(f) for f in sorted({*QUESTION_FIELDS, *own})])), 256)


def tsv_escape(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for char, code in (("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        out = F.replace(out, F.lit(char), F.lit(code))
    return out


def within_tolerance(expected: Column, actual: Column, tolerance: float) -> Column:
    return F.when(expected == 0, actual == 0).otherwise(F.abs(actual - expected) / expected <= tolerance)


def percent_text(expected: Column, actual: Column) -> Column:
    pct = 100.0 * (actual - expected) / expected
    return F.concat(F.format_string("%.1f%% ", F.abs(pct)), F.when(actual >= expected, "more").otherwise("less"))


def strip_namespace(path: Column) -> Column:
    return F.regexp_replace(path, r"^\p{L}/", "")


def slug_path(post_id: Column, slug: Column) -> Column:
    return F.concat(F.lit("questions/"), post_id.cast("string"), F.lit("/"), slug)


def backoff_seconds(attempt: Column, base: float = 2.0) -> Column:
    return F.least(F.lit(60.0), F.lit(base) * F.pow(F.lit(2.0), attempt))


def clean_title(title: str | None, fallback: str) -> str:
    out = unicodedata.normalize("NFKC", title or "")
    out = "".join(" " if c.isspace() else c for c in out if unicodedata.category(c) not in ("Cc", "Cf", "Cs"))
    out = re.sub(r"\s+", " ", out).strip()
    return out[:500] if len(out) >= 3 else fallback


@F.pandas_udf(StringType())
def _clean_title(title: pd.Series, post_id: pd.Series) -> pd.Series:
    return pd.Series([clean_title(t, f"Question {i}") for t, i in zip(title, post_id)])


#: Rows of a batch of titles: one can be as long as a text, so a worker's memory is that of so many of them.
TITLE_ROWS = 500


def sanitize_title(spark: SparkSession, title: Column, post_id: Column | str) -> Column:
    """A title fit for an index. There is no built-in for the compatibility form, so titles that aren't ASCII go through Python, in batches of
    TITLE_ROWS at most (set in the session); of ASCII that form is itself."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(conf)) <= TITLE_ROWS:
        spark.conf.set(conf, str(TITLE_ROWS))
    text, number = F.coalesce(title, F.lit("")), F.col(post_id) if isinstance(post_id, str) else post_id
    plain = F.octet_length(text) == F.length(text)
    flat = F.trim(F.regexp_replace(F.regexp_replace(text, "[\\x00-\\x1F\\x7F]+", ""), " +", " "))
    own = F.when(F.length(flat) >= 3, F.substring(flat, 1, 500)).otherwise(F.concat(F.lit("Question "), number))
    return F.when(plain, own).otherwise(_clean_title(F.when(~plain, text), number))

"""Decisions in which the order of the branches is the meaning. Each returns Columns, so callers choose the joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sync(source_exists: Column, source_valid: Column, source_placeholder: Column, manifest_sha: Column, source_sha: Column, target_exists: Column, target_placeholder: Column, target_valid: Column) -> Column:
    """struct(status, reason) of a recovered image that may replace its target."""
    sha = F.lower(F.coalesce(manifest_sha, F.lit("")))
    reason = (
        F.when(~source_exists, "missing-source").when(~source_valid, "missing-source").when(source_placeholder, "missing-source")
        .when(sha == "", "sha-mismatch").when(source_sha != sha, "sha-mismatch")
        .when(~target_exists, "absent-target").when(target_placeholder, "placeholder-target").when(target_valid, "already-real").otherwise("not-placeholder")
    )
    return F.struct(F.when(reason.isin("absent-target", "placeholder-target"), "applied").otherwise("skipped").alias("status"), reason.alias("reason"))


def finalize(target_exists: Column, target_placeholder: Column, target_valid: Column, dry_run: bool) -> Column:
    """What becomes of a hash that no source has. A target that is no image is written over."""
    return F.when(target_exists & target_placeholder, "already-placeholder").when(target_exists & target_valid, "already-recovered").otherwise("would-write" if dry_run else "written")


def upgrade(fetched: Column, ok: Column, old_bytes: Column, new_bytes: Column, fetch_status: Column) -> Column:
    return F.when(~fetched, "candidate").when(ok & (new_bytes > old_bytes), "upgrade_candidate").when(ok, "no_improvement").otherwise(fetch_status)


def fetch(http: Column, attempt: Column, retries: int, worker: bool = False) -> Column:
    """retry, stop or final for an HTTP status. The worker takes 408 and 425 as final like any other 4xx."""
    last = attempt >= retries
    again = (http >= 500) if worker else (http.isin(408, 425) | (http >= 500))
    return F.when(http == 200, "ok").when(http.isin(403, 429), F.when(last, "stop").otherwise("retry")).when(again, F.when(last, "fail").otherwise("retry")).otherwise("fail")


def render(schema_version: Column, contract: Column, old_digest: Column, digest: Column, html_exists: Column, current_contract: str) -> Column:
    """skip where the page was rendered from the same source under the same contract and is there; else render."""
    same = (schema_version == 2) & (contract == current_contract) & (old_digest == digest) & html_exists
    return F.when(F.coalesce(same, F.lit(False)), "skip").otherwise("render")


def image_problem(file_exists: Column, size: Column, readable: Column, valid: Column, recovered: Column, placeholder: Column) -> Column:
    """First problem of an image of a manifest; null if it has none."""
    return F.when(~file_exists, "missing-file").when(size == 0, "empty-file").when(~readable, "unreadable").when(~valid, "invalid-image").when(recovered & placeholder, "placeholder")


def promote(gates_passed: Column) -> Column:
    return F.when(gates_passed, "publish").otherwise("keep-previous")

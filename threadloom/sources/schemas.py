"""Schemas of the archive's relations."""

from __future__ import annotations

from pyspark.sql import types as T

MANIFEST_FIELDS = ["schema_version", "hash", "source_url", "source_class", "status", "content_sha256", "derived_sha256", "mime", "bytes", "timestamp", "tool_version"]
CLASSIFIED_FIELDS = ["hash", "source_url", "source_class", "status", "page"]
INVENTORY_FIELDS = ["hash", "page_path", "count", "source_class", "anchor_href"]


def text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MANIFEST = text(MANIFEST_FIELDS)
CLASSIFIED = text(CLASSIFIED_FIELDS)
INVENTORY = text(INVENTORY_FIELDS)
STAGE_PAGE = "schema_version int, post_id bigint, title string, zim_path string, answer_redirects array<string>, source_sha256 string, render_contract_version string, snapshot_id string, rendered_at string, tool_version string"
WORKER_STATE = "hash string, url string, status string, source string, content_sha256 string, derived_sha256 string, bytes_in bigint, bytes_out bigint, mime string, error string, updated_at double"

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import collocations, decontamination, language_id, licenses, line_dedup, merkle, minhash, packing, quality, repeats, token_counts, token_files, url_filter

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_repeat_removal": repeats.op3_repeat_removal,
    "op4_packing": packing.op4_packing,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_language_id": language_id.op6_language_id,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_collocations": collocations.op11_collocations,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_token_files": token_files.op13_token_files,
}

ORACLE = {
    "op5_line_dedup": line_dedup.sql,
    "op7_url_filter": url_filter.sql,
    "op9_decontamination": decontamination.sql,
    "op10_quality_rules": quality.sql,
    "op11_collocations": collocations.sql,
    "op12_merkle_manifest": merkle.sql,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: f() for k, f in ORACLE.items()}

"""Queries of the text operators and the SQL of those that SQL can express."""

from __future__ import annotations

from motorlytics.llm import (
    byte_bpe, decontaminate, language_id, license_scan, line_dedup, merkle, periodic_runs, quality_rules, secret_scan, simhash,
    suffix_dedup, token_store, warc,
)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_language_id": language_id.op4_language_id,
    "op5_simhash": simhash.op5_simhash,
    "op6_warc": warc.op6_warc,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_token_store": token_store.op8_token_store,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

SQL = {
    "op2_quality_rules": quality_rules.SQL,
    "op3_secret_scan": secret_scan.SQL,
    "op6_warc": warc.SQL,
    "op11_line_dedup": line_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_periodic_runs": periodic_runs.SQL,
}

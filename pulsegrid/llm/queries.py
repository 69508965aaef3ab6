"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pulsegrid.llm import ann, decontaminate, merkle, neardup, packing, pieces, quality, secrets, substrings, token_files, toxicity, warc, whitening

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_warc_derivatives": warc.query,
    "op3_repeated_substrings": substrings.query,
    "op4_secret_scan": secrets.query,
    "op5_near_duplicates": neardup.query,
    "op6_token_files": token_files.query,
    "op7_toxicity": toxicity.query,
    "op8_pieces": pieces.query,
    "op9_neighbours": ann.query,
    "op10_quality": quality.query,
    "op11_packing": packing.query,
    "op12_merkle_manifest": merkle.query,
    "op13_whitening": whitening.query,
}
ORACLE_SQL: dict[str, str] = {
    "op2_warc_derivatives": warc.SQL,
    "op12_merkle_manifest": merkle.SQL,
}

"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from . import (
    op01_mixing,
    op02_minhash,
    op03_toxicity,
    op04_packing,
    op05_substring,
    op06_ann,
    op07_exact_dedup,
    op08_pii,
    op09_html,
    op10_quality,
    op11_whitening,
    op12_secrets,
    op13_conversations,
)

QUERIES = {
    "op1_mixing": op01_mixing.query,
    "op2_minhash": op02_minhash.query,
    "op3_toxicity": op03_toxicity.query,
    "op4_packing": op04_packing.query,
    "op5_substring": op05_substring.query,
    "op6_ann": op06_ann.query,
    "op7_exact_dedup": op07_exact_dedup.query,
    "op8_pii": op08_pii.query,
    "op9_html": op09_html.query,
    "op10_quality": op10_quality.query,
    "op11_whitening": op11_whitening.query,
    "op12_secrets": op12_secrets.query,
    "op13_conversations": op13_conversations.query,
}

ORACLE = {
    "op1_mixing": op01_mixing.ORACLE,
    "op7_exact_dedup": op07_exact_dedup.ORACLE,
    "op12_secrets": op12_secrets.ORACLE,
}

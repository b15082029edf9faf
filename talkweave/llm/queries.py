"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import additive, bpe, fertility, huffman, packing, recompression, secret_scan, setsketch, suffix_dedup, toxicity

QUERIES = {
    "op1_additive": additive.op1_additive,
    "op2_bpe": bpe.op2_bpe,
    "op3_recompression": recompression.op3_recompression,
    "op4_packing": packing.op4_packing,
    "op5_secrets": secret_scan.op5_secrets,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_huffman": huffman.op7_huffman,
    "op8_fertility": fertility.op8_fertility,
    "op9_setsketch": setsketch.op9_setsketch,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}
ORACLE_SQL: dict[str, str] = {"op3_recompression": recompression.SQL, "op10_suffix_dedup": suffix_dedup.SQL}

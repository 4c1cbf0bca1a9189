"""Queries of the training-data operators and their DuckDB oracles (the rest is tested against brute force)."""

from __future__ import annotations

from contrail.llm import (
    alignment,
    decontamination,
    language,
    line_windows,
    lm,
    merkle,
    order_minhash,
    packing,
    postings,
    quality,
    secrets,
    sharding,
    simhash,
)

QUERIES = {
    "op1_order_minhash": order_minhash.op1_order_minhash,
    "op2_line_windows": line_windows.op2_line_windows,
    "op3_template_decontamination": decontamination.op3_template_decontamination,
    "op4_concat_and_cut": packing.op4_concat_and_cut,
    "op5_crf_quality": quality.op5_crf_quality,
    "op6_assignment_secrets": secrets.op6_assignment_secrets,
    "op7_attention_lm": lm.op7_attention_lm,
    "op8_rendezvous_sharding": sharding.op8_rendezvous_sharding,
    "op9_string_kernel_language": language.op9_string_kernel_language,
    "op10_gray_simhash": simhash.op10_gray_simhash,
    "op11_balanced_postings": postings.op11_balanced_postings,
    "op12_fragment_alignment": alignment.op12_fragment_alignment,
    "op13_merkle_multiproof": merkle.op13_merkle_multiproof,
}

ORACLES: dict[str, str] = {
    "op2_line_windows": line_windows.ORACLE,
    "op13_merkle_multiproof": merkle.ORACLE,
}

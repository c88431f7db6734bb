"""Queries of the subpackage and their DuckDB statements (None: SQL can't
express the operator; the tests hold it against a brute-force version)."""

from __future__ import annotations

from sluice.llm import (
    best_fit,
    hnsw,
    licences,
    merkle,
    near_duplicates,
    packing,
    repetition,
    secret_scan,
    substrings,
    unigram,
    warc,
    whitening,
    wrapper,
)

QUERIES = {
    "op1_warc_revisits": warc.op1_warc_revisits,
    "op2_sentencepiece_unigram": unigram.op2_sentencepiece_unigram,
    "op3_suffix_repetition": repetition.op3_suffix_repetition,
    "op4_wrapper_induction": wrapper.op4_wrapper_induction,
    "op5_pattern_packing": packing.op5_pattern_packing,
    "op6_licence_dice": licences.op6_licence_dice,
    "op7_secret_randomness": secret_scan.op7_secret_randomness,
    "op8_hnsw_search": hnsw.op8_hnsw_search,
    "op9_seed_and_extend": substrings.op9_seed_and_extend,
    "op10_probminhash_classes": near_duplicates.op10_probminhash_classes,
    "op11_bitmap_rank_manifest": merkle.op11_bitmap_rank_manifest,
    "op12_shifted_cholesky_qr": whitening.op12_shifted_cholesky_qr,
    "op13_best_fit_decreasing": best_fit.op13_best_fit_decreasing,
}

SQL: dict[str, str] = {
    "op1_warc_revisits": warc.OP1_SQL,
    "op6_licence_dice": licences.OP6_SQL,
    "op9_seed_and_extend": substrings.OP9_SQL,
    "op11_bitmap_rank_manifest": merkle.OP11_SQL,
}

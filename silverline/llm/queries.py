"""Queries of this package: key -> (spark, sf_dir) -> DataFrame, and oracle SQL."""

from __future__ import annotations

from silverline.llm import (arc_convert, bit_planes, chat_parts, crf_language, license_model, line_bitmaps, piece_bpe, positional_index,
                            rule_ledger, spelling_chunks, suffix_tree_lm, superminhash, toxicity_pu)

QUERIES = {
    "op1_nnpu_toxicity": toxicity_pu.op1,
    "op2_superminhash_near_dedup": superminhash.op2,
    "op3_license_paragraph_model": license_model.op3,
    "op4_suffix_tree_lm": suffix_tree_lm.op4,
    "op5_sentencepiece_merge_rounds": piece_bpe.op5,
    "op6_chat_parts": chat_parts.op6,
    "op7_crf_language_id": crf_language.op7,
    "op8_arc_to_warc": arc_convert.op8,
    "op9_rule_bitmask_ledger": rule_ledger.op9,
    "op10_positional_index_decontamination": positional_index.op10,
    "op11_spelling_chunks": spelling_chunks.op11,
    "op12_bit_plane_hard_negatives": bit_planes.op12,
    "op13_line_keep_bitmaps": line_bitmaps.op13,
}

ORACLES = {
    "op2_superminhash_near_dedup": superminhash.ORACLE,
    "op8_arc_to_warc": arc_convert.ORACLE,
    "op9_rule_bitmask_ledger": rule_ledger.ORACLE,
    "op10_positional_index_decontamination": positional_index.ORACLE,
    "op11_spelling_chunks": spelling_chunks.ORACLE,
    "op12_bit_plane_hard_negatives": bit_planes.ORACLE,
    "op13_line_keep_bitmaps": line_bitmaps.ORACLE,
}

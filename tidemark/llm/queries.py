"""Registered queries of this folder, one for each operator, and their SQL where SQL can express them."""

from tidemark.llm import bpe, decontaminate, language_id, line_dedup, near_dedup, neighbours, prefix_trie, quality, repeat_dedup, resample, secret_scan, token_count, toxicity

QUERIES = {
    "op1_bpe_roundtrip": bpe.op1_bpe_roundtrip,
    "op2_token_counts": token_count.op2_token_counts,
    "op3_repeat_dedup": repeat_dedup.op3_repeat_dedup,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_language_id": language_id.op6_language_id,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "secret_planted_recall": secret_scan.secret_planted_recall,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_importance_resample": resample.op12_importance_resample,
    "op13_nearest": neighbours.op13_nearest,
}

ORACLES = {"op3_repeat_dedup": repeat_dedup.OP3_SQL, "op4_decontaminate": decontaminate.OP4_SQL, "op7_line_dedup": line_dedup.OP7_SQL, "op9_near_dedup": near_dedup.OP9_SQL, "op11_prefix_trie": prefix_trie.OP11_SQL, "op12_importance_resample": resample.OP12_SQL, "op13_nearest": neighbours.OP13_SQL}

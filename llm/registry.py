"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from llm import centroids, embedding_dedup, html_text, language_id, line_dedup, minhash_dedup, mixing, packing, pii, quality_classifier, quality_rules, row_patterns, token_counts

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_minhash_dedup": minhash_dedup.op3_minhash_dedup,
    "op4_packing": packing.op4_packing,
    "op5_mixing": mixing.op5_mixing,
    "op6_html_extraction": html_text.op6_html_extraction,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_pii": pii.op10_pii,
    "op11_centroid_clustering": centroids.op11_centroid_clustering,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_row_patterns": row_patterns.op13_row_patterns,
}
ORACLE_SQL: dict[str, str] = {
    "op3_minhash_dedup": minhash_dedup.ORACLE_SQL,
    "op8_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_centroid_clustering": centroids.ORACLE_SQL,
    "op12_line_dedup": line_dedup.ORACLE_SQL,
    "op13_row_patterns": row_patterns.ORACLE_SQL,
}

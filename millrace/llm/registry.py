"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from millrace.llm import (
    centroids, decontaminate, jaccard_join, licenses, line_dedup, lm_score, mixing, nearest, quality_rules, secret_scan, substring_dedup, token_counts, whitening,
)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_lm_score": lm_score.op2_lm_score,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_centroid_clustering": centroids.op11_centroid_clustering,
    "op12_whitening": whitening.op12_whitening,
    "op13_nearest_neighbours": nearest.op13_nearest_neighbours,
}

#: Where SQL expresses the operator; the others are tested against brute force.
SQL = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op3_substring_dedup": substring_dedup.OP3_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op6_jaccard_join": jaccard_join.OP6_SQL,
    "op7_quality_rules": quality_rules.OP7_SQL,
    "op9_mix_sources": mixing.OP9_SQL,
    "op10_license_scan": licenses.OP10_SQL,
    "op11_centroid_clustering": centroids.OP11_SQL,
    "op13_nearest_neighbours": nearest.OP13_SQL,
}

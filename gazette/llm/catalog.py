"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gazette.llm import (
    cover_tree,
    divergence,
    exact_dedup,
    importance,
    language_id,
    licenses,
    lm_score,
    near_dedup,
    packing,
    sentence_pieces,
    token_counts,
    topk_search,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_sentence_pieces": sentence_pieces.op2_sentence_pieces,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_topk_search": topk_search.op5_topk_search,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_packing": packing.op7_packing,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_embedding_near_dedup": cover_tree.op12_embedding_near_dedup,
    "op13_importance_resampling": importance.op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op5_topk_search": topk_search.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_embedding_near_dedup": cover_tree.ORACLE,
    "op13_importance_resampling": importance.ORACLE,
}

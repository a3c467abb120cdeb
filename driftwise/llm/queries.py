"""All queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from driftwise.llm import dedup_queries, layout_queries, quality_queries, search_queries, text_queries

QUERIES = {
    "op1_extraction": text_queries.extraction,
    "op2_token_counts": text_queries.tokens,
    "op3_quality_rules": quality_queries.quality_rules,
    "op4_near_dedup": dedup_queries.near_dedup,
    "op5_warc": text_queries.warc,
    "op6_decontamination": dedup_queries.decontamination,
    "op7_personal_data": text_queries.personal_data,
    "op8_licenses": text_queries.licenses,
    "op9_sharding": layout_queries.sharding,
    "op10_packing": layout_queries.packing,
    "op11_lexical_search": search_queries.lexical_search,
    "op12_url_filter": search_queries.url_filter,
    "op13_clustering": search_queries.clustering,
    "pipeline": corpus_pipeline.run,
}
TWINS = {
    "op3_quality_rules": quality_queries.OP3_SQL,
    "op4_near_dedup": dedup_queries.OP4_SQL,
    "op6_decontamination": dedup_queries.OP6_SQL,
    "op11_lexical_search": search_queries.OP11_SQL,
    "op12_url_filter": search_queries.OP12_SQL,
    "op13_clustering": search_queries.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    TWINS["pipeline"] = corpus_pipeline.ORACLE_SQL

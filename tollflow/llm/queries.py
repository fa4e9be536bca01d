"""Registered queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from tollflow.llm.bpe import op8_bpe_encoding
from tollflow.llm.embed_dedup import op5_embedding_near_dedup
from tollflow.llm.hard_negatives import op13_hard_negatives
from tollflow.llm.html_text import op7_html_extraction
from tollflow.llm.line_dedup import OP3_SQL, op3_line_dedup
from tollflow.llm.mixing import op9_source_mixing
from tollflow.llm.neighbours import op12_nearest_neighbours
from tollflow.llm.quality_rank import op4_quality_classifier
from tollflow.llm.quality_rules import op10_quality_rules
from tollflow.llm.secrets import op1_secret_scans
from tollflow.llm.simhash import op6_simhash_near_dedup
from tollflow.llm.urls import op2_url_filters
from tollflow.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_url_filters": op2_url_filters,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_bpe_encoding": op8_bpe_encoding,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {"op3_line_dedup": OP3_SQL}

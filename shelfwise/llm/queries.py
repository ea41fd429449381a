"""Queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.decontamination import OP2_SQL, op2_decontamination
from shelfwise.llm.filter_audit import OP13_SQL, op13_filter_audit
from shelfwise.llm.html_text import op5_html_extraction
from shelfwise.llm.language import op4_language
from shelfwise.llm.language_model import op9_language_model
from shelfwise.llm.near_dedup import OP6_SQL, op6_near_dedup
from shelfwise.llm.packing import op10_packing
from shelfwise.llm.pii import op1_pii
from shelfwise.llm.retrieval_packing import op12_retrieval_packing
from shelfwise.llm.substring_dedup import OP3_SQL, op3_substring_dedup
from shelfwise.llm.top_k import OP7_SQL, op7_top_k
from shelfwise.llm.toxicity import op8_toxicity
from shelfwise.llm.vector_codes import OP11_SQL, op11_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language": op4_language,
    "op5_html_extraction": op5_html_extraction,
    "op6_near_dedup": op6_near_dedup,
    "op7_top_k": op7_top_k,
    "op8_toxicity": op8_toxicity,
    "op9_language_model": op9_language_model,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_retrieval_packing": op12_retrieval_packing,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op6_near_dedup": OP6_SQL,
    "op7_top_k": OP7_SQL,
    "op11_vector_codes": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}

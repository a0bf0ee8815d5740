"""Registered queries of the subpackage, and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auditlake.llm.bpe import op5_bpe
from auditlake.llm.chat_format import OP8_SQL, op8_chat_format
from auditlake.llm.decontaminate import op10_decontaminate
from auditlake.llm.jaccard_join import op6_jaccard_join
from auditlake.llm.language import op7_language_id
from auditlake.llm.near_vectors import op11_embedding_near_dedup
from auditlake.llm.quality import op4_quality_rules
from auditlake.llm.resample import OP13_SQL, op13_importance_resampling
from auditlake.llm.substring_dedup import op2_substring_dedup
from auditlake.llm.suffix_dedup import op1_suffix_dedup
from auditlake.llm.toxicity import op9_toxicity
from auditlake.llm.url_filter import op3_url_filter
from auditlake.llm.whitening import op12_embedding_whitening


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_suffix_dedup, op2_substring_dedup, op3_url_filter, op4_quality_rules, op5_bpe,
             op6_jaccard_join, op7_language_id, op8_chat_format, op9_toxicity, op10_decontaminate,
             op11_embedding_near_dedup, op12_embedding_whitening, op13_importance_resampling]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_format": OP8_SQL, "op13_importance_resampling": OP13_SQL}

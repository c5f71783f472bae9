"""Registered queries of this subpackage, ``opN_<name>``, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import collocations
from martlet.llm.bpe import op6_byte_bpe
from martlet.llm.classifier import op1_quality_classifier
from martlet.llm.language_id import op12_language_id
from martlet.llm.near_documents import op4_near_documents
from martlet.llm.near_vectors import op2_near_vectors
from martlet.llm.packing import op7_packing
from martlet.llm.periodic_runs import op11_periodic_runs
from martlet.llm.quality_rules import op8_quality_rules
from martlet.llm.secrets import op10_secrets
from martlet.llm.sharding import op9_sharding
from martlet.llm.substring_dedup import op5_substring_dedup
from martlet.llm.suffix_dedup import op3_suffix_dedup

_QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_near_vectors": op2_near_vectors,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_near_documents": op4_near_documents,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_secrets": op10_secrets,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_id": op12_language_id,
    "op13_collocations": collocations.op13_collocations,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op13_collocations": collocations.ORACLE_SQL}

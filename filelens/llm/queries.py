"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filelens.llm.bpe import op4_bpe_round_trip
from filelens.llm import decontamination, filter_audit, minhash, quality_rules, spelling_variants, substring_dedup
from filelens.llm.decontamination import op2_decontamination
from filelens.llm.filter_audit import op12_filter_audit
from filelens.llm.fingerprints import op3_fingerprints
from filelens.llm.html_extraction import op5_html_extraction
from filelens.llm.language_id import op10_language_id
from filelens.llm.minhash import op6_minhash
from filelens.llm.pii import op9_pii
from filelens.llm.quality_rules import op13_quality_rules
from filelens.llm.spelling_variants import op11_spelling_variants
from filelens.llm.substring_dedup import op1_substring_dedup
from filelens.llm.token_counts import op7_token_counts
from filelens.llm.toxicity import op8_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_html_extraction": op5_html_extraction,
    "op6_minhash": op6_minhash,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_pii": op9_pii,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_filter_audit": op12_filter_audit,
    "op13_quality_rules": op13_quality_rules,
}

SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op2_decontamination": decontamination.SQL,
    "op6_minhash": minhash.SQL,
    "op11_spelling_variants": spelling_variants.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_quality_rules": quality_rules.SQL,
}

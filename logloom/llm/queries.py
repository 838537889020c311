"""Registered queries of this package, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import conversation_repair, jaccard_join, spelling_variants, substring_dedup
from logloom.llm.conversation_repair import op13_conversation_repair
from logloom.llm.fingerprint import op3_document_fingerprints
from logloom.llm.html_extract import op8_html_extraction
from logloom.llm.jaccard_join import op1_ngram_jaccard_join
from logloom.llm.language_id import op12_language_id
from logloom.llm.mixing import op10_mixing
from logloom.llm.packing import op5_best_fit_packing
from logloom.llm.quality_rules import op6_quality_rules
from logloom.llm.secret_scan import op4_secret_scans
from logloom.llm.spelling_variants import op11_spelling_variants
from logloom.llm.substring_dedup import op9_substring_dedup
from logloom.llm.toxicity import op2_toxicity
from logloom.llm.url_filter import op7_url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_toxicity": op2_toxicity,
        "op3_document_fingerprints": op3_document_fingerprints,
        "op4_secret_scans": op4_secret_scans,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_quality_rules": op6_quality_rules,
        "op7_url_filter": op7_url_filter,
        "op8_html_extraction": op8_html_extraction,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_mixing": op10_mixing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_language_id": op12_language_id,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    """The others learn, plan or compare in ways SQL cannot state; tests hold them against brute force."""
    return {
        "op1_ngram_jaccard_join": jaccard_join.SQL,
        "op9_substring_dedup": substring_dedup.SQL,
        "op11_spelling_variants": spelling_variants.SQL,
        "op13_conversation_repair": conversation_repair.SQL,
    }

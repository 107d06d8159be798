"""Queries over the operators of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .backoff_scores import op4_backoff_scores
from .byte_bpe import op8_byte_bpe
from .decontaminate import op5_decontaminate
from .importance_resampling import op12_importance_resampling
from .license_scan import op6_license_scan
from .main_text import op3_main_text
from .ngram_join import op7_ngram_join
from .quality_rules import op9_quality_rules
from .quotation_linking import op2_quotation_linking
from .secret_scan import op1_secret_scan
from .source_divergence import op13_source_divergence
from .substring_dedup import op11_substring_dedup
from .suffix_dedup import op10_suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_quotation_linking": op2_quotation_linking,
        "op3_main_text": op3_main_text,
        "op4_backoff_scores": op4_backoff_scores,
        "op5_decontaminate": op5_decontaminate,
        "op6_license_scan": op6_license_scan,
        "op7_ngram_join": op7_ngram_join,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_quality_rules": op9_quality_rules,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_ngram_join": sql.NGRAM_JOIN,
        "op10_suffix_dedup": sql.SUFFIX_DEDUP,
        "op11_substring_dedup": sql.SUBSTRING_DEDUP,
        "op12_importance_resampling": sql.IMPORTANCE_RESAMPLING,
        "op13_source_divergence": sql.SOURCE_DIVERGENCE,
    }

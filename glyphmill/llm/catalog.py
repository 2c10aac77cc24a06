"""The operators as registered queries, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glyphmill.llm import bpe, collocations, infilling, lattice, licenses, lm, mixing, neardup, privacy, quality, repeats, secrets, winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": lm.query,
        "op2_bpe": bpe.query,
        "op3_fingerprints": winnowing.query,
        "op4_mix_sources": mixing.query,
        "op5_personal_data": privacy.query,
        "op6_license_scan": licenses.query,
        "op7_quality_rules": quality.query,
        "op8_ngram_jaccard_join": neardup.query,
        "op9_secret_scan": secrets.query,
        "op10_long_repeats": repeats.query,
        "op11_embedding_near_dedup": lattice.query,
        "op12_fill_in_middle": infilling.query,
        "op13_collocations": collocations.query,
    }


def statements() -> dict[str, str]:
    return {
        "op6_license_scan": licenses.SQL,
        "op7_quality_rules": quality.SQL,
        "op12_fill_in_middle": infilling.SQL,
        "op13_collocations": collocations.SQL,
    }

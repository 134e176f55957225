"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tally.llm import exact, jaccard, langid, nearest, neardup_vectors, packing, phrases, quality, sampling, substring, suffixes, toxicity, whitening
from tally.llm.oracles import SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [sampling.op10_sampled_pieces, nearest.op7_nearest_neighbours, neardup_vectors.op9_embedding_near_dedup, jaccard.op2_ngram_jaccard_join, toxicity.op3_toxicity, packing.op1_best_fit_packing, suffixes.op4_suffix_array_dedup, quality.op6_quality_classifier, langid.op8_language_id, substring.op5_substring_dedup,
             whitening.op11_embedding_whitening, phrases.op12_phrase_collocations, exact.op13_exact_dedup]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in queries()}

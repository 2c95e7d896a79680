"""Named queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import decontaminate, embed_dedup, filter_audit, html_extract, line_dedup, lm_scoring, minhash_dedup, oracles, quality, sentencepieces, token_counts, token_output, toxicity, whitening

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_quality": quality.op2_quality,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_sentencepiece": sentencepieces.op4_sentencepiece,
        "op5_embedding_dedup": embed_dedup.op5_embedding_dedup,
        "op6_minhash_dedup": minhash_dedup.op6_minhash_dedup,
        "op7_token_output": token_output.op7_token_output,
        "op8_html_extract": html_extract.op8_html_extract,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_line_dedup": line_dedup.op10_line_dedup,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_embedding_whitening": whitening.op12_embedding_whitening,
        "op13_lm_scoring": lm_scoring.op13_lm_scoring,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)

"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wardflow.llm import collocations, decontaminate, hard_negatives, licenses, queries_native, queries_near, queries_quality, queries_tokens, secret_scan


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_rendezvous": queries_native.op1_rendezvous,
        "op2_bpe_automaton": queries_tokens.op2_bpe_automaton,
        "op3_token_files": queries_tokens.op3_token_files,
        "op4_fertility": queries_quality.op4_fertility,
        "op5_bottom_k": queries_near.op5_bottom_k,
        "op6_line_chunks": queries_native.op6_line_chunks,
        "op6_line_passages": queries_native.op6_line_passages,
        "op7_nearest_centroid": queries_quality.op7_nearest_centroid,
        "op8_ownership": queries_native.op8_ownership,
        "op9_set_similarity": queries_native.op9_set_similarity,
        "op10_positional_index": queries_native.op10_positional_index,
        "op11_fm_index": queries_near.op11_fm_index,
        "op12_bilstm_crf": queries_quality.op12_bilstm_crf,
        "op13_strassen": queries_near.op13_strassen,
        "pipeline": corpus_pipeline.run,
    }


def checks() -> dict[str, str]:
    return {
        "op8_ownership": secret_scan.SQL,
        "op9_set_similarity": licenses.check_sql(),
        "op10_positional_index": decontaminate.SQL,
        "op11_fm_index": collocations.SQL,
        "op13_strassen": hard_negatives.SQL,
    }

"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from sheafmill.llm import bpe, decontaminate, golden, language_model, licenses, quality, resampling, secrets, sharding, simhash, toxicity, urls, vectors


def queries() -> dict[str, Callable]:
    found = [quality.op1_quality_crf, bpe.op2_byte_bpe, language_model.op3_kneser_ney, sharding.op4_min_cost_reshard, secrets.op5_secret_scan, decontaminate.op6_benchmark_decontamination, simhash.op7_simhash_near_dedup, vectors.op8_exact_top_k, toxicity.op9_toxicity, urls.op10_url_rules, resampling.op11_importance_resampling, licenses.op12_license_scan, golden.op13_golden_record]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_benchmark_decontamination": decontaminate.ORACLE_OP6, "op8_exact_top_k": vectors.ORACLE_OP8, "op10_url_rules": urls.ORACLE_OP10, "op11_importance_resampling": resampling.ORACLE_OP11, "op13_golden_record": golden.ORACLE_OP13}

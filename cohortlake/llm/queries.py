"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlake.llm import bpe, embeddings, licenses, merkle, mixing, periods, quality, secrets, simhash, substrings, topk, toxicity, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_urls": urls.op1_urls,
        "op2_embeddings": embeddings.op2_embeddings,
        "op3_quality": quality.op3_quality,
        "op4_secrets": secrets.op4_secrets,
        "op5_licenses": licenses.op5_licenses,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_mixing": mixing.op7_mixing,
        "op8_bpe": bpe.op8_bpe,
        "op9_substrings": substrings.op9_substrings,
        "op10_simhash": simhash.op10_simhash,
        "op11_periods": periods.op11_periods,
        "op12_manifest": merkle.op12_manifest,
        "op13_topk": topk.op13_topk,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_urls": urls.OP1_SQL, "op5_licenses": licenses.OP5_SQL, "op12_manifest": merkle.OP12_SQL, "op13_topk": topk.OP13_SQL}

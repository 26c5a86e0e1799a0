"""The queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from anchorctx.llm import decontaminate, merkle, secret_scan
from anchorctx.llm.alignment import op12_alignment
from anchorctx.llm.bpe import op8_bpe
from anchorctx.llm.decontaminate import op10_benchmark_hits
from anchorctx.llm.fingerprints import op2_fingerprints
from anchorctx.llm.language import op13_language
from anchorctx.llm.line_dedup import op6_line_dedup
from anchorctx.llm.lm import op9_lm_scores
from anchorctx.llm.merkle import op11_merkle
from anchorctx.llm.quality import op3_quality
from anchorctx.llm.secret_scan import op5_secrets
from anchorctx.llm.sharding import op1_shards
from anchorctx.llm.simhash import op4_simhash
from anchorctx.llm.toxicity import op7_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_shards,
        op2_fingerprints,
        op3_quality,
        op4_simhash,
        op5_secrets,
        op6_line_dedup,
        op7_toxicity,
        op8_bpe,
        op9_lm_scores,
        op10_benchmark_hits,
        op11_merkle,
        op12_alignment,
        op13_language,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_secrets": secret_scan.ORACLE_SQL,
        "op10_benchmark_hits": decontaminate.ORACLE_SQL,
        "op11_merkle": merkle.ORACLE_SQL,
    }

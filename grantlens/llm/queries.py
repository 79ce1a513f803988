"""Queries over the operators of this package, and SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from grantlens.llm import (
    bpe,
    decontamination,
    edit_embedding,
    html,
    importance,
    lines,
    passages,
    pii,
    quality,
    secrets,
    simhash,
    toxicity,
    zones,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_edit_embedding": edit_embedding.op2_edit_embedding,
    "op3_secrets": secrets.op3_secrets,
    "op4_passages": passages.op4_passages,
    "op5_simhash": simhash.op5_simhash,
    "op6_html": html.op6_html,
    "op7_quality": quality.op7_quality,
    "op8_bpe": bpe.op8_bpe,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_lines": lines.op10_lines,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_importance": importance.op12_importance,
    "op13_zones": zones.op13_zones,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op3_secrets": secrets.SQL,
    "op9_decontamination": decontamination.SQL,
    "op12_importance": importance.SQL,
    "op13_zones": zones.SQL,
}

"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from basketry.llm import (
    bpe,
    decontamination,
    filters,
    fingerprints,
    languages,
    lines,
    oracles,
    pii,
    ranking,
    secrets,
    sharding,
    shingles,
    tokens,
    transducer,
)

_QUERIES = (
    tokens.op1_token_files,
    sharding.op2_shards,
    pii.op3_personal_data,
    decontamination.op4_contamination,
    languages.op5_languages,
    fingerprints.op6_fingerprints,
    shingles.op7_near_documents,
    secrets.op8_secrets,
    bpe.op9_byte_bpe,
    lines.op10_repeated_lines,
    ranking.op11_ranked_documents,
    filters.op12_filter_audit,
    transducer.op13_lexicon_bpe,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run, **{q.__name__: q for q in _QUERIES}}


def oracle_sql() -> dict[str, str]:
    """The other queries end in tokenizers, models, or hashes that SQL does not have."""
    found = {
        "op4_contamination": oracles.OP4,
        "op7_near_documents": oracles.OP7,
        "op8_secrets": oracles.OP8,
        "op11_ranked_documents": oracles.OP11,
        "op12_filter_audit": oracles.OP12,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in found.items() if sql}

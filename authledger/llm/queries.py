"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from authledger.llm import (
    conversation_repair, decontamination, jaccard_join, mixing, near_dedup, quality_crf, quality_rules, records,
    secret_scan, sharding, token_counts, toxicity, whitening,
)
from authledger.llm.common import table


def tokenizer(name: str) -> str:
    """Where the public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, name) for name in names]


def queries() -> dict:
    return {
        "op1_quality_crf": lambda s, d: quality_crf.quality_crf(*_tables(s, d, "documents", "labels")),
        "op2_binary_records": lambda s, d: records.round_trip(s, table(s, d, "documents"), tokenizer("word_bpe_49k.json")),
        "op3_toxicity": lambda s, d: toxicity.toxicity(*_tables(s, d, "documents", "labels")),
        "op4_decontamination": lambda s, d: decontamination.contamination(*_tables(s, d, "documents", "benchmark")),
        "op5_token_counts": lambda s, d: token_counts.token_counts(table(s, d, "documents"), tokenizer("piece_bpe_32k.model")),
        "op6_near_dedup": lambda s, d: near_dedup.near_duplicates(table(s, d, "documents"), width=3, percent=85),
        "op7_secret_scan": lambda s, d: secret_scan.secret_scan(table(s, d, "documents")),
        "op8_sharding": lambda s, d: sharding.shard_documents(table(s, d, "documents")),
        "op9_quality_rules": lambda s, d: quality_rules.quality_rules(*_tables(s, d, "documents", "labels")),
        "op10_mixing": lambda s, d: mixing.mixing_rates(*_tables(s, d, "documents", "labels")),
        "op11_whitening": lambda s, d: whitening.whiten(table(s, d, "embeddings")),
        "op12_conversation_repair": lambda s, d: conversation_repair.report(table(s, d, "conversations")),
        "op13_jaccard_join": lambda s, d: jaccard_join.jaccard_components(table(s, d, "documents"), width=3, percent=90),
    }


def oracles() -> dict[str, str]:
    return {}

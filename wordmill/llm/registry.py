"""The queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import (
    byte_bpe,
    decontamination,
    hard_negatives,
    html_extraction,
    mixing,
    periodic_runs,
    pii,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    warc,
)
from wordmill.llm.common import benchmark, documents, embeddings, labels, pages


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(pages(spark, sf_dir))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(pages(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(documents(spark, sf_dir))
    return judged.withColumn("broken", F.concat_ws(",", "broken"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(documents(spark, sf_dir), plant=True)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(documents(spark, sf_dir), byte_bpe.serialise(ranks), public_tokenizers.PATTERN)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label in seven is moved first, so that close rows of another label exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings(spark, sf_dir).withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_decontamination": op2_decontamination,
        "op3_pii": op3_pii,
        "op4_warc": op4_warc,
        "op5_html_extraction": op5_html_extraction,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_mixing": op8_mixing,
        "op9_simhash": op9_simhash,
        "op10_toxicity": op10_toxicity,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": warc.SQL,
        "op6_substring_dedup": substring_dedup.SQL,
        "op7_quality_rules": quality_rules.SQL,
        "op8_mixing": mixing.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }

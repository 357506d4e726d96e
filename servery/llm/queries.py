"""The operators' queries over the test tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servery.llm import chat
from servery.llm.alignment import alignment_digest
from servery.llm.common import table
from servery.llm.contamination import CONTAMINATION_SQL, contamination_digest, proximity_digest
from servery.llm.fim import FIM_SQL, fim_digest
from servery.llm.hosts import HOST_RULE_SQL, host_rule_digest
from servery.llm.lines import line_digest
from servery.llm.packing import packing_digest
from servery.llm.pii import pii_digest
from servery.llm.secrets import secret_digest
from servery.llm.sharding import shard_digest
from servery.llm.simhash import simhash_digest
from servery.llm.toxicity import toxicity_scores
from servery.llm.urls import URL_SQL, judged


def op1_hmm_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op2_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(table(spark, sf_dir, "documents"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rule_digest(table(spark, sf_dir, "documents"))


def op4_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_digest(table(spark, sf_dir, "documents"))


def op5_shared_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(table(spark, sf_dir, "documents"))


def op7_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def op8_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_proximity_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op11_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(table(spark, sf_dir, "documents"))


def op12_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def op13_rank_index_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_hmm_transcripts": op1_hmm_transcripts,
    "op2_interleaved_shards": op2_interleaved_shards,
    "op3_host_rules": op3_host_rules,
    "op4_gray_simhash": op4_gray_simhash,
    "op5_shared_secrets": op5_shared_secrets,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_winnowed_lines": op7_winnowed_lines,
    "op8_subword_toxicity": op8_subword_toxicity,
    "op9_positional_decontamination": op9_positional_decontamination,
    "op9_proximity_matches": op9_proximity_matches,
    "op10_deobfuscated_pii": op10_deobfuscated_pii,
    "op11_pointer_alignment": op11_pointer_alignment,
    "op12_path_templates": op12_path_templates,
    "op13_rank_index_fim": op13_rank_index_fim,
}

ORACLE: dict[str, str] = {
    "op3_host_rules": HOST_RULE_SQL,
    "op9_positional_decontamination": CONTAMINATION_SQL,
    "op12_path_templates": URL_SQL,
    "op13_rank_index_fim": FIM_SQL,
}

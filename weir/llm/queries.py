"""The registered queries of the corpus operators, with their production parameters, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm.backoff_scores import Backoff, backoff_scores
from weir.llm.byte_bpe import byte_bpe_digest
from weir.llm.common import table
from weir.llm.lexical_search import LexicalSearch, lexical_search
from weir.llm.mixing import Mix, mixed
from weir.llm.near_copies import NearCopies, near_copies
from weir.llm.near_vectors import NearVectors, near_vectors
from weir.llm.personal_data import Redaction, personal_data
from weir.llm.quality_rules import LineLimits, quality_rules
from weir.llm.repeated_passages import Passages, without_repeats
from weir.llm.sql import sql
from weir.llm.toxicity import Toxicity, toxicity
from weir.llm.url_filters import Templates, url_filters
from weir.llm.vector_codes import VectorCodes, vector_codes
from weir.llm.warc import Archives, warc_round_trip

RANKS = "byte_bpe_multi_50k.tiktoken"
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), NearVectors(cosine=0.9))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), Passages(window=35), texts=False)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), LineLimits())


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"), Backoff())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), Mix())


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), NearCopies(size=2, percent=80))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(table(spark, sf_dir, "pages"), RULES, Templates()).withColumn("purity", F.round("purity", 9))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Toxicity())


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"), Redaction())


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), LexicalSearch(top=10))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), Archives(least=0))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"), VectorCodes(parts=16, entries=64, rounds=2))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_near_vectors, op2_substring_dedup, op3_quality_rules, op4_lm_scores, op5_mixing, op6_byte_bpe, op7_near_copies, op8_url_filters, op9_toxicity, op10_personal_data, op11_lexical_search, op12_warc, op13_vector_codes)}

#: The others hold trained models or a tokenizer; tests check them against brute force and held-out rows.
SQL: dict[str, str] = sql(RULES)

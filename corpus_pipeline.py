"""A corpus from documents: quality rules, near copies, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weir.llm.byte_bpe import byte_bpe
from weir.llm.common import saved
from weir.llm.mixing import Mix, mixed
from weir.llm.near_copies import NearCopies, drop_near_copies
from weir.llm.personal_data import Redaction, redacted
from weir.llm.quality_rules import LineLimits, apply_quality_rules
from weir.llm.queries import RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that many texts of their source share."""
    return apply_quality_rules(docs, LineLimits())


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8."""
    return drop_near_copies(docs, NearCopies(size=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data is replaced by its kind."""
    return redacted(docs, Redaction())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, in shuffled order."""
    return mixed(docs, Mix(), number=None)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of every row."""
    return byte_bpe(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("near_copies", near_copies), ("personal_data", personal_data), ("mixing", mixing), ("tokens", tokens)]

#: Trained models and signatures can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

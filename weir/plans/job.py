"""A job from source to published table: extract, transform, write, merge, verify."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from weir.functions.columns import add_metadata, flatten, null_if, rename_columns
from weir.functions.types import apply_contract, override_types
from weir.operators.merge import Policy, apply_policy, evolve, verify
from weir.plans.transform import Step, run_steps
from weir.sources import files, versions
from weir.sources.scratch import scratch


@dataclass(frozen=True)
class Job:
    """What a load does. All days of the range are processed together."""

    policy: Policy
    where: list[Column] = field(default_factory=list)
    contract: dict[str, str] = field(default_factory=dict)
    null_if: list[str] = field(default_factory=list)
    flatten_depth: int = -1
    steps: list[Step] = field(default_factory=list)
    style: tuple[str, str] = ("none", "none")
    overrides: dict[str, str] = field(default_factory=dict)
    metadata: dict[str, bool | str] = field(default_factory=dict)
    partition_date: Column | None = None
    add_new_columns: bool = False


def prepare(spark: SparkSession, source: DataFrame, job: Job, run_id: str, loaded_at: Column | None = None, label: Column | None = None) -> DataFrame:
    """The staging rows: filter, flatten, clean, cast, transform, rename, metadata. One lazy plan."""
    df = source
    for w in job.where:
        df = df.where(w)
    df = apply_contract(null_if(flatten(df, job.flatten_depth), job.null_if), job.contract)
    if job.steps:
        df = run_steps(spark, job.steps, {"source": df})
    if job.style != ("none", "none"):
        df = rename_columns(df, *job.style)
    return add_metadata(override_types(df, job.overrides), job.metadata, run_id=run_id, partition_date=job.partition_date, source=label, loaded_at=loaded_at)


def run_job(spark: SparkSession, source: DataFrame, target: DataFrame, job: Job, run_id: str, loaded_at: Column | None = None, label: Column | None = None) -> DataFrame:
    """The merged and verified table. Without staging rows the target comes back as it is.

    Staging and result are written once, to scratch folders: what is verified is what comes back.
    """
    staging = files.stage_and_verify(prepare(spark, source, job, run_id, loaded_at, label), scratch(spark))
    if staging.isEmpty():
        return target
    target, staging, _ = evolve(target, staging, job.add_new_columns)
    merged = files.stage_and_verify(apply_policy(target, staging, job.policy), scratch(spark))
    verify(merged, staging, job.policy, target=target)
    return merged


def run_and_publish(spark: SparkSession, source: DataFrame, folder: str, job: Job, run_id: str) -> DataFrame:
    """run_job over a table of versions: staging is written once, files that it touches are merged, the rest stays.

    A writer that finds another's version merges again into that. Without staging rows the table stays as it is.
    """
    staging = files.stage_and_verify(prepare(spark, source, job, run_id), scratch(spark))
    base = versions.latest(spark, folder)
    if base and staging.isEmpty():
        return versions.read(spark, folder)
    if base:
        _, staging, _ = evolve(versions.read(spark, folder), staging, job.add_new_columns)
    versions.merge(spark, folder, staging, job.policy, add_columns=True)
    return versions.read(spark, folder)

"""Chains of transform steps over named inputs: SQL specs, Python functions, registered transformers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.columns import masked
from weir.operators.query import Block, Query, run


class Transformer:
    """A step as a class: apply(df, params)."""

    def apply(self, df: DataFrame, params: dict[str, Any]) -> DataFrame:
        raise NotImplementedError


TRANSFORMERS: dict[str, type[Transformer]] = {}


def transformer(name: str) -> Callable[[type[Transformer]], type[Transformer]]:
    def add(cls: type[Transformer]) -> type[Transformer]:
        TRANSFORMERS[name] = cls
        return cls

    return add


@transformer("masking")
class Masking(Transformer):
    """Columns (params: columns, rule, char) masked."""

    def apply(self, df: DataFrame, params: dict[str, Any]) -> DataFrame:
        return df.withColumns({c: masked(F.col(c), params.get("rule", "fixed"), params.get("char", "*")) for c in params["columns"]})


@dataclass(frozen=True)
class Step:
    """One step: a query over its sources, a function df (, params) -> df, or a registered transformer's name."""

    id: str
    sources: list[str]
    query: Query | Block | None = None
    function: Callable[..., DataFrame] | None = None
    transformer: str | None = None
    params: dict[str, Any] = field(default_factory=dict)


def run_steps(spark: SparkSession, steps: list[Step], inputs: dict[str, DataFrame]) -> DataFrame:
    """The last step's result. A source is an earlier step, or else an input."""
    made: dict[str, DataFrame] = {}
    out = None
    for s in steps:
        missing = [n for n in s.sources if n not in made and n not in inputs]
        if missing:
            raise ValueError(f"step {s.id!r}: unknown sources {', '.join(missing)}")
        own = {n: made[n] if n in made else inputs[n] for n in s.sources}
        if s.query is not None:
            out = run(spark, s.query, own)
        else:
            first = own[s.sources[0]]
            if s.function is not None:
                out = s.function(first, s.params) if s.params else s.function(first)
            elif s.transformer in TRANSFORMERS:
                out = TRANSFORMERS[s.transformer]().apply(first, s.params)
            else:
                raise ValueError(f"step {s.id!r}: unknown transformer {s.transformer!r}")
            if not isinstance(out, DataFrame):
                raise TypeError(f"step {s.id!r} gave no DataFrame")
        made[s.id] = out
    if out is None:
        raise ValueError("no steps")
    return out


def by_batch(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function of pandas frames, over batches of rows."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(function, batches)

    return df.mapInPandas(each, schema)


def partition_metrics(rows_in: DataFrame, rows_out: DataFrame, key: Column) -> DataFrame:
    """For each partition: rows in and out, and a status."""
    both = rows_in.select(key.alias("partition_key"), F.lit(1).alias("i")).unionByName(rows_out.select(key.alias("partition_key"), F.lit(0).alias("i")))
    out = both.groupBy("partition_key").agg(F.count_if(F.col("i") == 1).alias("rows_in"), F.count_if(F.col("i") == 0).alias("rows_out"))
    return out.withColumn("status", F.when(F.col("rows_out") == 0, "EMPTY").when(F.col("rows_in") == 0, "NEW").otherwise("DONE"))

"""Streams: cleaning a folder of JSON, incremental file pick-up, upserts and state by micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weir.operators.merge import Policy
from weir.sources import versions


def json_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def clean(stream: DataFrame, required: list[str]) -> DataFrame:
    """Rows that hold all required columns, with the time of processing."""
    return stream.dropna(subset=required).withColumn("processed_at", F.current_timestamp())


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there to a Parquet folder; a restart from the checkpoint adds no row twice."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start(path)


def pick_up(spark: SparkSession, path: str, kind: str, schema: str, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hands each batch of files not seen before to a function."""
    stream = spark.readStream.format(kind).schema(schema).load(path)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_into(stream: DataFrame, folder: str, keys: list[str], latest_by: str, checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into a table of versions; files that hold none of its keys stay as they are.

    Of all rows for a key, those of the table included, the latest wins: a late row never replaces a newer one. A version
    notes the batch that it holds, so that a batch which runs again after a failure changes nothing; thus rows with a
    null in the key, which are added as they come, are added once.
    """
    policy = Policy("upsert", keys, latest_by=latest_by)

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            versions.merge(batch.sparkSession, folder, batch, policy, late=True, batch=(checkpoint, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fold_states(stream: DataFrame, key: str, at: str, status: str, terminal: list[str]) -> DataFrame:
    """(key, at, status) of each key whenever its state changes: a terminal status is never undone, the newer time wins.

    stream(key string, at timestamp, status string). A key's state is three values; rows come in bounded parts.
    """
    final = frozenset(terminal)

    def fold(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else None
        new = best
        for part in parts:
            if part.empty:
                continue
            top = part.assign(final=part[status].isin(final)).sort_values(["final", at], kind="stable", ascending=False).iloc[0]
            row = (bool(top["final"]), int(pd.Timestamp(top[at]).value // 1000), top[status])
            new = row if new is None or row[:2] > tuple(new[:2]) else new
        if new is not None and new != best:
            state.update(new)
            yield pd.DataFrame({key: [k[0]], at: [pd.Timestamp(new[1] * 1000)], status: [new[2]]})

    schema = f"{key} string, {at} timestamp, {status} string"
    return stream.groupBy(key).applyInPandasWithState(fold, schema, "final boolean, micros long, status string", "update", GroupStateTimeout.NoTimeout)

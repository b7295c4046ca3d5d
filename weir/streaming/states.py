"""States by key that leave the store: terminal ones after a while, and what is never heard of again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

class _Fold(StatefulProcessor):
    def __init__(self, at: str, status: str, terminal: frozenset[str], ttl: int):
        self.at, self.status, self.terminal, self.ttl = at, status, terminal, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "final boolean, micros long, status string", self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = tuple(self.best.get()) if self.best.exists() else None
        new = old
        for part in rows:
            if part.empty:
                continue
            top = part.assign(final=part[self.status].isin(self.terminal)).sort_values(["final", self.at], kind="stable", ascending=False).iloc[0]
            row = (bool(top["final"]), int(pd.Timestamp(top[self.at]).value // 1000), top[self.status])
            new = row if new is None or row[:2] > new[:2] else new
        if new is not None and new != old:
            self.best.update(new)
            yield pd.DataFrame({"key": [key[0]], "at": [pd.Timestamp(new[1] * 1000)], "status": [new[2]]})

    def close(self) -> None:
        pass


def timed_states(stream: DataFrame, key: str, at: str, status: str, terminal: list[str], ttl_seconds: float) -> DataFrame:
    """(key, at, status) of each key whenever its state changes: a terminal status is never undone, the newer time wins.

    stream(key string, at timestamp, status string). A key leaves the store so many seconds after its last change:
    until then a terminal status turns late rows away, and afterwards takes no room. Rows of a key that has left begin
    anew, so the time must be longer than rows are late. run_states() starts it, with RocksDB as the store.
    """
    fold = _Fold(at, status, frozenset(terminal), max(1, int(ttl_seconds * 1000)))
    out = stream.groupBy(key).transformWithStateInPandas(fold, "key string, at timestamp, status string", "Update", "ProcessingTime")
    return out.toDF(key, at, status)


#: What a query with such states needs: they are kept on the executors' disks, with changes written to the checkpoint, and
#: not on the heap; and a run that takes what is there ends then, for the time of states to live would call for batches without rows for ever.
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def run_states(folded: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Starts a query of timed states that hands each batch of changes to a function; a query keeps the settings it was started with."""
    conf = folded.sparkSession.conf
    before = {k: conf.get(k, None) for k in _CONF}
    for k, v in _CONF.items():
        conf.set(k, v)
    try:
        return folded.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)

"""What several corpus operators share: reading, saved tables, word hashes, links to components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints. One is made only where none is set and there is one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='weir-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def private(taken: Iterable[str], *names: str) -> list[str]:
    """The names, with as many underscores as it takes to be none of those taken, whatever their case."""
    have = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def every(df: DataFrame) -> list[Column]:
    """All columns of df, whatever signs their names have."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def smallest(df: DataFrame, n: int) -> DataFrame:
    """The n rows of df(doc_id, ...) whose doc_id has the smallest hash. Rows far above the hash that about 2n rows
    stay below are filtered first, so that a partition hands on its share of them and not n rows."""
    rows, h = df.count(), F.xxhash64("doc_id")
    below = df if rows <= 2 * n + 1000 else df.where(h < int((2 * n + 1000) / rows * 2**64) - 2**63)
    return below.orderBy(h, *df.columns).limit(n)


def saved(df: DataFrame) -> DataFrame:
    """df, written as a table in the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weir/{uuid.uuid4().hex}"
    df.write.parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._weir_path = path
    return again


def forget(df: DataFrame) -> None:
    """Deletes a saved table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._weir_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered; the memory is emptied when it has grown to its bound."""

    BOUND = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` words; of fewer words, one for the whole sequence."""
    if not len(h):
        return h
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, U64(size), U64)
    for k in range(size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words of [^\\x20\\x09-\\x0D]+ as UTF-8: bytes.split() parts at just these characters."""
    return text.encode().split() if text else []


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key in turn, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def join_roots(up: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The root of each element after u[k] and v[k] are joined; up holds the roots before. A root is its tree's smallest element."""
    while True:
        a, b = up[u], up[v]
        apart = a != b
        if not apart.any():
            return up
        a, b = a[apart], b[apart]
        up = up.copy()
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (next_up := up[up]).tobytes() != up.tobytes():
            up = next_up


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every id in edges(a, b): the smallest id that it reaches.

    Stars are contracted in rounds: each id sends its larger neighbours, then its smaller ones, to the smallest id
    that it knows, until nothing changes. A round is two aggregations and two joins over saved tables; the number of
    rounds grows with the logarithm of the longest path. Nothing but two sums a round comes to the driver.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = saved(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a > b").distinct().select("a", "b"))
    now = state(e)
    while now[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low_table = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))  # a table, so that the join may split an id with many neighbours
        large = both.where("b > a").join(low_table, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a > b").distinct()
        new = saved(small)
        forget(e)
        forget(low_table)
        e, before = new, now
        now = state(e)
        if now == before:
            break
    roots = e.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return e.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)

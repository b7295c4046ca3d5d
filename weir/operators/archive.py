"""Content-addressed storage, archives and retention as table jobs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.sources.ranged import open_file


def dedupe_content(df: DataFrame, key: str, content: str) -> tuple[DataFrame, DataFrame]:
    """The store (content_hash, content, first key, references), each content once, and the manifest (key, content_hash)."""
    hashed = df.withColumn("content_hash", F.sha2(F.col(content), 256))
    store = hashed.groupBy("content_hash").agg(F.min(key).alias("first_key"), F.count("*").alias("references"), F.first(content).alias(content))
    return store, hashed.select(key, "content_hash")


def read_manifests(spark: SparkSession, path: str, job: str | None = None, day: str | None = None) -> DataFrame:
    df = spark.read.json(path)
    if job is not None:
        df = df.where(F.col("job_id") == job)
    return df if day is None else df.where(F.col("partition_date") == day)


def orphans(vault: DataFrame, manifests: DataFrame, key: str = "content_hash") -> DataFrame:
    """Vault rows that no manifest names; without any manifest this is an error, for it would name everything."""
    if manifests.isEmpty():
        raise ValueError("no manifests: nothing can be called an orphan")
    return vault.join(manifests.select(key), key, "left_anti")


def archive(df: DataFrame, path: str, job: str, dataset: str, day: str) -> None:
    """A dated copy; the same day again replaces just that day."""
    out = df.withColumns({"_job": F.lit(job), "_dataset": F.lit(dataset), "_day": F.lit(day)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_job", "_dataset", "_day").parquet(path)


def restore(spark: SparkSession, path: str, job: str, dataset: str, day: str) -> DataFrame:
    df = spark.read.parquet(path).where((F.col("_job") == job) & (F.col("_dataset") == dataset) & (F.col("_day") == F.lit(day)))
    return df.drop("_job", "_dataset", "_day")


def retention(partitions: DataFrame, day: str, today: Column, days: int = 2555) -> DataFrame:
    """partitions with expires and expired."""
    expires = F.date_add(F.col(day), days)
    return partitions.withColumns({"expires": expires, "expired": expires < today})


def _listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return r.load(path).select("path", F.col("length").alias("size"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """md5 of the range [start, start + length) of each file, read a little at a time; a file stays open while its ranges follow each other."""
    opened: tuple[str, BinaryIO] | None = None

    def digest(path: str, start: int, left: int) -> str:
        nonlocal opened
        if opened is None or opened[0] != path:
            if opened:
                opened[1].close()
            opened = path, open_file(path)
        md5, f = hashlib.md5(), opened[1]
        f.seek(start)
        while left:
            if not (data := f.read(min(left, 1 << 20))):
                raise EOFError(f"{path} is shorter than its listing says")
            md5.update(data)
            left -= len(data)
        return md5.hexdigest()

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length")), strict=True)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([digest(*r) for r in rows], pa.string())], [*batch.schema.names, "md5"])
    if opened:
        opened[1].close()


def file_checksums(spark: SparkSession, path: str, pattern: str = "*.parquet", rows: bool = False) -> DataFrame:
    """path, size, md5 of the written files below a folder, and the rows of Parquet files if asked for.

    A file of any size is read by one task, a little at a time; block_checksums deals the blocks of large files out.
    """
    files = _listing(spark, path, pattern).select("path", "size", F.lit(0).cast("long").alias("start"), F.col("size").alias("length"))
    out = files.repartition(max(1, files.count())).mapInArrow(_digests, "path string, size long, start long, length long, md5 string").select("path", "size", "md5")
    if not rows:
        return out
    counts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(path).groupBy(F.col("_metadata.file_name").alias("__name"), F.col("_metadata.file_size").alias("size")).agg(F.count("*").alias("rows"))
    return out.withColumn("__name", F.element_at(F.split("path", "/"), -1)).join(counts, ["__name", "size"], "left").select("path", "size", "md5", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def block_checksums(spark: SparkSession, path: str, pattern: str = "*", block: int = 64 << 20, tasks: int = 0) -> DataFrame:
    """path, size, blocks, checksum of the files below a folder, whose blocks are read by many tasks.

    The checksum is a tree of two levels, as object stores give for uploads in parts: the md5 of the blocks' md5 (as
    bytes, in order), a dash, and the number of blocks. Equal files have equal ones if their block is the same.
    """
    files = _listing(spark, path, pattern).where("size > 0")
    run = block * max(1, (4 << 20) // block)  # blocks that follow each other are read by one task, about 4 MB of them at a time
    runs, data = files.agg(F.coalesce(F.sum(F.ceil(F.col("size") / run)), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = tasks or max(1, min(runs, int(spark.conf.get("spark.sql.shuffle.partitions"))), min(runs, data >> 26))
    steps = lambda a, b, by: F.explode(F.sequence(a, b - 1, F.lit(by).cast("long")))
    dealt = files.select("path", "size", steps(F.lit(0).cast("long"), F.col("size"), run).alias("run")).repartition(int(n), "path", "run")
    blocks = dealt.select("path", "size", steps(F.col("run"), F.least(F.col("run") + run, "size"), block).alias("start"))
    found = blocks.withColumn("length", F.least(F.lit(block), F.col("size") - F.col("start"))).mapInArrow(_digests, "path string, size long, start long, length long, md5 string")
    whole = F.transform(F.array_sort(F.collect_list(F.struct("start", "md5"))), lambda x: x.md5)
    tree = F.concat(F.md5(F.unhex(F.array_join(whole, ""))), F.lit("-"), F.count("*"))
    return found.groupBy("path", "size").agg(F.count("*").alias("blocks"), tree.alias("checksum"))

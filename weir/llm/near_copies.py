"""Near copies of documents: MinHash signatures, a multi-index Hamming join, confirmation on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import U64, WordHashes, components, every, mix, partitions, private, runs, saved, shingles


@dataclass(frozen=True)
class NearCopies:
    """size: words in a shingle. percent: the least similarity (Jaccard, in hundredths).

    A signature is `chunks` x `width` minima of 16 bits. A chunk may hold one position that differs: each of its
    `width` ways to leave one out is a key. Signatures that differ in fewer than 2 x chunks positions share a key by
    the pigeonhole principle. At a similarity of 0.8, a pair shares none with a probability of about 1e-7.
    most: positions that may differ in signatures of a pair that is confirmed (31 of 60 or more at a similarity of 0.8: 1e-7).
    tile: shingles in one side of a tile, the unit of work in which sets are compared.
    """

    size: int = 5
    percent: int = 80
    chunks: int = 12
    width: int = 5
    most: int = 30
    tile: int = 1_000_000
    seed: int = 7


def _minima(sets: np.ndarray, p: NearCopies) -> np.ndarray:
    rng = np.random.default_rng(p.seed)
    n = p.chunks * p.width
    a, b = rng.integers(0, 2**63, n, dtype=U64) * U64(2) + U64(1), rng.integers(0, 2**63, n, dtype=U64)
    low = np.full(n, np.iinfo(U64).max, U64)
    for k in range(0, len(sets), 8192):
        low = np.minimum(low, ((sets[k : k + 8192, None] ^ b) * a).min(axis=0))
    return (mix(low) >> U64(48)).astype(np.uint16)


def _keys(signature: np.ndarray, p: NearCopies) -> np.ndarray:
    """For each chunk and each position left out, a hash of the rest."""
    chunk = signature.astype(U64).reshape(p.chunks, p.width)
    out = []
    for left_out in range(p.width):
        h = np.arange(p.chunks, dtype=U64) * U64(p.width) + U64(left_out)
        for k in range(p.width):
            if k != left_out:
                h = mix(h * U64(0x9E3779B97F4A7C15) + chunk[:, k])
        out.append(h)
    return np.concatenate(out)


def _set_of(text: str | None, hashes: WordHashes, p: NearCopies) -> np.ndarray:
    return np.unique(shingles(hashes.of(text.encode().lower().split() if text else []), p.size))  # bytes: A-Z only, ASCII white space only


def _sign(p: NearCopies) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, n, prints, keys = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                s = _set_of(text.as_py(), hashes, p)
                ids.append(doc_id)
                n.append(len(s))
                prints.append(hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None)
                keys.append(_keys(_minima(s, p), p).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "print", "keys"])

    return sign


def _confirm(p: NearCopies) -> Callable:
    """Links of each tile, as (a, b) of its spanning forest."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found = WordHashes(), []
        for t in runs(batches, ["cluster", "i", "j"]):
            if len(found) >= 10_000:
                yield _links(found)
                found = []
            t = t.sort_by("doc_id")
            docs, side = t.column("doc_id").to_pylist(), t.column("chunk").to_numpy()
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            sets = [_set_of(x.as_py(), hashes, p) for x in t.column("text")]
            size = np.array([len(s) for s in sets])
            signs = np.stack([_minima(s, p) for s in sets])
            part = np.arange(len(docs))  # each document's component so far; pairs within one need no comparison
            for x in range(len(docs)):
                others = np.flatnonzero((side[x + 1 :] != side[x]) if i != j else np.ones(len(docs) - x - 1, bool)) + x + 1
                others = others[part[others] != part[x]]
                others = others[100 * np.minimum(size[x], size[others]) >= p.percent * np.maximum(size[x], size[others])]
                apart = (signs[others] != signs[x]).sum(axis=1)
                order = np.argsort(apart, kind="stable")
                others = others[order[apart[order] <= p.most]]
                while len(others):
                    y, others = int(others[0]), others[1:]
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= p.percent * (len(sets[x]) + len(sets[y]) - both):
                        part[part == part[y]] = part[x]
                        others = others[part[others] != part[x]]
                        found.append((docs[x], docs[y]))
        yield _links(found)

    return confirm


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def near_copies(docs: DataFrame, p: NearCopies = NearCopies()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs(doc_id, text, ...).

    A document's set is its distinct shingles of `size` words, A-Z lower-cased; with fewer words the whole sequence is
    one. Two documents are linked if the sets' similarity is `percent` or more; component_id is the smallest doc_id
    that links reach. Documents with equal sets are one class from the start, so copies are never compared. Classes
    that share a key form clusters; a cluster is compared in tiles of bounded size, within which pairs of one
    component are skipped. Null and empty texts have no shingle and no link. A row whose doc_id is null links with
    nothing; rows with one doc_id and text each get that document's component. A doc_id names one document: texts of
    several rows of it link what any of them links to. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    signed = saved(docs.mapInArrow(_sign(p), "doc_id long, n_shingles long, print binary, keys array<long>"))
    classes = saved(signed.where("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")))
    keyed = classes.select("rep", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    clusters = saved(components(keyed.join(first, "key").where("rep > first").select(F.col("rep").alias("a"), F.col("first").alias("b"))))
    sized = clusters.join(classes.select(F.col("rep").alias("id"), "n"), "id")
    chunks = sized.groupBy("component_id").agg(F.ceil(F.sum("n") / p.tile).cast("int").alias("of"))
    member = sized.join(chunks, "component_id").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    tiles = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).select(F.col("id").alias("doc_id"), F.col("component_id").alias("cluster"), "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    dealt = docs.join(tiles, "doc_id").repartition(partitions(spark), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    links = dealt.mapInArrow(_confirm(p), "a long, b long")
    found = components(links).withColumnRenamed("id", "rep")
    rows = signed.drop("keys").join(classes.select("print", "rep"), "print", "left").join(found, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_copies(docs: DataFrame, p: NearCopies = NearCopies()) -> DataFrame:
    """docs without the documents whose component has a smaller doc_id; rows without a doc_id stay.

    Of rows that repeat a doc_id, all stay or go together. All columns stay, whatever their names.
    """
    (gone,) = private(docs.columns, "_gone")
    ids = near_copies(docs, p).where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(ids, docs["doc_id"] == F.col(gone), "left_anti").select(*every(docs))

"""Language-model scores by stupid backoff over corpus counts of n-grams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import U64, WordHashes, mix, partitions, words_of


@dataclass(frozen=True)
class Backoff:
    """order: words of the longest n-gram. An n-gram seen fewer than `least` times backs off to the one without its
    first word, times `discount`; a single word never does. chunk: characters, at most on average, of the texts whose n-grams are listed together,
    bucket: of those whose n-grams a bucket of the table of counts holds on average.
    """

    order: int = 2
    least: int = 2
    discount: float = 0.4
    chunk: int = 12_000_000
    bucket: int = 6_000_000


SCALE = 1_000_000  # scores are summed as whole millionths, so that sums do not hang on their order
START = U64(0x5157)  # stands for the beginning of a text, as if it were a word
WORDS = U64(0)  # the n-gram of no words, which each place holds: its count is that of all words


def _hashes(words: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order from 1, hashes of the n-grams that end before the first word, at it, and so on to the last; the words before a text are its start."""
    padded = np.concatenate([np.full(order, START, U64), words])
    out = []
    for k in range(1, order + 1):
        h = np.full(len(words) + 1, U64(k), U64)
        for j in range(order - k, order):
            h = mix(h * U64(0x9E3779B97F4A7C15) + padded[j : j + len(words) + 1])
        out.append(h)
    return out


def _of_texts(texts: pa.ChunkedArray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text, and for each order the n-grams of those that have any, one text after the other."""
    hashes = WordHashes()
    words = [hashes.of(words_of(text.as_py())) for text in texts]
    held = [_hashes(w, order) for w in words if len(w)]
    return np.array([len(w) for w in words], np.int64), [np.concatenate([h[k] for h in held]) if held else np.empty(0, U64) for k in range(order)]


def _places(sizes: np.ndarray) -> np.ndarray:
    """Which n-grams of texts with so many words end at a word: all but each text's first."""
    sizes = sizes[sizes > 0]
    at = np.ones(int((sizes + 1).sum()), bool)
    at[np.cumsum(np.concatenate([[0], sizes + 1]))[:-1]] = False
    return at


def _chunk_grams(t: pa.Table, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Words of each text of a chunk, n-grams at their places, the different n-grams in order, and how often they occur."""
    sizes, grams = _of_texts(t.column("text"), order)
    # What stands before a first word is the history of one place, and no n-gram of the longest order.
    every, n = np.unique(np.concatenate([*grams[:-1], grams[-1][_places(sizes)], [WORDS]]), return_counts=True)
    n[np.searchsorted(every, WORDS)] = sizes.sum()
    return sizes, grams, every, n


def _list(p: Backoff, bits: int) -> Callable:
    """A row for each bucket of a chunk: its n-grams, in order, and their counts. A bucket is what the first bits of the hash say."""

    def listed(t: pa.Table) -> pa.Table:
        _, _, every, n = _chunk_grams(t, p.order)
        bucket = (every >> U64(64 - bits)).astype(np.int32)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        offsets = pa.array(np.append(first, len(every)), pa.int32())
        lists = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (every.view(np.int64), n.astype(np.int32)))
        return pa.table([pa.array(bucket[first]), pa.array(np.full(len(first), t.column("chunk")[0].as_py(), np.int32)), *lists], ["bucket", "chunk", "grams", "n"])

    return listed


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(c.flatten().to_numpy() for c in lists.chunks)])


def _count(t: pa.Table) -> pa.Table:
    """The table of counts of one bucket: its n-grams that the corpus has more than once."""
    every, at = np.unique(_flat(t.column("grams")), return_inverse=True)
    n = np.bincount(at, _flat(t.column("n"))).astype(np.int64)
    every, n = every[n > 1], n[n > 1]
    return pa.table([pa.array([t.column("bucket")[0].as_py()], pa.int32()), pa.array([every], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64()))], ["bucket", "grams", "counts"])


def _squeezed(x: np.ndarray) -> bytes:
    """Counts, first the lowest bytes of all, then the next, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _opened(x: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def _join(listed: pa.Table, counts: pa.Table) -> pa.Table:
    """For each chunk of a bucket the counts of its n-grams, in their order; 1 where the table has none."""
    known, n = np.append(_flat(counts.column("grams")), 0), np.append(_flat(counts.column("counts")), 1)
    grams = _flat(listed.column("grams"))
    at = np.searchsorted(known[:-1], grams)
    found = np.where((at < len(known) - 1) & (known[at] == grams), n[at], 1)
    sizes = [k for c in listed.column("grams").chunks for k in c.value_lengths().to_pylist()]
    packed = [_squeezed(x) for x in np.split(found, np.cumsum(sizes)[:-1])]
    return pa.table([listed.column("chunk"), listed.column("bucket"), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], ["chunk", "bucket", "size", "counts"])


def _score(p: Backoff) -> Callable:
    """The sum of log scores of each text of a chunk, from the counts of its n-grams."""

    def score(texts: pa.Table, counted: pa.Table) -> pa.Table:
        sizes, grams, every, _ = _chunk_grams(texts, p.order)
        parts = counted.sort_by("bucket")
        counts = np.concatenate([_opened(x.as_py(), n) for x, n in zip(parts.column("counts"), parts.column("size").to_pylist(), strict=True)]).astype(float)
        n = [counts[np.searchsorted(every, g)] if k < p.order - 1 else None for k, g in enumerate(grams)]
        at = np.flatnonzero(_places(sizes))
        top = counts[np.searchsorted(every, grams[-1][at])]
        value = (top if p.order == 1 else n[0][at]) / counts[np.searchsorted(every, WORDS)]
        for k in range(1, p.order):
            own = top if k == p.order - 1 else n[k][at]
            value = np.where(own >= p.least, own / n[k - 1][at - 1], p.discount * value)
        sums = np.concatenate([[0], np.cumsum(np.rint(np.log(value) * SCALE).astype(np.int64))])
        ends = np.cumsum(sizes)
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": sizes, "score_micro": sums[ends] - sums[ends - sizes]})

    return score


def backoff_scores(docs: DataFrame, p: Backoff = Backoff()) -> DataFrame:
    """doc_id, n_words, score_micro of every row of docs(doc_id, text, ...): the sum of log scores in millionths.

    S(w | v) = count(v w) / count(v) if the corpus has `v w` at least `least` times, else discount * S(w | shorter v), and
    at last discount * count(w) / words. A first word's v is the text's start. Counts are of all words of all texts.
    N-grams go by 64-bit hashes. Texts are dealt into chunks by hash; a chunk lists each of its different n-grams once, so
    that none has more places than there are chunks. Dealt by the hash's first bits into buckets of bounded size, they are
    summed to the table of counts; each bucket of it is joined to the chunks' n-grams there, a chunk's counts return to it, and
    scores are summed by document. Texts are shuffled once and n-grams once, each read twice; one sum reaches the driver.
    Null and empty texts have 0 words and a score of 0. Each row is scored by itself, and counts as often as it occurs.
    Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n = partitions(spark)
    bits = max(2 * n, size // p.bucket).bit_length()
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(size // p.chunk + 1, n))).cast("int")).repartition(n, "chunk")
    listed = dealt.groupBy("chunk").applyInArrow(_list(p, bits), "bucket int, chunk int, grams array<long>, n array<int>").repartition(n, "bucket")
    counts = listed.groupBy("bucket").applyInArrow(_count, "bucket int, grams array<long>, counts array<long>")
    joined = listed.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(_join, "chunk int, bucket int, size int, counts binary")
    return dealt.groupBy("chunk").cogroup(joined.groupBy("chunk")).applyInArrow(_score(p), "doc_id long, n_words long, score_micro long")

"""Vector codes: product quantisation in whole numbers, its codebooks fitted by ball k-means."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import saved


@dataclass(frozen=True)
class VectorCodes:
    """Vectors are cut into equal `parts`, each with a codebook of `entries`, which starts as the parts of the first
    vectors by id and moves to its parts' means in so many `rounds`. A component x counts as floor(scale * x).

    rows: of a batch that is compared at a time. labels: sums by label up to so many are broadcast, more are joined by a shuffle.
    """

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    rows: int = 4096
    labels: int = 100_000

    def __post_init__(self) -> None:
        if not (self.parts > 0 and 0 < self.entries <= 256 and self.rounds >= 0):
            raise ValueError("a code has parts of one byte each")


def whole_vectors(vectors: DataFrame, p: VectorCodes) -> DataFrame:
    """(vec_id, label, embedding) of the vectors without null or non-finite components that can be cut into parts."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "label", "embedding").where(good & (F.size("embedding") > 0) & (F.size("embedding") % p.parts == 0))


def _ints(column: pa.Array, dims: int, p: VectorCodes) -> np.ndarray:
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * p.scale)
    if x.size and np.abs(x).max() > (most := isqrt((1 << 59) // dims)):
        raise OverflowError(f"squared distances need components of at most {most / p.scale:g} in size")
    return x.astype(np.int64).reshape(-1, dims)


def first_entries(vectors: DataFrame, p: VectorCodes) -> np.ndarray:
    """The starting codebooks (part, entry, position): vectors of the smallest ids (nulls last, equal ids by their components).

    Vectors of another length than the first one's are none of the table.
    """
    ordered = lambda df: df.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(p.entries).select(F.col("embedding").cast("array<double>").alias("embedding"))
    rows = [r.embedding for r in ordered(vectors).collect()]
    if not rows:
        return np.zeros((p.parts, 0, 0), np.int64)
    dims = len(rows[0])
    if any(len(r) != dims for r in rows):
        rows = [r.embedding for r in ordered(vectors.where(F.size("embedding") == dims)).collect()]
    return np.ascontiguousarray(_ints(pa.array(rows), dims, p).reshape(len(rows), p.parts, -1).transpose(1, 0, 2))


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row, of equally near ones the first, by comparing with all."""
    gaps = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        gaps += (x[:, k, None] - entries[None, :, k]) ** 2
    return gaps.argmin(1)


class Balls:
    """One codebook, ready to reassign rows that know an entry each: any entry gives the same result, a near one sooner.

    An entry's ball holds its rows; its radius is the distance of the farthest. Only entries at most two radii away
    can be as near to one of them: its neighbours. A row less than half the way to the nearest neighbour is in the
    stable core and stays. A row in the ring between half the ways to the k-th and the next neighbour is compared
    with the first k. All is exact: squares of whole numbers are compared, 2d < D as 4d² < D².
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None] - entries[None]) ** 2).sum(2)
        self.order = gaps.argsort(1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, 1)

    def nearest(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each row's nearest entry, of equally near ones the first, its squared distance, and the number of comparisons."""
        own = ((x - self.entries[code]) ** 2).sum(1)
        radius = np.zeros(len(self.entries), np.int64)
        np.maximum.at(radius, code, own)
        neighbours = (self.gaps <= 4 * radius[:, None]).sum(1)
        ring = np.zeros(len(x), np.int64)
        by_entry = code.argsort(kind="stable")
        starts = np.searchsorted(code[by_entry], np.arange(len(self.entries) + 1))
        for k, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
            rows = by_entry[a:b]
            ring[rows] = np.searchsorted(self.gaps[k, : neighbours[k]], 4 * own[rows], side="right")
        code = code.copy()
        moving = np.flatnonzero(ring > 1)  # each row's own entry is always in its ring
        if len(moving):
            n = ring[moving]
            first = np.cumsum(n) - n
            row = np.repeat(moving, n)
            entry = self.order[code[row], np.arange(n.sum()) - np.repeat(first, n)]
            gap = ((x[row] - self.entries[entry]) ** 2).sum(1)
            least = np.minimum.reduceat(gap, first)
            code[moving] = np.minimum.reduceat(np.where(gap == np.repeat(least, n), entry, len(self.entries)), first)
            own[moving] = least
        return code, own, len(x) + int(ring[moving].sum())


def _start(books: np.ndarray, p: VectorCodes) -> Callable:
    """Whole-number components and codes by comparison with all first entries."""
    parts, _, width = books.shape

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, p.rows):
                batch = whole.slice(a, p.rows)
                x = _ints(batch.column("embedding"), parts * width, p)
                code = np.stack([nearest(x[:, k * width : (k + 1) * width], books[k]) for k in range(parts)], 1).astype(np.uint8)
                values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, parts * width, dtype=np.int32), x.astype(np.int32).ravel())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), values, pa.array([r.tobytes() for r in code], pa.binary())], ["vec_id", "label", "x", "code"])

    return start


def _assigned(balls: list[Balls], p: VectorCodes, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of batches with x (row, part, position), codes and squared distances (row, part)."""
    parts, width = len(balls), balls[0].entries.shape[1]
    for whole in batches:
        for a in range(0, whole.num_rows, p.rows):
            batch = whole.slice(a, p.rows)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width)
            old = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
            found = [balls[k].nearest(x[:, k], old[:, k])[:2] for k in range(parts)]
            yield batch, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _sums(books: np.ndarray, p: VectorCodes) -> Callable:
    """(slot, value): for each part and entry the sums by position and, last, the count of what is assigned to it."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, x, code, _ in _assigned([Balls(b) for b in books], p, batches):
            for k in range(parts):
                np.add.at(total[k, :, :width], code[:, k], x[:, k])
                total[k, :, width] += np.bincount(code[:, k], minlength=entries)
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(flat[slots])], ["slot", "value"])

    return sums


def _moved(coded: DataFrame, books: np.ndarray, p: VectorCodes) -> np.ndarray:
    """The codebooks after a round: means, rounded down, of what is nearest to each entry; entries without any stay.

    parts * entries * (positions + 1) sums come to the driver, whatever the number of vectors.
    """
    rows = coded.select("x", "code").mapInArrow(_sums(books, p), "slot int, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(books.size // books.shape[2] * (books.shape[2] + 1), np.int64)
    for r in rows:
        flat[r.slot] = r.value
    total = flat.reshape(*books.shape[:2], -1)
    count = total[..., -1:]
    return np.where(count > 0, total[..., :-1] // np.maximum(count, 1), books)


def _finish(books: np.ndarray, p: VectorCodes) -> Callable:
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, code, gaps in _assigned([Balls(b) for b in books], p, batches):
            text, step = code.astype(np.uint8).tobytes().hex(), 2 * code.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(gaps.sum(1))], ["vec_id", "label", "code", "error"])

    return finish


def fitted(vectors: DataFrame, p: VectorCodes) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every whole vector, and the codebooks (part, entry, position).

    The vectors are read twice and written once, as whole numbers with the codes by the first entries. All later rounds
    start from those codes, so that only sums leave a round: a row's start sets how many entries it is compared with,
    not the result.
    """
    vectors = whole_vectors(vectors, p)
    books = first_entries(vectors, p)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    if not books.size:
        return vectors.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    own = vectors.where(F.size("embedding") == books.shape[0] * books.shape[2])
    coded = saved(own.mapInArrow(_start(books, p), f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<int>, code binary"))
    for _ in range(p.rounds):
        books = _moved(coded, books, p)
    return coded.mapInArrow(_finish(books, p), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, p: VectorCodes) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of vectors(vec_id, embedding, label).

    Left out: vectors that are null, hold null or non-finite components, or can't be cut into the parts of the first one
    by id: of no component, a length that isn't a multiple of the parts, or another length. Rows that share an id are
    coded each; an id of null comes last in order; a null label is a label. Fewer vectors than entries give shorter
    codebooks. A component too large for 64-bit squared distances is an overflow error. Other columns are passed over.
    """
    coded, books = fitted(vectors, p)
    coded = saved(coded)
    errors = saved(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))  # a table, so that the join may split a label with many vectors
    some = F.broadcast(errors) if errors.count() <= p.labels else errors
    return coded.join(some, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def decoded(codes: DataFrame, books: np.ndarray, p: VectorCodes) -> DataFrame:
    """(vec_id, embedding): the entries that each code names, in the vectors' own scale."""
    kind = codes.schema["vec_id"].dataType.simpleString()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, p.parts)
            x = np.concatenate([books[k][code[:, k]] for k in range(p.parts)], 1) / p.scale
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())], ["vec_id", "embedding"])

    return codes.select("vec_id", "code").mapInArrow(look_up, f"vec_id {kind}, embedding array<double>")

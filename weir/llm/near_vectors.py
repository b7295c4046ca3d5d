"""Near copies of embeddings: a subspace pigeonhole join on rotated vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import components, join_roots, partitions, runs, saved


@dataclass(frozen=True)
class NearVectors:
    """cosine: the least that links. block: dimensions in a block of the rotated unit vectors.

    Unit vectors with a cosine of at least c differ by at most 2 - 2c in squared distance, so in one block at least
    by at most that block's share in proportion to its dimensions. Each block is range-joined under its share, first by
    its first dimension in cells twice the range wide. tile: rows of one side of a unit of work.
    """

    cosine: float = 0.9
    block: int = 16
    tile: int = 16_000
    seed: int = 1


SLACK = 1 + 1e-9  # of budgets, against rounding; the cosine that confirms a pair has none


def _rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(dims: int, p: NearVectors) -> list[tuple[int, int, float]]:
    """First and last dimension and squared budget of each block."""
    total = max(0.0, 2 - 2 * p.cosine)
    return [(a, min(a + p.block, dims), total * (min(a + p.block, dims) - a) / dims) for a in range(0, dims, p.block)]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _turned(x: np.ndarray, p: NearVectors) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1)[:, None]) @ _rotation(x.shape[1], p.seed)


def _deal(p: NearVectors) -> Callable:
    """Each vector's coordinates in each block, for its own cell and for the smaller cell that comes within the block's range of it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dims: dict[int, list[int]] = {}
            for k, n in enumerate(batch.column("embedding").value_lengths().to_pylist()):
                by_dims.setdefault(n, []).append(k)
            for dims, which in by_dims.items():
                some = batch.take(pa.array(which))
                y = _turned(_matrix(some.column("embedding")), p)
                for b, (first, last, budget) in enumerate(_blocks(dims, p)):
                    reach = np.sqrt(budget * SLACK) + 1e-9
                    home, low = (np.floor((y[:, first] - d) / (2 * reach)).astype(np.int64) for d in (0, reach))
                    near = np.flatnonzero(low < home)
                    row = np.concatenate([np.arange(len(y)), near])
                    part = y[row, first:last].astype("<f4")
                    n, width = part.shape
                    own = np.arange(n) < len(y)
                    coordinates = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), n, [None, pa.py_buffer(part.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dims), pa.int32()), pa.array(np.full(n, b), pa.int32()), pa.array(np.concatenate([home, low[near]])), pa.array(own), some.column("rep").take(pa.array(row)), coordinates], _DEALT)

    return deal


_DEALT = ["dims", "block", "cell", "own", "rep", "part"]


def _candidates(part: np.ndarray, budget: float, rows: np.ndarray, columns: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose squared distance in the block may be within the budget: rows x columns, or rows among themselves.

    Distances come from one product for each piece, small enough for a core's cache.
    """
    own = (part * part).sum(axis=1, keepdims=True)
    left, right = np.hstack([-2 * part, own, np.ones_like(own)]), np.hstack([part, np.ones_like(own), own])
    within = columns is None
    columns = rows if within else columns
    right = right[columns].T
    for r in range(0, len(rows), 128):
        some = rows[r : r + 128]
        for c in range(r if within else 0, len(columns), 4096):
            near = left[some] @ right[:, c : c + 4096] <= budget + 1e-5
            hit = np.flatnonzero(near)
            if len(hit):
                u, v = np.divmod(hit, near.shape[1])
                ok = c + v > r + u if within else slice(None)
                yield some[u][ok], columns[c + v][ok]


def _work(side: np.ndarray, own: np.ndarray, i: int, j: int) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Rows and columns to compare in a tile. Pairs of two vectors that are both only near this cell meet in another one."""
    of = lambda s, o: np.flatnonzero((side == s) & (own == o))
    if i == j:
        return [(of(i, True), None), (of(i, True), of(i, False))]
    return [(of(i, True), np.flatnonzero(side == j)), (of(i, False), of(j, True))]


def _near(p: NearVectors) -> Callable:
    """The rows of each tile that have a partner within the block's budget, by the block's coordinates alone."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, TILE):
            t = t.combine_chunks()
            own, side = (t.column(c).to_numpy() for c in ("own", "chunk"))
            b, i, j, dims = (t.column(c)[0].as_py() for c in ("block", "i", "j", "dims"))
            part = np.frombuffer(b"".join(t.column("part").to_pylist()), "<f4").reshape(t.num_rows, -1)
            has = np.zeros(t.num_rows, bool)
            for rows, columns in _work(side, own, i, j):
                for u, v in _candidates(part, _blocks(dims, p)[b][2], rows, columns):
                    has[u] = has[v] = True
            if has.any():
                yield t.select([*TILE, "chunk", "own", "rep"]).filter(pa.array(has)).combine_chunks().to_batches()[0]

    return near


TILE = ["dims", "block", "cell", "i", "j"]


def _compare(p: NearVectors) -> Callable:
    """For each tile and class with a link in it: how many vectors it links with, and a class that it reaches."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, TILE):
            t = t.combine_chunks()
            rep, n, own, side = (t.column(c).to_numpy() for c in ("rep", "n", "own", "chunk"))
            b, i, j = (t.column(c)[0].as_py() for c in ("block", "i", "j"))
            x = _matrix(t.column("embedding").chunk(0))
            y = _turned(x, p)
            blocks = _blocks(x.shape[1], p)
            first, last, budget = blocks[b]
            part = y[:, first:last].astype(np.float32)
            norm = np.linalg.norm(x, axis=1)
            links, roots = np.zeros(len(rep), np.int64), np.arange(len(rep))
            for rows, columns in _work(side, own, i, j):
                for u, v in _candidates(part, budget, rows, columns):
                    ok = (x[u] * x[v]).sum(axis=1) / (norm[u] * norm[v]) >= p.cosine
                    if not ok.any():
                        continue
                    u, v = u[ok], v[ok]
                    d = (y[u] - y[v]) ** 2
                    fits = np.stack([d[:, f:g].sum(axis=1) <= most * SLACK for f, g, most in blocks], axis=1)
                    ok = fits[:, b] & ~fits[:, :b].any(axis=1)  # counted in the first block that has it
                    u, v = u[ok], v[ok]
                    np.add.at(links, u, n[v])
                    np.add.at(links, v, n[u])
                    roots = join_roots(roots, u, v)
            has = np.flatnonzero(links)
            if len(has):
                yield pa.RecordBatch.from_arrays([pa.array(rep[has]), pa.array(links[has]), pa.array(rep[roots[has]])], ["rep", "links", "reached"])

    return compare


def near_vectors(vectors: DataFrame, p: NearVectors = NearVectors()) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors(vec_id, embedding, ...).

    Two vectors are linked if their cosine in double precision is `cosine` or more; n_links counts the other rows
    linked with a row, copies included; component_id is the smallest vec_id that links reach. Equal vectors are one
    class with a count, so that copies are not compared. Blocks are compared by their coordinates alone; whole vectors
    travel only to the tiles where they have a partner within the block's budget, and are compared there. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows whose vec_id is null, link with nothing; vectors of different length neither.
    Rows with one vec_id are taken as copies of one vector if their components agree. Other columns are not read.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    whole = F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    valid = vectors.where(whole & F.col("vec_id").isNotNull())
    classes = saved(valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    dealt = saved(classes.mapInArrow(_deal(p), "dims int, block int, cell long, own boolean, rep long, part binary"))
    cells = dealt.groupBy("dims", "block", "cell").agg(F.ceil(F.count("*") / p.tile).cast("int").alias("of"))
    chunked = dealt.join(cells, ["dims", "block", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
    tiles = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("of", "other")
    dealt_out = lambda df: df.repartition(partitions(spark), *TILE).sortWithinPartitions(*TILE)
    near = saved(dealt_out(tiles).mapInArrow(_near(p), "dims int, block int, cell long, i int, j int, chunk int, own boolean, rep long"))
    found = saved(dealt_out(near.join(classes, "rep")).mapInArrow(_compare(p), "rep long, links long, reached long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("reached").alias("b"))).withColumnRenamed("id", "rep")
    of_class = classes.join(links, "rep", "left").join(reached, "rep", "left").select("embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component_id", "rep").alias("component_id"))
    linked = valid.join(of_class, "embedding").select("vec_id", F.col("links").alias("n_links"), "component_id")
    alone = vectors.where(~whole | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

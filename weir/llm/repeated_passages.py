"""Passages that occur more than once: super-k-mers of words, dealt by minimiser, windows counted by sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import U64, WordHashes, mix, partitions, runs, saved, shingles, words_of


@dataclass(frozen=True)
class Passages:
    """window: consecutive words judged together. inner: words of a minimiser.

    crowd: different super-k-mers that one bucket compares; a minimiser with more has its windows dealt one by one.
    """

    window: int = 35
    inner: int = 3
    crowd: int = 2000


_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 on 64 bits."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1024), U64(base), U64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def _spans(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each h[start:end], wherever it stands."""
    sums = np.zeros(len(h) + 1, U64)
    np.cumsum(h * _power(_ODD, len(h)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_BACK, len(h) + 1)[starts] + (ends - starts).astype(U64))


def _super_kmers(h: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser hash of each super-k-mer of a text's word hashes."""
    g = mix(shingles(h, p.inner))
    width = p.window - p.inner + 1
    at = np.arange(len(g) - width + 1)
    at = at + np.concatenate([np.lib.stride_tricks.sliding_window_view(g[k : k + 50_000 + width - 1], width).argmin(axis=1) for k in range(0, len(at), 50_000)])
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, len(at))), g[at[first]]


def _cut(p: Passages) -> Callable:
    """The super-k-mers of each text: minimiser, content hash, document, its text's hash, first window, number of windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for row, text in enumerate(batch.column("text")):
                h = hashes.of(words_of(text.as_py()))
                if len(h) < p.window:
                    continue
                first, n, low = _super_kmers(h, p)
                for o, x in zip(out, (low.view(np.int64), _spans(h, first, first + n + p.window - 1).view(np.int64), np.full(len(first), row), first, n), strict=True):
                    o.append(x)
            if out[0]:
                low, content, row, first, n = (np.concatenate(o) for o in out)
                own = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "own")]
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(content), *own, pa.array(first, pa.int32()), pa.array(n, pa.int32())], ["low", "content", "doc_id", "own", "first", "n"])

    return cut


def _pack(p: Passages) -> Callable:
    """The words of the wanted super-k-mers as packed strings; those of a crowded minimiser window by window."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, own, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "own")), batch.column("text"), batch.column("wanted"), strict=True):
                words = words_of(text.as_py())
                h = None
                for x in wanted.as_py():
                    first, n = x["first"], x["n"]
                    if first + n + p.window - 1 > len(words):
                        continue  # another row's
                    if x["crowded"]:
                        h = hashes.of(words) if h is None else h
                        starts = np.arange(first, first + n)
                        keys = _spans(h, starts, starts + p.window).view(np.int64).tolist()
                        rows += [(k, True, doc_id, own, s, 1, x["copies"], b" ".join(words[s : s + p.window])) for k, s in zip(keys, starts.tolist(), strict=True)]
                    else:
                        rows.append((x["low"], False, doc_id, own, first, n, x["copies"], b" ".join(words[first : first + n + p.window - 1])))
                    if len(rows) >= 20_000:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    return pack


_PACKED = pa.schema([("bucket", pa.int64()), ("single", pa.bool_()), ("doc_id", pa.int64()), ("own", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("copies", pa.int64()), ("packed", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKED, strict=True)], schema=_PACKED)


def _repeats(strings: list[bytes], p: Passages) -> tuple[np.ndarray, np.ndarray]:
    """String and offset of every window that two or more places in the strings hold, compared word by word."""
    ids: dict[bytes, int] = {}
    parts = [s.split() for s in strings]
    flat = np.fromiter((ids.setdefault(w, len(ids)) for s in parts for w in s), np.int64)
    n = np.array([len(s) for s in parts])
    at = np.concatenate([[0], np.cumsum(n)])
    string = np.repeat(np.arange(len(parts)), n - p.window + 1)
    offset = np.concatenate([np.arange(k - p.window + 1) for k in n])
    begin = at[string] + offset
    keys = _spans(mix(flat.astype(U64) + U64(1)), begin, begin + p.window)
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    windows = np.lib.stride_tricks.sliding_window_view(flat, p.window)
    same = np.concatenate([part[(windows[begin[order[part]]] == windows[begin[order[part + 1]]]).all(axis=1)] for part in np.array_split(same, len(same) // 50_000 + 1)])
    found = np.unique(np.concatenate([order[same], order[same + 1]]))
    return string[found], offset[found]


def _sort_count(p: Passages) -> Callable:
    """Windows of once-seen super-k-mers that other super-k-mers of their bucket hold too."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "own", "first", "n"])

    def sort_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for single, t in _groups(batches):
            if single:
                rows += t
            else:
                string, offset = _repeats(t.column("packed").to_pylist(), p)
                copies, docs, own, first = (t.column(c).to_pylist() for c in ("copies", "doc_id", "own", "first"))
                rows += [(docs[s], own[s], first[s] + o, 1) for s, o in zip(string.tolist(), offset.tolist(), strict=True) if copies[s] == 1]
            if len(rows) >= 20_000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)

    return sort_count


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object]]:
    """Tables of the buckets; of windows dealt one by one, the places of equal ones batch by batch, without gathering them."""
    before = None
    held: list[pa.RecordBatch] = []  # the last bucket's, which may go on in the next batch
    for batch in batches:
        places = []
        for r in batch.filter(batch.column("single")).to_pylist():
            key, place = (r["bucket"], r["packed"]), (r["doc_id"], r["own"], r["first"], 1)
            if before and before[0] == key:
                places += [*([before[1]] if before[1] else []), place]
                before = (key, None)
            else:
                before = (key, place)
        if places:
            yield True, places
        rest = batch.filter(pc.invert(batch.column("single")))
        if not rest.num_rows:
            continue
        tables = list(runs(iter([*held, rest]), ["bucket"]))
        for t in tables[:-1]:
            yield False, t
        held = tables[-1].to_batches()
    if held:
        yield False, pa.Table.from_batches(held)


def _keep(p: Passages, texts: bool) -> Callable:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha, kept_texts = [], [], [], []
            for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
                kept = words = words_of(text.as_py())
                if marks.is_valid:
                    m = np.array([(x["first"], x["n"]) for x in marks.as_py()])
                    m = m[m.sum(1) + p.window - 1 <= len(words)]  # the rest is another row's
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, m[:, 0], 1)
                    np.add.at(edges, m[:, 0] + m[:, 1] + p.window - 1, -1)
                    covered = np.cumsum(edges[:-1]) > 0
                    kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(joined).hexdigest())
                if texts:
                    kept_texts.append(joined.decode())
            made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), *([pa.array(kept_texts, pa.string())] if texts else [])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 1 + len(made)])

    return keep


def without_repeats(docs: DataFrame, p: Passages = Passages(), texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with `texts`, kept_text of every row of docs(doc_id, text, ...).

    A word is removed if a window of `window` words covers it whose words start in the same order at any other place,
    in this document or another. Windows are judged on the whole input. Super-k-mers whose content occurs again are
    marked whole; of each content one place travels as a packed string to its minimiser's bucket, and only if other
    contents have that minimiser. Null, empty and shorter texts lose nothing. Each row counts as a document of its own,
    also if its doc_id and text occur again. Rows are told apart by their doc_id and 64 bits of their texts' hashes, without a
    doc_id by 128, and each loses its own windows; a mark beyond a text's end is no mark. Other columns are not read.
    """
    spark = docs.sparkSession
    number = F.col("doc_id").cast("long")
    docs = docs.select(number.alias("id"), F.coalesce(number, F.xxhash64(F.lit("row"), "text")).alias("doc_id"), F.xxhash64("text").alias("own"), "text")
    kind = "doc_id long, own long, first int, n int"
    row = ["doc_id", "own"]

    def joined(few: DataFrame, how: str) -> DataFrame:
        on = (F.col("d.doc_id") == F.col("f.doc_id")) & (F.col("d.own") == F.col("f.own"))
        return docs.alias("d").join(few.alias("f"), on, how).select("d.*", *(f"f.{c}" for c in few.columns if c not in row))

    cut = saved(docs.mapInArrow(_cut(p), f"low long, content long, {kind}"))
    again = cut.groupBy("low").agg(F.count("*").alias("places")).where("places > 1").select("low")
    cut = saved(cut.join(again, "low"))
    contents = saved(cut.groupBy("low", "content").agg(F.count("*").alias("copies"), F.min(F.struct(*row, "first", "n")).alias("at")))
    whole = cut.join(contents.where("copies > 1").select("low", "content"), ["low", "content"]).select(*row, "first", "n")
    mixed = contents.groupBy("low").agg(F.count("*").alias("contents")).where("contents > 1")
    wanted = contents.join(mixed, "low").select("at.doc_id", "at.own", F.struct("low", "copies", "at.first", "at.n", (F.col("contents") > p.crowd).alias("crowded")).alias("x"))
    # A super-k-mer may repeat a window inside itself only if its minimiser occurs in it again, which makes two super-k-mers.
    wanted = wanted.groupBy(*row).agg(F.collect_list("x").alias("wanted"))
    packed = joined(wanted, "inner").mapInArrow(_pack(p), f"bucket long, single boolean, {kind}, copies long, packed binary")
    partly = packed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "single", "packed").mapInArrow(_sort_count(p), kind)
    marks = whole.unionByName(partly).groupBy(*row).agg(F.collect_list(F.struct("first", "n")).alias("marks"))
    return joined(marks, "left").mapInArrow(_keep(p, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts)

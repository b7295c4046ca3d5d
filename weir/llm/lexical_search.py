"""Ranked lexical search without an index: an automaton of all items' terms reads the documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of UTF-8: what is no part of a term becomes a blank, A-Z lower case.
_PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class LexicalSearch:
    """top: documents for an item. pairs: of items and their terms in one automaton, which is broadcast; where there are
    more, items are dealt into several, each with a scan of its own. cells: scores (documents x items) that a task holds
    at once. span: bytes of a text that are read at once.
    """

    top: int = 10
    pairs: int = 500_000
    cells: int = 500_000
    span: int = 1 << 20
    deals: int = 32


class Automaton:
    """Terms between blanks, and which items hold each how often: terms[k] is in items of[at[k]:at[k + 1]], times[...] times.

    Of a term over DEEP bytes the automaton holds the first ones; what follows a match of them is compared.
    """

    DEEP = 200

    def __init__(self, rows: list[tuple[int, str, int]]):
        """rows: (item, term, times)."""
        self.terms = {t: k for k, t in enumerate(sorted({t for _, t, _ in rows}))}
        self.search = ahocorasick.Automaton()
        self.long: list[list[tuple[str, int]]] = []  # by the first bytes
        for t, k in self.terms.items():
            key = f" {t.encode().decode('latin-1')} "  # a character a byte
            if len(key) <= self.DEEP:
                self.search.add_word(key, k)
            elif (group := self.search.get(start := key[: self.DEEP], None)) is None:
                self.long.append([(key, k)])
                self.search.add_word(start, -len(self.long))
            else:
                self.long[-group - 1].append((key, k))
        if self.terms:
            self.search.make_automaton()
        entries = np.array([(self.terms[t], item, times) for item, t, times in rows], np.int64).reshape(-1, 3)
        entries = entries[entries[:, 0].argsort(kind="stable")]
        self.at = np.searchsorted(entries[:, 0], np.arange(len(self.terms) + 1))
        self.of, self.times = entries[:, 1].copy(), entries[:, 2].copy()
        self.items = int(entries[:, 1].max()) + 1 if len(entries) else 0

    def _whole(self, part: str, end: int, k: int) -> list[int]:
        """The terms that a match stands for."""
        return [k] if k >= 0 else [term for key, term in self.long[-k - 1] if part.startswith(key, end + 1 - self.DEEP)]

    def count(self, text: bytes, span: int) -> tuple[int, Counter]:
        """The number of terms of a text, with repeats, and how often each term of the items occurs.

        Neighbours share a blank, and matches may overlap, so each occurrence is found once; long texts are cut at blanks.
        """
        text = text.translate(_PLAIN)
        n, found, a = len(text.split()), Counter(), 0
        while self.terms and a < len(text):
            b = len(text) if len(text) - a <= span else text.rfind(b" ", a, a + span)
            if b <= a:  # one term longer than a span, or a blank at its start
                b = text.find(b" ", a + 1)
                b = len(text) if b < 0 else b
            part = f" {text[a:b].decode('latin-1')} "
            if self.long:
                found.update(k for end, k in self.search.iter(part) for k in self._whole(part, end, k))
            else:
                found.update(map(itemgetter(1), self.search.iter(part)))
            a = b
        return n, found


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times); rows of one item_id are one item."""
    terms = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(terms).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def _measured(automaton: Broadcast, p: LexicalSearch) -> Callable:
    """(slot, value): documents that hold each term, and at -1 and -2 the documents with a term and all their terms."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton.value
        df, docs, length = np.zeros(len(a.terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n, found = a.count(text, p.span)
                docs, length = docs + (n > 0), length + n
                df[list(found)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, [-1, -2]).astype(np.int32)), pa.array(np.append(df[held], [docs, length]))], ["slot", "value"])

    return measured


class _Top:
    """The best documents of each item so far, by score and then by id (null last)."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, np.int64)
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """scores (document, item)."""
        d, i = np.nonzero((scores > 0) & (scores >= self.least))
        item, score, doc, null = np.append(self.item, i), np.append(self.score, scores[d, i]), np.append(self.doc, doc[d]), np.append(self.null, null[d])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.top]
        self.item, self.score, self.doc, self.null = item[place < self.top], score[order], doc[order], null[order]
        last = place[place < self.top] == self.top - 1
        self.least[self.item[last]] = self.score[last]


def _ranked(automaton: Broadcast, weights: np.ndarray, docs: int, length: int, p: LexicalSearch) -> Callable:
    """(item, doc_id, score) of the best documents of a task's share."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton.value
        best = _Top(a.items, p.top)
        block = max(1, p.cells // max(1, a.items))
        ids: list[int | None] = []
        rows: list[int] = []
        terms: list[int] = []
        tfs: list[int] = []
        ms: list[int] = []

        def flush() -> None:
            if not ids:
                return
            row, term, tf, m = (np.array(x, np.int64) for x in (rows, terms, tfs, ms))
            gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            n = a.at[term + 1] - a.at[term]
            entry = np.repeat(a.at[term], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            scores = np.zeros(len(ids) * a.items, np.int64)
            np.add.at(scores, np.repeat(row, n) * a.items + a.of[entry], np.repeat(gain, n) * a.times[entry])
            best.add(scores.reshape(len(ids), a.items), np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]))
            for x in (ids, rows, terms, tfs, ms):
                x.clear()

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                n, found = a.count(text, p.span)
                if not found:
                    continue
                rows += [len(ids)] * len(found)
                terms += found.keys()
                tfs += found.values()
                ids.append(doc)
                ms.append(100 - 75 + 75 * n * docs // length)
                if len(ids) >= block:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(best.item.astype(np.int32)), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score)], ["item", "doc_id", "score"])

    return ranked


def lexical_search(documents: DataFrame, items: DataFrame, p: LexicalSearch) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best documents by the sum of term weights, equal scores by doc_id.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), a document's share of it (10^9 tf) div (1000 tf + 8m) with
    m = 25 + (75 n N) div L; N counts documents with a term, L their terms, n one document's, all in whole numbers.

    The documents are scanned twice, once for N, L and df, once for the scores; only sums and each task's best rows
    leave a scan. A null or empty text has no terms: such a document counts in nothing, such an item is in no result,
    and neither is one whose terms no document holds. Rows of one doc_id are documents each, rows of one item_id
    (or of none) are one item. A doc_id of null comes last among equal scores. Other columns are passed over.
    """
    spark = documents.sparkSession
    pairs = saved(item_terms(items))
    number = max(1, -(-pairs.count() // p.pairs))
    docs = documents.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found: DataFrame | None = None
    for k in range(number):
        # about p.pairs rows, whatever the number of items; an item is not cut
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(number)) == k).collect()
        ids = sorted({r.item_id for r in own}, key=lambda i: (i is None, i))
        place = {i: n for n, i in enumerate(ids)}
        automaton = Automaton([(place[r.item_id], r.term, r.times) for r in own])
        sent = spark.sparkContext.broadcast(automaton)
        sums = {r.slot: r.value for r in docs.select("text").mapInArrow(_measured(sent, p), "slot int, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect()}
        n, length = sums.get(-1, 0), sums.get(-2, 0)
        weights = np.array([int(np.floor(1000 * np.log((2 * n + 2) / (2 * sums.get(t, 0) + 1)))) for t in range(len(automaton.terms))], np.int64)
        rows = docs.mapInArrow(_ranked(sent, weights, n, length, p), "item int, doc_id long, score long")
        order = (F.desc("score"), F.asc_nulls_last("doc_id"))
        # tasks' best rows meet in a few deals first, then each item's in one
        few = rows.withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(p.deals))).withColumn("rank", F.row_number().over(Window.partitionBy("item", "deal").orderBy(*order))).where(F.col("rank") <= p.top)
        last = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= p.top)
        names = spark.createDataFrame([(n, i) for n, i in enumerate(ids)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # as many names as the automaton has items
        if number > 1:
            part = saved(part)
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found

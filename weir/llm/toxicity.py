"""Toxicity: a learned lexicon of terms and stems, matched with spelling errors by Levenshtein automata on its trie, weighed in context."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.boosting import logistic, sigmoid
from weir.llm.common import U64, mix, partitions, saved, smallest


@dataclass(frozen=True)
class Toxicity:
    """sample: labelled documents, at most, from which lexicon and weights are learned.

    terms: entries of the lexicon, at most, those of the highest odds; entries under a stem are none. least: toxic texts
    of the sample that must hold an entry; copies count once, so that words of one copied text don't pass.
    precision: share of an entry's documents that must be toxic. shared: of a stem's toxic texts, the share with which a
    longer stem or a word takes its place. window: words on each side that make a context.
    """

    sample: int = 20_000
    terms: int = 2000
    least: int = 4
    precision: float = 0.9
    shared: float = 0.9
    window: int = 8
    threshold: float = 0.3


STEM = (4, 7)  # letters of a stem: a beginning that toxic words share
EDGE = re.compile(r"^\W+|\W+$")
QUOTES = frozenset("\"“”„«»‘’")
REPORTS = frozenset("said says wrote writes called quoted reported quote term word insult slur".split())
ADDRESS = frozenset("you your youre you're u ur yourself du dich dein dir tu toi ton te vous votre usted tus eres".split())


def plain(word: str) -> str:
    return EDGE.sub("", word).lower()


def _shortened(word: str, errors: int) -> set[str]:
    """The word without up to so many letters."""
    out = last = {word}
    for _ in range(errors):
        last = {x[:k] + x[k + 1 :] for x in last for k in range(len(x))}
        out = out | last
    return out


BASE = U64(0x9E3779B97F4A7C15)


def _hashes(codes: np.ndarray, errors: int) -> list[np.ndarray]:
    """For words of one length, rows of code points: polynomial hashes of the word, then of it without one letter, without two."""
    m, n = codes.shape
    power = np.full(n + 1, BASE, U64)  # BASE ** k
    power[0] = U64(1)
    power = np.cumprod(power, dtype=U64)
    value = mix(codes.astype(U64) + U64(1))
    begin, end = np.zeros((m, n + 1), U64), np.zeros((m, n + 1), U64)  # of the first k letters, of those from k on
    for k in range(n):
        begin[:, k + 1] = begin[:, k] * BASE + value[:, k]
        end[:, n - 1 - k] = end[:, n - k] + value[:, n - 1 - k] * power[k]
    out = [begin[:, n:]]
    if errors > 0 and n > 0:
        one = begin[:, :n] * power[n - 1 :: -1][:n] + end[:, 1:]
        out.append(one)
        if errors > 1 and n > 1:
            gone = (begin[:, : n - 1] - begin[:, 1:n]) * power[: n - 1][::-1]
            i, j = np.triu_indices(n, 1)
            out.append(gone[:, i] + one[:, j])
    return out


class Neighbours:
    """The strings that terms leave after as many deletions as they allow errors, as hashes behind a table of their first bits."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.longest = max((len(t) + e for t, e in terms.items()), default=-1)
        self.shortest = [min((len(t) - e for t, e in terms.items() if e >= k), default=1 << 30) for k in range(3)]
        self.known, self.table, self.shift = [], [], []
        for k in range(3):  # what a word without k letters may be
            left = {x for t, e in terms.items() if e >= k for x in _shortened(t, e)}
            known = np.unique(np.concatenate([np.zeros(0, U64), *(_hashes(_codes(g, n), 0)[0].ravel() for n, g in _by_length(left))]))
            bits = min(24, max(12, 5 + len(known).bit_length()))  # few hashes of other words find a bit set
            table = np.zeros(1 << bits, bool)
            table[known >> U64(64 - bits)] = True
            self.known.append(known)
            self.table.append(table)
            self.shift.append(U64(64 - bits))

    def of(self, words: Iterable[str]) -> set[str]:
        """Those of the words that share a string with a term after as many deletions as it allows errors, or, rarely, its hash."""
        out: set[str] = set()
        for n, group in _by_length(words):
            if n > self.longest:
                continue
            errors = max((k for k in (1, 2) if n >= self.shortest[k]), default=0)
            for at in range(0, len(group), 8192):
                part = group[at : at + 8192]
                for k, h in enumerate(_hashes(_codes(part, n), errors)):
                    row, column = np.nonzero(self.table[k][h >> self.shift[k]])
                    there, known = h[row, column], self.known[k]
                    same = known[np.minimum(np.searchsorted(known, there), max(len(known) - 1, 0))] == there if len(known) else np.zeros(0, int)
                    out.update(part[r] for r in row[same].tolist())
        return out


def _by_length(words: Iterable[str]) -> list[tuple[int, list[str]]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return sorted(out.items())


def _codes(words: list[str], n: int) -> np.ndarray:
    """Code points of words of n letters."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)


Entry = tuple[str, bool]  # a term, and whether it is a stem
Found = tuple[float, int, Entry]  # weight, errors, what was found


def errors_by_length(n: int) -> int:
    return 0 if n < 5 else 1 if n < 9 else 2


class Automaton:
    """The lexicon's trie walked by all Levenshtein automata at once; sets of states are numbered as they are met.

    A state is (node, errors). Terms and stems of five letters or more allow one error, of nine or more two, or fewer
    where `errors` says so; a stem's errors are in its own letters, after which it accepts any ending. The walk grows
    with the lexicon: a word that shares no string with a term, and of which no beginning does with a stem, after as many
    deletions as they allow errors is within nobody's errors, and skips it (Neighbours).
    """

    BOUND = 200_000

    def __init__(self, words: dict[str, float], stems: dict[str, float], errors: dict[Entry, int] | None = None) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.end: list[tuple[float, Entry] | None] = [None]
        self.allow = [0]
        self.most: dict[int, int] = {}  # errors of the term that ends at a node; a longer one through it may allow more
        allowed = {(t, stem): (errors or {}).get((t, stem), errors_by_length(len(t))) for some, stem in ((stems, True), (words, False)) for t in some}
        for (term, stem), most in sorted(allowed.items(), key=lambda x: (not x[0][1], x[0])):  # stems first
            node = 0
            self.allow[0] = max(self.allow[0], most)
            for c in term:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    self.end.append(None)
                    self.allow.append(0)
                self.allow[node] = max(self.allow[node], most)
            if stem or not self.end[node]:
                self.end[node] = ((stems if stem else words)[term], (term, stem))
                self.most[node] = most
        self.near = Neighbours({t: e for (t, stem), e in allowed.items() if not stem})
        loose = {t: e for (t, stem), e in allowed.items() if stem and e}
        self.near_stems = Neighbours(loose)
        self.beginnings = range(min((len(t) - e for t, e in loose.items()), default=0), max((len(t) + e for t, e in loose.items()), default=-1) + 1)
        self.stems = stems
        self.lengths = sorted({len(x) for x in stems})
        self._reset()

    def _reset(self) -> None:
        self.sets: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.begun: list[tuple[int, float, Entry] | None] = []
        self.start = self._id(self._closed({(0, 0)}))

    def _closed(self, states: set) -> frozenset:
        """With the states that a missing letter reaches; of one node, the fewest errors."""
        best: dict[int, int] = {}
        todo = list(states)
        while todo:
            node, e = todo.pop()
            if e > self.allow[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            if e < self.allow[node]:
                todo += [(n, e + 1) for n in self.next[node].values() if e < self.allow[n]]
        return frozenset(best.items())

    def _id(self, states: frozenset) -> int:
        if states not in self.number:
            self.number[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.begun.append(min(self._ends(states, True), default=None))
        return self.number[states]

    def _ends(self, states: frozenset, stem: bool) -> list[tuple[int, float, Entry]]:
        """Errors, weight negated, and entry of the terms or stems that end in one of the states."""
        return [(e, -end[0], end[1]) for node, e in states if (end := self.end[node]) and end[1][1] is stem and e <= self.most[node]]

    def _step(self, at: int, c: str) -> int:
        out = set()
        for node, e in self.sets[at]:
            if (n := self.next[node].get(c)) is not None:
                out.add((n, e))
            if e < self.allow[node]:  # no node allows more errors than one on the way to it
                out.update((n, e + 1) for n in self.next[node].values() if e < self.allow[n])
                out.add((node, e + 1))  # a letter too many
        to = self.moves[at][c] = self._id(self._closed(out))
        return to

    def match_all(self, words: set[str]) -> dict[str, Found | None]:
        """For each word weight, errors and entry of the best that accepts it: of fewest errors, a whole term rather than a stem."""
        near = self.near.of(words)
        begun = self.near_stems.of({w[:n] for n in self.beginnings for w in words if len(w) >= n}) if self.beginnings else set()
        close = lambda w: w in near or any(w[:n] in begun for n in self.beginnings)
        return {w: self._walk(w) if close(w) else self._stem(w) for w in words}

    def match(self, word: str) -> Found | None:
        return self.match_all({word})[word]

    def _stem(self, word: str) -> Found | None:
        return next(((self.stems[word[:n]], 0, (word[:n], True)) for n in self.lengths if word[:n] in self.stems), None)

    def _walk(self, word: str) -> Found | None:
        if len(self.sets) > self.BOUND:
            self._reset()
        at, stem = self.start, self.begun[self.start]
        for c in word:
            to = self.moves[at].get(c)
            at = self._step(at, c) if to is None else to
            if not self.sets[at]:
                break
            if (begun := self.begun[at]) and (stem is None or begun < stem):
                stem = begun
        found = [(e, False, w, entry) for e, w, entry in self._ends(self.sets[at], False)]
        if stem:
            found.append((stem[0], True, *stem[1:]))
        if not found:
            return None
        e, _, weight, entry = min(found)
        return -weight, e, entry


class Matches(dict):
    """What the automaton says of a raw word, remembered up to a bound."""

    BOUND = 300_000

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def learn(self, raw: set[str]) -> None:
        """Matches the words that are not known, all at once."""
        if len(self) > self.BOUND:
            self.clear()
        new = {w: plain(w) for w in raw if w not in self}
        found = self.automaton.match_all(set(new.values()))
        self.update((w, found[x]) for w, x in new.items())

    def __missing__(self, raw: str) -> Found | None:
        self.learn({raw})
        return self[raw]


SPLIT = re.compile(r"[\x20\x09-\x0D]+")
N_FEATURES = 8


def all_features(texts: Iterable[str], matches: Matches, p: Toxicity, some: int = 1_000_000) -> Iterator[list[float]]:
    """The features of each text; the words of so many characters of texts are matched at once."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= some:
            yield from _features_of(held, matches, p)
            held, size = [], 0
    yield from _features_of(held, matches, p)


def _features_of(texts: list[str], matches: Matches, p: Toxicity) -> Iterator[list[float]]:
    matches.learn({w for t in texts for w in SPLIT.split(t)})
    return (features(t, matches, p) for t in texts)


def features(text: str, matches: Matches, p: Toxicity) -> list[float]:
    """A term with errors counts as the term itself, so that a misspelling doesn't lower a score."""
    words = SPLIT.split(text)
    found = [(k, m) for k, m in enumerate(map(matches.__getitem__, words)) if m]
    if not found:
        return [0.0] * N_FEATURES
    by, weight, quoted, direct = [0, 0], 0.0, 0.0, 0.0
    for k, (w, _, (_, stem)) in found:
        by[stem] += 1
        around = words[max(0, k - p.window) : k + p.window + 1]
        q = any(QUOTES & set(x) for x in around) or not REPORTS.isdisjoint(map(plain, around))
        weight += w
        quoted += w * q
        direct += w * (not q) * (1 + (not ADDRESS.isdisjoint(map(plain, around))))
    different = len({entry for _, (_, _, entry) in found})
    return [1.0, *(np.log1p(b) for b in by), np.log1p(weight), np.log1p(quoted), np.log1p(direct), np.log1p(different), 100 * len(found) / len(words)]


def _entries(word: str) -> list[str]:
    """A word as itself and, with a star, as its beginnings."""
    return [word, *(word[:n] + "*" for n in range(STEM[0], min(STEM[1], len(word) - 1) + 1))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry: documents with it, toxic and not."""
    toxic, clean = Counter(), Counter()

    def out() -> pa.RecordBatch:
        keys = list(toxic | clean)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], ["entry", "toxic", "clean"])

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            into = toxic if label else clean
            into.update({e for w in {plain(x) for x in SPLIT.split(text.as_py() or "")} if w for e in _entries(w)})
            if len(toxic) + len(clean) > 2_000_000:
                yield out()
                toxic.clear()
                clean.clear()
    yield out()


@dataclass
class Model:
    """errors: what entries allow, where that is less than their length would."""

    words: dict[str, float]
    stems: dict[str, float]
    weights: np.ndarray
    errors: dict[Entry, int]

    def matches(self) -> Matches:
        """Built once in a process that holds this model, whatever the number of its tasks."""
        if not hasattr(self, "_matches"):
            self._matches = Matches(Automaton(self.words, self.stems, self.errors))
        return self._matches

    def scores(self, texts: Iterable[str], p: Toxicity) -> np.ndarray:
        x = np.array(list(all_features(texts, self.matches(), p))).reshape(-1, N_FEATURES)
        return sigmoid(self.weights[0] + x @ self.weights[1:])


def _misspelt(matches: Callable[[], Matches]) -> Callable:
    """For each entry and number of errors: documents with a word that it accepts with so many, toxic and not."""

    def misspelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = matches(), Counter()
        for batch in batches:
            words = [set(SPLIT.split(t.as_py() or "")) for t in batch.column("text")]
            m.learn(set().union(*words))
            for some, label in zip(words, batch.column("toxic").to_pylist(), strict=True):
                seen.update({(*found[2], found[1], bool(label)) for w in some if (found := m[w]) and found[1]})
        yield pa.RecordBatch.from_pylist([{"term": t, "stem": s, "errors": e, "toxic": n * label, "clean": n * (not label)} for (t, s, e, label), n in seen.items()], pa.schema([("term", pa.string()), ("stem", pa.bool_()), ("errors", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())]))

    return misspelt


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> Model:
    """Learns from at most `sample` labelled rows that are not held out, those whose doc_id has the smallest hash."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = smallest(known, p.sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # a bound of `sample` pairs of numbers
    texts = saved(texts.select(F.coalesce("text", F.lit("")).alias("text"), "toxic").dropDuplicates().repartition(partitions(docs.sparkSession)))
    n = texts.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    if not n.n or not n.t or n.t == n.n:
        share = float(n.t / n.n) if n.n else 0.0
        return Model({}, {}, np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), *[0.0] * N_FEATURES]), {})
    counted = texts.mapInArrow(_count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    balance = (n.n - n.t) / n.t  # entries are judged as if either class had as many documents
    share = F.col("toxic") * balance / (F.col("toxic") * balance + F.col("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n.t + 1) / ((F.col("clean") + 0.5) / (n.n - n.t + 1)))
    is_stem = F.col("entry").endswith("*")
    good = counted.where((F.col("toxic") >= p.least * F.when(is_stem, 2).otherwise(1)) & (share >= p.precision) & (F.col("toxic") > F.col("clean")) & (F.length("entry") > 2)).withColumn("odds", odds)
    good = saved(good.select("entry", "odds", "toxic", F.regexp_replace("entry", r"\*$", "").alias("own")))
    begins = F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[1])), lambda k: F.when(k < F.length("own"), F.substring(F.col("own"), F.lit(1), k)))
    stem = good.where(is_stem).select(F.col("own").alias("begin"), F.col("toxic").alias("begin_toxic"))
    under = saved(good.withColumn("begin", F.explode(begins)).join(stem, "begin"))
    # a stem accepts what is under it; where one entry has nearly all of its texts, that is what they share, and longer, so that it allows errors
    longest = F.struct(F.length("own"), ~is_stem, "toxic", "entry")
    shared = under.where(F.col("toxic") >= p.shared * F.col("begin_toxic")).groupBy(F.concat("begin", F.lit("*")).alias("entry")).agg(F.max_by(F.struct("entry", "odds", "own"), longest).alias("x"))
    roots = good.join(under.select("entry").distinct(), "entry", "left_anti").join(shared, "entry", "left")
    rows = roots.select(F.coalesce("x", F.struct("entry", "odds", "own")).alias("x")).select("x.*").distinct().orderBy(F.desc("odds"), "entry").limit(p.terms).collect()
    stems = {r.own: float(r.odds) for r in rows if r.entry.endswith("*")}
    words = {r.own: float(r.odds) for r in rows if not r.entry.endswith("*")}
    # errors that clean texts of the sample show too often are not allowed; a row for each entry and number of errors at most
    loose = Model(words, stems, np.zeros(N_FEATURES + 1), {})
    seen = texts.mapInArrow(_misspelt(loose.matches), "term string, stem boolean, errors int, toxic long, clean long").groupBy("term", "stem", "errors").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()
    errors: dict[Entry, int] = {}
    for r in seen:
        if r.toxic * balance < p.precision * (r.toxic * balance + r.clean):
            errors[r.term, r.stem] = min(errors.get((r.term, r.stem), 9), r.errors - 1)
    model = Model(words, stems, np.zeros(N_FEATURES + 1), errors)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = list(all_features((t.as_py() or "" for t in batch.column("text")), model.matches(), p))
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.float64())), batch.column("toxic")], ["f", "toxic"])

    rows = sorted(texts.mapInArrow(rows_of, "f array<double>, toxic int").collect())  # `sample` rows of numbers at most
    model.weights = logistic(np.array([r.f for r in rows]), np.array([r.toxic for r in rows], float))
    return model


def _score(model, p: Toxicity) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.scores((t.as_py() or "" for t in batch.column("text")), p))], ["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs(doc_id, text, ...).

    held_out: crc32 of the doc_id as text leaves 2 modulo 4; such rows' labels are never read. Only the text is
    scored. Null and empty texts get the score of a text without any term. Without labels of both classes the score
    is the share of toxic labels. A null doc_id counts as not held out. Rows are mapped one to one.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, p))
    scored = docs.select("doc_id", "text").mapInArrow(_score(model, p), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"))

"""Personal data: spans by fixed formats, and candidates of high-recall generators that boosted trees accept."""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.boosting import Boosted, Splits, binned, cuts_of, grow
from weir.llm.common import forget, saved

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Each pattern is written so that its leftmost matches are those of the plain format, in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """Only an @ can end the first part, which holds no @ itself: what stands before each @ is looked at once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (text[start - 1] in LOCAL_CHARS):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ANY_DIGIT = re.compile("[0-9]")


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of the fixed formats, leftmost and not overlapping within a kind; matches that fail a check go."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    out["email"] = _emails(text)
    if ANY_DIGIT.search(text):
        out["ip"] = [m.span() for m in IP.finditer(text) if all(len(n := x.lstrip("0")) <= 3 and int(n or "0") <= 255 for x in m.group().split("."))]
        for m in CARD.finditer(text):
            if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# Generators of candidates: wide, and overlapping on purpose.
_AT, _DOT = r"(?:[@＠]|[(\[{<] ?at ?[)\]}>]|_at_)", r"(?:[.。]|[(\[{<] ?(?:dot|\.) ?[)\]}>]|_dot_)"
WIDE = {
    "email": re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}}?(?: ?{_AT} ?[\w-]{{1,63}}?(?: ?{_DOT} ?[\w-]{{1,63}}?){{1,5}}(?![\w-])| at [\w-]{{1,63}}(?: dot [\w-]{{1,63}}){{1,5}})", re.IGNORECASE),
    "ip": re.compile(rf"(?<![\w:.])(?:[0-9]{{1,3}}(?: ?{_DOT} ?[0-9]{{1,3}}){{3}}|[0-9]{{1,3}}(?: dot [0-9]{{1,3}}){{3}}|(?:::)?[0-9A-Fa-f]{{1,4}}(?::{{1,2}}[0-9A-Fa-f]{{1,4}}){{1,7}})(?![\w:])", re.IGNORECASE),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,3}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00|\()?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9])"),
}
HINTS = re.compile(r"\b(?:e-?mail|mail|write|call|phone|tel|mobile|fax|contact|reach|dial|ring|text|whatsapp|card|visa|master|amex|pay|host|server|address|ping|ip)\w*", re.IGNORECASE)
SECRETS = re.compile(r"[=\"'_#$/]$|(?:key|token|password|version|isbn|id|no\.?)\W*$", re.IGNORECASE)
LABELS = re.compile(r"(?:order|part|item|invoice|ref|reference|serial|sku|model|case|ticket|batch|lot|article|section|page|pp|figure|fig|table|no|nr|number|lat|lon|coordinates|at|near|of|from|dated|on)\.?\W*$", re.IGNORECASE)


AT = re.compile(_AT + "| dot ", re.IGNORECASE)
DOT = re.compile(rf" ?{_DOT} ?|(?<=\w) dot (?=\w)", re.IGNORECASE)


def candidates(text: str) -> list[tuple[str, int, int]]:
    wide = (["email"] if AT.search(text) else []) + (["ip", "card", "phone"] if ANY_DIGIT.search(text) else [])
    return [(k, *m.span()) for k in wide for m in WIDE[k].finditer(text)]


def _is_ip(s: str) -> bool:
    """Of either version, whatever its dots look like."""
    parts = DOT.split(s)
    if len(parts) == 4 and ":" not in s:
        return all(x.isdecimal() and int(x) <= 255 for x in parts)
    try:
        return ipaddress.ip_address(s).version == 6
    except ValueError:
        return False


def _last_label(s: str) -> str:
    return DOT.split(s)[-1]


def _rough(n: int) -> int:
    """Its first three digits, so that few different numbers are left."""
    unit = 10 ** max(0, len(str(n)) - 3)
    return n // unit * unit


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    """Looks, checks and context of a candidate, whole numbers all. A sign that only the fixed formats ask for, the + of a phone, is none of them."""
    s, before, after = text[a:b], text[max(0, a - 30) : a], text[b : b + 12]
    d = _digits(s)
    groups = re.findall("[0-9]+", s)
    last = _last_label(s) if kind == "email" else ""
    return [
        KINDS.index(kind), len(s.lstrip("+")), len(d), float(luhn(d)) if d else 0, float(13 <= len(d) <= 19 and luhn(d)), sum(c in " -" for c in s), s.count("."), s.count("("), s.count(":"),
        len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), _rough(max((int(g[:9]) for g in groups), default=0)), float(_is_ip(s)) if kind == "ip" else 0, sum(c.isalpha() for c in s),
        float(bool(HINTS.search(before))), float(bool(SECRETS.search(before))), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(s.lstrip("+")[:1] in "23456"), len(set(d)),
        len(groups[-1]) if groups else 0, len(groups[0]) if groups else 0, float(bool(re.match("[ .,:-]{0,2}[0-9]", after))), float(bool(re.search("[0-9][ .,:-]{0,2}$", before))),
        float(last.isalpha() and last.islower() and 2 <= len(last) <= 24), float(bool(re.search(r"\w\. \w", s))), float("dot" in s.lower()),
        float(bool(LABELS.search(before))), float(bool(re.match(r"[^@＠ (\[{<]*[0-9._+-]", s))) if kind == "email" else 0, float(bool(re.search(r" at ", s, re.IGNORECASE))),
        float(bool(re.fullmatch(r"[0-9]{1,3}\.[0-9]{3,}[ ,]+-?[0-9]{1,3}\.[0-9]{3,}", s))), float(s[:1] in "+(" or s[:2] == "00" or s[:1] == "0"), float(len(groups) == 3 and len(groups[2]) == 4 and len(groups[0]) == len(groups[1]) == 3),
    ]


# Values that the trees learn from, put into the table's own texts: personal data in forms that the fixed formats
# don't have, and decoys of like looks.
def _value(kind: str, rng: random.Random) -> str:
    some = lambda n: f"{rng.randrange(10**n):0{n}}"
    if kind == "email":
        return f"{rng.choice(['jo', 'ann.lee', 'm_roth', 'k.o', 'sam'])}{rng.choice(['', some(2)])}@{rng.choice(['mail', 'uni-x', 'post', 'abc'])}{rng.choice(['', some(1)])}.{rng.choice(['com', 'org', 'de', 'co.uk', 'example.net'])}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        d = rng.choice("23456") + some(14)
        return next(d + c for c in "0123456789" if luhn(d + c))
    return f"+{rng.choice(['1', '44', '49', '33'])} ({rng.choice('23456789')}{some(2)}) {some(3)}-{some(4)}"


def _grouped(d: str, rng: random.Random) -> str:
    return rng.choice([".", "  ", ". ", "- "]).join(d[k : k + 4] for k in range(0, len(d), 4))


def unformatted(kind: str, s: str, rng: random.Random) -> list[str]:
    """A base span of a kind in the forms that its fixed format misses."""
    d = _digits(s)
    if kind == "email":
        local, _, domain = s.partition("@")
        signs = [(" (at) ", "."), (" [at] ", "."), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), (" at ", " dot "), (" AT ", " DOT "), (" @ ", " . "), ("{at}", "{dot}"), ("_at_", "_dot_"), ("＠", "."), (" <at> ", " <dot> "), ("@", " (dot) "), (" {at} ", ".")]
        return [local + at + domain.replace(".", dot) for at, dot in signs]
    if kind == "ip":
        groups = [f"{rng.randrange(1, 65536):x}" for _ in range(8)]
        k = rng.randrange(1, 5)
        six = [":".join(groups), ":".join(groups[:k]) + "::" + ":".join(groups[5:]), "fe80::" + ":".join(groups[4:]), "2001:db8::" + groups[0], "::1" if k == 1 else ":".join(groups[:2]) + "::" + groups[2]]
        return [x for pair in zip([dot.join(s.split(".")) for dot in (" . ", "[.]", "(dot)", "[dot]", " dot ")], six, strict=True) for x in pair]
    if kind == "card":
        fours = [d[k : k + 4] for k in range(0, len(d), 4)]
        return [sep.join(fours) for sep in (".", "  ", ". ", "- ", "/", " - ", "_")] + [sep.join([d[:4], d[4:10], d[10:]]) for sep in (".", "/")]
    country, own = d[:-10], d[-10:]
    a, b, c = own[:3], own[3:6], own[6:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{country} ({a}) {b}-{c}", f"00{country} {a} {b} {c}", f"{a}.{b}.{c}", f"0{a} {b}{c}", f"call {own}", f"{a} {b} {c}", f"tel: {own}", f"00{country}-{a}-{b}-{c}", f"0{a}/{b}{c}", f"({a}){b}-{c}", f"phone {a} {b}{c}", f"0{a}-{b} {c}", f"({country}) {a} {b} {c}"]


def decoys(kind: str, text: str, rng: random.Random) -> list[str]:
    """What a kind's generator may offer and is none of it; sentences are of the text's own words."""
    some = lambda n: f"{rng.randrange(10**n):0{n}}"
    day = f"{rng.randrange(1950, 2040)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
    clock = f"{rng.randrange(24):02}:{rng.randrange(60):02}"
    if kind == "email":
        words = re.findall(r"[^\W\d_]+", text[:2000]) or ["there"]
        w = [rng.choice(words) for _ in range(6)]
        return [f"{w[0]} (at) {w[1]}. {w[2]} {w[3]}", f"{w[0]} @ {w[1]}. {w[2]}", f"{w[0]} at {w[1]} dot {w[2]}", f"(see p. 3) @ {w[0]}. {w[1]}", "5 @ 3.50", f"{w[0]} {w[1]} at {w[2]} dot com", f"{w[0]} was at {w[1]} dot {some(1)}", f"{w[0]} @ 12.99", f"{w[0]} at the dot {w[1]}", f"seen [at] {w[0]}. {w[1]}", f"{w[0]} at {w[1]} dot then", f"{w[0]} {{at}} {w[1]}. {w[2]}"]
    if kind == "ip":
        return [f"{rng.randrange(256, 999)}.{some(2)}.{some(1)}.{some(3)}", f"{some(1)} . {rng.randrange(256, 999)} . {some(2)} . {some(1)}", f"{clock}:{some(2)}", clock, f"{clock}:{some(2)}:{some(2)}", ":".join(f"{rng.randrange(256):02x}" for _ in range(6)), f"{some(1)}:{some(2)}:{some(2)}", f"version {rng.randrange(256, 999)} dot {some(1)} dot {some(1)} dot {some(1)}"]
    if kind == "card":
        d = _value("card", rng)
        k = rng.randrange(16)
        d = d[:k] + str((int(d[k]) + rng.randrange(1, 9)) % 10) + d[k + 1 :]
        while luhn(d):
            d = some(16)
        return [d, _grouped(d, rng), f"{day} {clock.replace(':', '.')} {day}", "/".join(d[k : k + 4] for k in range(0, 16, 4)), f"{some(4)}-{some(4)} {some(4)}-{some(4)}"[:17]]
    label = rng.choice(["order", "part no.", "item", "invoice", "ref", "serial", "ticket", "article", "case", "lot"])
    point = lambda: f"{rng.randrange(90)}.{some(rng.randrange(3, 7))}"
    return [
        f"{label} {some(5)}-{some(5)}", f"{point()} {point()}", f"{label} {some(4)}-{some(4)}-{some(4)}", day, f"{label} {some(3)}-{some(3)}-{some(4)}", f"{point()}, {point()}",
        f"{day} {clock}", f"978-{some(1)}-{some(2)}-{some(6)}-{some(1)}", f"{label} {some(2)}.{some(3)}.{some(3)}", some(rng.randrange(7, 13)), f"{day[8:]}.{day[5:7]}.{day[:4]} {clock}", f"{day} {day}",
        f"{some(1)}.{some(rng.randrange(6, 12))}", f"{day[:4]}-{day[:4]} {some(4)}", f"a{some(9)}f", f"{some(2)} {some(3)} {some(3)}", f"id {some(10)}", f"{day[:4]}/{day[5:7]}/{day[8:]} {some(4)}", " ".join([some(1), some(2), some(3), some(1), some(2)]),
    ]


@dataclass(frozen=True)
class Redaction:
    """The trees learn from all documents; a fifth of them, chosen by doc_id, set the thresholds, with forms of values and
    decoys that the others don't have.

    precision: share of right spans that a kind's threshold must reach on the documents kept for it, base spans aside.
    few: different binned examples, at most, whose sums the driver makes; those of more are made by tasks and are the same.
    """

    precision: float = 0.95
    few: int = 50_000


def _seed(doc_id: int | None, text: str) -> int:
    return zlib.crc32(text.encode()) if doc_id is None else doc_id


def _kept_aside(seed: int) -> bool:
    return seed % 5 == 0


def _covered(spans: dict[str, list[Span]]) -> list[Span]:
    """Where any span lies: sorted, apart from each other."""
    out: list[Span] = []
    for a, b in sorted(s for own in spans.values() for s in own):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _overlaps(apart: list[Span], a: int, b: int) -> bool:
    """Of sorted spans that don't overlap each other, only the neighbours can overlap (a, b), or those that begin in it."""
    k = bisect_left(apart, (a, -1))
    return (k > 0 and apart[k - 1][1] > a) or (k < len(apart) and apart[k][0] < b)


def _is_wrong(text: str, kind: str, a: int, b: int) -> bool:
    """A candidate that a check or its surroundings refute; those that nothing refutes stay unlabelled."""
    s, before, after = text[a:b], text[max(0, a - 30) : a], text[b : b + 1]
    d = _digits(s)
    if before[-1:].isalnum() or after.isalnum():
        return True
    if kind == "email":
        return not _last_label(s).isalpha()
    if kind == "ip":
        return not _is_ip(s)
    if kind == "card":
        return not (13 <= len(d) <= 19 and luhn(d))
    return s == d and not HINTS.search(before)


def _planted(text: str, kind: str, s: str, right: bool, rng: random.Random) -> list[tuple]:
    """(kind, label, features) of the candidates that overlap s, put between two words of the text."""
    at = text.find(" ", rng.randrange(len(text) + 1))
    before, after = (text[max(0, at - 40) : at + 1], text[at : at + 40]) if at >= 0 else (text[-40:] + " ", "")
    lead = re.match("(?:call|tel:|phone) (?=[0-9])", s) if kind == "phone" else None  # context, and not of the span
    a, b = len(before) + (lead.end() if lead else 0), len(before) + len(s)
    whole = before + s + after
    near = [c for c in candidates(whole) if c[1] < b and a < c[2]]
    return [(c[0], float(right and c == (kind, a, b)), features(whole, *c)) for c in near if not right or c[0] != kind or c == (kind, a, b)]


def _labelled(doc_id: int | None, text: str) -> Iterator[tuple]:
    """(right, kept aside, base, features) of candidates. Right: base spans, and base spans or made-up values in forms that
    the formats miss, put into the text. Wrong: decoys put into the text, and candidates that overlap no base span and
    that a check refutes."""
    seed = _seed(doc_id, text)
    aside, rng = _kept_aside(seed), random.Random(seed)
    base = base_spans(text)
    every = _covered(base)
    for kind, a, b in candidates(text):
        if (a, b) in base[kind]:
            yield True, aside, True, features(text, kind, a, b)
        elif not _overlaps(every, a, b) and _is_wrong(text, kind, a, b):
            yield False, aside, False, features(text, kind, a, b)
    own = [(k, text[a:b]) for k in KINDS for a, b in base[k]] or [(k, _value(k, rng)) for k in (rng.choice(KINDS),)]
    kind, s = rng.choice(own)
    if kind == "phone" and len(_digits(s)) < 11:
        s = _value(kind, rng)
    # every third form is for the thresholds alone
    mine = lambda forms: rng.choice([f for n, f in enumerate(forms) if (n % 3 == 2) == aside])
    for s, right in ((mine(unformatted(kind, s, rng)), True), *((mine(decoys(k, text, rng)), False) for k in (kind, rng.choice(("email", "phone"))))):
        for _, label, f in _planted(text, kind if right else "", s, right, rng):
            yield label > 0, aside, False, f


def _lists(x: np.ndarray) -> pa.Array:
    """The rows of x as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


EXAMPLE = "label boolean, held boolean, base boolean"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled candidates, equal ones of a task counted."""

    def packed() -> pa.RecordBatch:
        *flags, x = zip(*seen, strict=True)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.bool_()) for c in flags), _lists(np.array(x, np.int32)), pa.array(seen.values(), pa.int64())], ["label", "held", "base", "x", "n"])

    seen: Counter[tuple] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            seen.update((*flags, tuple(map(int, f))) for *flags, f in _labelled(doc_id, text.as_py() or ""))
            if len(seen) > 20_000:
                yield packed()
                seen.clear()
    if seen:
        yield packed()


@dataclass
class Model:
    trees: Boosted | None
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
        """The fixed formats' spans, and all spans: those and the accepted candidates that overlap no other, best first."""
        base = base_spans(text)
        every = {k: list(v) for k, v in base.items()}
        taken = _covered(base)
        left = [c for c in candidates(text) if not _overlaps(taken, c[1], c[2])] if self.trees else []
        if left:
            p = self.trees.predict(np.array([features(text, *c) for c in left]))
            for q, (kind, a, b) in sorted(zip(p.tolist(), left, strict=True), key=lambda x: (-x[0], x[1][1], x[1])):
                if q >= self.thresholds[kind] and not _overlaps(taken, a, b):
                    every[kind].append((a, b))
                    taken.insert(bisect_left(taken, (a, b)), (a, b))
        return base, {k: sorted(v) for k, v in every.items()}


def _level(models: list[Boosted], splits: list[Splits], cuts: list[np.ndarray]) -> Callable:
    """Sums for the next splits of two models by place, the first's without the documents kept aside."""

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = 0
        for batch in filter(len, batches):
            bins = np.asfortranarray(_matrix(batch.column("bins")))
            y, held, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "held", "n"))
            out = out + np.stack([m.sums(own, cuts, bins, y, w) for m, own, w in zip(models, splits, (n * ~held.astype(bool), n), strict=True)])
        yield _places(np.ravel(out))

    return level


TRIED = np.linspace(0.05, 0.995, 190)


def _reached(trees: Boosted, cuts: list[np.ndarray]) -> Callable:
    """Examples kept aside by kind, number of tried thresholds that they reach, and label. The formats' spans are taken anyway."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(KINDS), len(TRIED) + 1, 2), np.int64)
        for batch in filter(len, batches):
            kind, label, held, base, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "label", "held", "base", "n"))
            own = held.astype(bool) & ~base.astype(bool)
            q = trees.predict(_matrix(batch.column("bins"))[own])
            np.add.at(out, (kind[own], np.searchsorted(TRIED, q, side="right"), label[own].astype(int)), n[own])
        yield _places(out.ravel())

    return reached


def _places(sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["place", "n"])


def train(docs: DataFrame, p: Redaction = Redaction()) -> Model:
    """Learns from the candidates of all documents and from values put into them. Equal examples are counted, then those of
    equal bins; of these the driver sees sums by leaf and bin, a job for each level of the trees, or `few` rows at most."""
    schema = f"{EXAMPLE}, x array<int>, n long"
    raw = saved(docs.select("doc_id", "text").mapInArrow(_examples, schema).groupBy("label", "held", "base", "x").agg(F.sum("n").alias("n")))
    # the features' values are few: lengths, counts and flags of short strings, numbers of three digits
    values = raw.select("n", F.posexplode("x").alias("f", "value")).groupBy("f", "value").agg(F.sum("n").alias("n")).toArrow().sort_by([("f", "ascending"), ("value", "ascending")])
    f, value, n = (values.column(c).to_numpy() for c in ("f", "value", "n"))
    cuts = [cuts_of(value[f == k], n[f == k]) for k in np.unique(f)]

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x = _matrix(batch.column("x"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "held", "base")), pa.array(x[:, 0], pa.int32()), _lists(binned(x, cuts)), batch.column("n")], ["label", "held", "base", "kind", "bins", "n"])

    keys = ["label", "held", "base", "kind", "bins"]
    rows = saved(raw.mapInArrow(to_bins, f"{EXAMPLE}, kind int, bins array<tinyint>, n long").groupBy(*keys).agg(F.sum("n").alias("n")))
    forget(raw)
    folds = {(r.held, r.label): r for r in rows.groupBy("held", "label").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    count = lambda *of: sum(r.n for k, r in folds.items() if k in of)
    right, wrong, held = count((False, True)), count((False, False)), (count((True, True)), count((True, False)))
    if right + wrong + sum(held) < 20 or not right or not wrong:
        forget(rows)
        return Model(None, dict.fromkeys(KINDS, 1.0))
    local = rows.toArrow().to_batches() if sum(r.rows for r in folds.values()) <= p.few else None

    def summed(work: Callable, *shape: int) -> np.ndarray:
        if local is not None:
            parts = pa.Table.from_batches(work(iter(local)))
        else:
            parts = rows.mapInArrow(work, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(int(np.prod(shape)), np.int64)
        np.add.at(out, parts.column("place").to_numpy(), parts.column("n").to_numpy())
        return out.reshape(shape)

    size = sum(len(cs) + 1 for cs in cuts)
    # the thresholds hold for forms that the first trees haven't seen; the trees that are used have seen all
    models = [Boosted().start(right / (right + wrong)), Boosted().start((right + held[0]) / (right + wrong + sum(held)))]
    grow(models, cuts, lambda splits: list(summed(_level(models, splits, cuts), 2, 2, 1 << len(splits[0]), size)))
    picked = summed(_reached(models[0], cuts), len(KINDS), len(TRIED) + 1, 2)[:, ::-1].cumsum(1)[:, ::-1][:, 1:]  # wrong and right ones at each threshold
    forget(rows)
    good = picked[..., 1] >= np.maximum(p.precision * picked.sum(-1), 1)
    return Model(models[1].unbinned(cuts), {k: float(min(TRIED[own], default=0.995)) for k, own in zip(KINDS, good, strict=True)})


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def _find(model) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                base, every = m.spans(text.as_py() or "")
                out.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return find


def personal_data(docs: DataFrame, p: Redaction = Redaction()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of docs(doc_id, text, ...).

    The counts and the hash are of the fixed formats' spans; `spans` has those and the accepted candidates. Offsets
    are code points. Null and empty texts have no spans. Rows are mapped one to one; there is no shuffle but those
    of the examples that the trees learn from. Where a table has too few candidates to learn from, none is added. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, p))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(_find(model), f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(docs: DataFrame, p: Redaction = Redaction()) -> DataFrame:
    """docs with each span of its text replaced by its kind in capitals between angle brackets; n_chars follows if there is one.

    Spans of different kinds that overlap are replaced together, by the first one's kind. All columns and rows stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, p))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                if text:
                    out, end = [], 0
                    for a, b, kind in sorted((a, b, k) for k, spans in m.spans(text)[1].items() for a, b in spans):
                        if a >= end:
                            out += [text[end:a], f"<{kind.upper()}>"]
                        end = max(end, b)
                    text = "".join([*out, text[end:]])
                texts.append(text)
            yield batch.set_column(at, plain[at], pa.array(texts, batch.schema.field(at).type))

    plain = [f"c{k}" for k in range(len(docs.columns))]  # names that mapInArrow takes, whatever signs the columns' have
    at = docs.columns.index("text")
    kinds = T.StructType([T.StructField(c, f.dataType) for c, f in zip(plain, docs.schema, strict=True)])
    out = docs.toDF(*plain).mapInArrow(replace, kinds).toDF(*docs.columns)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))

"""Plain versions of the operators, row by row, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def smallest(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_vectors(rows, least=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for k, (i, v) in enumerate(ok):
        for j, w in ok[:k]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links.append((i, j))
    n = Counter(x for pair in links for x in pair)
    c = smallest([i for i, _ in rows], links)
    return {i: (n[i], c[i], c[i] == i) for i, _ in rows}


def without_repeats(rows, k=35):
    where = defaultdict(list)
    split = [(i, words(t)) for i, t in rows]
    for r, (_, w) in enumerate(split):
        for s in range(len(w) - k + 1):
            where[tuple(w[s : s + k])].append((r, s))
    gone = defaultdict(set)
    for places in where.values():
        if len(places) > 1:
            for r, s in places:
                gone[r] |= set(range(s, s + k))
    out = {}
    for r, (i, w) in enumerate(split):
        kept = " ".join(x for n, x in enumerate(w) if n not in gone[r])
        out[i] = (len(w), len(gone[r]), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for s, g in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if grams[g] > 1:
            covered |= {s, s + 1, s + 2}
    lines = [x for x in text.split("\n") if words(x)]
    n = len(covered)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n, len(w) < 50 or 100 * n > 50 * len(w))


def shingle_set(text, size):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w)} if 0 < len(w) < size else set(zip(*(w[k:] for k in range(size)), strict=False))


def near_copies(rows, size=2, percent=80):
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    c = smallest([i for i, _ in rows], links)
    return {i: (len(s), c[i], c[i] == i) for i, s in sets}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        d = [int(x) for x in d[::-1]]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    }

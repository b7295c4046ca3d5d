"""Lexical search, WARC archives and vector codes against plain versions, and their edge cases."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm.lexical_search import Automaton, LexicalSearch, lexical_search
from weir.llm.queries import QUERIES
from weir.llm.vector_codes import Balls, VectorCodes, decoded, digest, fitted, nearest, vector_codes, whole_vectors
from weir.llm.warc import Archives, archived, new_folder, normalised, read_records, warc_round_trip, write_streams

DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHING = ("item", "rank", "score", "deal", "place", "digest", "size", "code", "x", "of", "term", "n")


def clash(df):
    """With columns of names that an operator could use itself."""
    return df.withColumns({c: F.lit(1) for c in CLASHING})


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top):
    held = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, Counter()).update(terms(text))
    out = set()
    for i, q in asked.items():
        found = []
        for doc, c, size in held:
            m = 100 - 75 + 75 * size * n // length
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, k in q.items() if t in c)
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out |= {(i, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:top], 1)}
    return out


ODD_DOCS = [
    (0, None), (1, ""), (2, "  .,;\n\x00"), (3, "The cat, THE Dog; the-cat_dog"), (4, "the cat " * 50_000 + "needle"), (5, "Straße ÉCOLE école 東京 tokyo2 2tokyo"),
    (6, "cat"), (7, "cat"), (7, "cat"), (7, "dog cat"), (None, "cat"), (None, None), (8, "x" * 3_000_000 + " cat"), (9, "concatenate scatter cats the\tcat"), (-5, "cat"),
]
ODD_ITEMS = [(0, "the cat"), (1, "CAT dog cat"), (2, None), (3, ""), (4, "nowhere at all"), (5, "École straße 東京 É"), (None, "needle"), (1, "dog"), (6, "x" * 3_000_000), (None, "tokyo2")]


@pytest.mark.parametrize("p", [LexicalSearch(), LexicalSearch(top=2, pairs=3, cells=8, span=64, deals=2)])
def test_lexical_search_of_odd_rows(spark, p):
    docs = clash(spark.createDataFrame(ODD_DOCS, "doc_id long, text string").repartition(3))
    items = clash(spark.createDataFrame(ODD_ITEMS, "item_id long, text string"))
    df = lexical_search(docs, items, p)
    assert df.columns == ["item_id", "rank", "doc_id", "score"] and dict(df.dtypes)["rank"] == "int"
    assert {tuple(r) for r in df.collect()} == plain_search(ODD_DOCS, ODD_ITEMS, p.top)


def test_lexical_search_without_rows(spark):
    docs, items = spark.createDataFrame(ODD_DOCS, "doc_id long, text string"), spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    assert not lexical_search(docs.limit(0), items, LexicalSearch()).collect()
    assert not lexical_search(docs, items.limit(0), LexicalSearch()).collect()


def test_lexical_search_of_table(spark):
    load = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{DIR}/{t}.parquet").select(*c).collect()]
    assert {tuple(r) for r in QUERIES["op11_lexical_search"](spark, DIR).collect()} == plain_search(load("documents", "doc_id", "text"), load("benchmark", "item_id", "text"), 10)


def test_automaton_counts_whole_terms_at_every_cut():
    rng = random.Random(3)
    text = "".join(rng.choice(["ab", "a", "b", "abab", " ", "  ", "-", "É", "\n"]) for _ in range(800))
    a = Automaton([(0, t, 1) for t in ("a", "ab", "b", "abab", "é", "É", "ba")])
    want = Counter(t for t in terms(text) if t in a.terms)
    for span in (1, 2, 3, 7, 64, 5000):
        n, found = a.count(text.encode(), span)
        assert n == len(terms(text)) and {t: found[k] for t, k in a.terms.items() if found[k]} == dict(want)


# Vector codes


def plain_codes(rows, parts, entries, rounds):
    good = [(i, label, v) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    whole = [[math.floor(256 * x) for x in r[2]] for r in good]
    w = len(whole[0]) // parts
    cut = lambda v, k: v[k * w : (k + 1) * w]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    books = [[cut(v, k) for v in whole[:entries]] for k in range(parts)]
    assign = lambda: [[min(range(len(books[k])), key=lambda e: (gap(cut(v, k), books[k][e]), e)) for k in range(parts)] for v in whole]
    for _ in range(rounds):
        codes = assign()
        for k in range(parts):
            for e in range(len(books[k])):
                own = [cut(v, k) for v, c in zip(whole, codes, strict=True) if c[k] == e]
                if own:
                    books[k][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for (i, label, _), v, c in zip(good, whole, assign(), strict=True):
        out.append((i, label, "".join(f"{x:02x}" for x in c), sum(gap(cut(v, k), books[k][c[k]]) for k in range(parts))))
    by = Counter()
    for _, label, _, e in out:
        by[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by[label], sha) for i, label, c, e in out), key=str)


def vectors(seed, n, dims, step):
    rng = random.Random(seed)
    rows = [(rng.randrange(10 * n), [rng.randrange(-20, 20) / step for _ in range(dims)], rng.choice([None, 1, 2, 2, 2])) for _ in range(n)]
    nan, inf = float("nan"), float("inf")
    return [*rows, (-3, None, 1), (-2, [None] + [0.0] * (dims - 1), 1), (-1, [nan] * dims, None), (-4, [inf] * dims, 2), (-5, [], 1), (-6, [0.5], 1), (None, [0.25] * dims, None), (7, [0.1] * 2 * dims, 1), rows[0], rows[1], *[(5000 + k, [1.0] * dims, 3) for k in range(n)]]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("seed", "parts", "entries", "rounds", "step"), [(1, 2, 5, 2, 64), (2, 4, 8, 3, 512), (3, 1, 300 // 2, 1, 256), (4, 4, 3, 0, 8)])
def test_vector_codes(spark, seed, parts, entries, rounds, step):
    rows = vectors(seed, 60, 8, step)
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    df = clash(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = [tuple(r) for r in vector_codes(df, VectorCodes(parts, entries, rounds, rows=17, labels=2)).collect()]
    assert sorted(got, key=str) == plain_codes(rows, parts, entries, rounds)


def test_vector_codes_without_vectors(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [], None)], SCHEMA)
    assert not vector_codes(df, VectorCodes()).collect() and not vector_codes(df.limit(0), VectorCodes()).collect()


def test_vectors_of_doubles_and_too_large_components(spark):
    one = spark.createDataFrame([(k, [k / 7, -k / 3], None) for k in range(9)], "vec_id int, embedding array<double>, label string")
    assert vector_codes(one, VectorCodes(parts=2, entries=4)).count() == 9
    large = spark.createDataFrame([(1, [1e30, 0.0], None)], "vec_id int, embedding array<double>, label string")
    with pytest.raises(Exception, match="squared distances"):
        vector_codes(large, VectorCodes(parts=2)).collect()


def test_balls_find_what_comparing_with_all_finds_and_compare_less():
    rng = np.random.default_rng(5)
    for width, entries in ((1, 7), (4, 64), (3, 20)):
        centres = rng.integers(-400, 400, (entries, width))
        centres[1] = centres[0]  # equal entries: the first wins
        x = centres[rng.integers(0, entries, 3000)] + rng.integers(-9, 9, (3000, width))
        want = nearest(x, centres)
        for start in (want, rng.integers(0, entries, 3000), np.full(3000, entries - 1)):
            code, gap, compared = Balls(centres).nearest(x, start)
            assert (code == want).all() and (gap == ((x - centres[want]) ** 2).sum(1)).all()
        if width > 1:
            assert Balls(centres).nearest(x, want)[2] < 3000 * entries / 4


def test_codes_name_what_they_decode_to(spark):
    df = spark.read.parquet(f"{DIR}/embeddings.parquet")
    p = VectorCodes(entries=16)
    codes, books = fitted(df, p)
    errors = {r.vec_id: r.error for r in codes.collect()}
    of = {r.vec_id: np.floor(np.array(r.embedding, float) * p.scale) for r in whole_vectors(df, p).collect()}
    got = {r.vec_id: np.array(r.embedding) * p.scale for r in decoded(codes, books, p).collect()}
    assert got.keys() == of.keys() and all(round(((got[i] - of[i]) ** 2).sum()) == errors[i] for i in of)
    assert len(digest(books)) == 64


# WARC

PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/é ü\r\nX: y", "<p>one</p>"), (3, None, None), (4, "", ""), (5, "http://b.example/", "héllo\r\n\r\nWARC/1.1\r\n\r\n"), (-7, "u", "<p>one</p>"),
    (5, "http://b.example/", "héllo\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", "<p>one</p>"), (None, "n", "alone"), (None, "n", "alone"), (8, "long", "abc" * 700_000), (9, "long", "abc" * 700_000), (10, "q", "tiny"), (11, "q", "tiny"),
]


def plain_warc(rows, least=0):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in payloads:
        if i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, b in payloads:
        again = len(b) >= least and b in first and first[b] != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("p", [Archives(), Archives(least=5, size=1), Archives(least=100_000, size=3000)])
def test_warc_round_trip(spark, p):
    df = clash(spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3))
    got = warc_round_trip(df, p)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_warc(PAGES, p.least)


def test_warc_without_pages(spark):
    assert not warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string"), Archives()).collect()


def test_streams_become_members_that_open_alone(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    folder = new_folder(spark)
    stream = write_streams(df, folder, Archives()).first().archive
    raw = Path(stream.removeprefix("file://")).read_bytes()
    one = zlib.decompressobj(31)
    assert one.decompress(raw) and not one.unused_data  # a single member
    out = archived(df, Archives())
    row = out.first()
    path = row.archive.removeprefix("file://")
    data, index = Path(path).read_bytes(), [eval(x) for x in Path(f"{path}.idx").read_text().splitlines()]  # noqa: S307
    assert len(data) == row.bytes and len(index) == row.records == len(PAGES) + 1
    assert [x["type"] for x in index].count("revisit") == sum(x[3] == "revisit" for x in plain_warc(PAGES))
    members = [zlib.decompress(data[x["offset"] : x["offset"] + x["length"]], 31) for x in index]
    assert b"".join(members) == gzip.decompress(data) and all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members)
    texts = {r.page_id: r.payload for r in read_records(out).where("record_type = 'response' and page_id is not null").collect()}
    assert texts == {i: (h or "").encode() for i, _, h in PAGES if i is not None and i in {x[0] for x in plain_warc(PAGES) if x[3] == "response"}}
    urls = {r.page_id: r.url for r in read_records(out).collect()}
    assert urls[2] == "http://a.example/%C3%A9%20%C3%BC%0D%0AX:%20y" and urls[3] is None


def test_archives_of_others_are_normalised(spark, tmp_path):
    """Several members, a folded header line, a record that is no response; a cut-off stream is an error."""
    record = lambda kind, i, block: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{i}>\r\nX-Note: a\r\n b\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    whole = gzip.compress(record("request", 0, b"GET /") + record("response", 1, http + b"body")) + gzip.compress(record("response", 2, http))
    (tmp_path / "a.warc.gz").write_bytes(whole)
    (tmp_path / "b.warc.gz").write_bytes(whole[: len(whole) // 2])
    frame = lambda n: spark.createDataFrame([(f"file://{tmp_path}/{n}",)], "archive string")
    out = normalised(frame("a.warc.gz"), new_folder(spark), Archives())
    assert out.first().records == 3
    assert {(r.page_id, bytes(r.payload)) for r in read_records(out).collect()} == {(1, b"body"), (2, b"")}
    with pytest.raises(Exception, match="end-of-stream|cut off"):
        normalised(frame("b.warc.gz"), new_folder(spark), Archives())

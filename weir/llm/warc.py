"""WARC archives: written as one gzip stream each, normalised to a gzip member a record with a sidecar index, read back by it."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm.common import runs, saved, shared_dir


@dataclass(frozen=True)
class Archives:
    """least: bytes of a payload from which an equal one is revisited. size: bytes of records after which a new archive
    starts. level: of the archives' compression, draft: of the single streams, which are read once. date: of all records.
    """

    least: int = 0
    size: int = 1 << 28
    level: int = 6
    draft: int = 1
    date: str = "2000-01-01T00:00:00Z"


PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_CHUNK = 1 << 20


def new_folder(spark: SparkSession) -> str:
    """A fresh folder that all tasks share, as a URI that pyarrow opens."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/weir/warc-{uuid.uuid4().hex}")
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{whole[5:]}" if whole.startswith("file:/") and not whole.startswith("file://") else whole


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _open(uri: str) -> BinaryIO:
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _create(uri: str) -> BinaryIO:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, date: str) -> bytes:
    """A response record. Of the url, signs that a header can't hold are percent-encoded; an id of null is left open."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + len(payload)))]
    return _head(fields) + http + payload + _END


def read_heads(stream: BinaryIO) -> Iterator[list[tuple[str, str]]]:
    """The header fields of each record in turn; its block must be read before the next is asked for."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and fields:  # a folded line
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {text.strip()}")
            else:
                name, _, value = text.partition(":")
                fields.append((name.strip(), value.strip()))
        yield fields


def _field(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


def _block(stream: BinaryIO, fields: list[tuple[str, str]]) -> Iterator[bytes]:
    left = int(_field(fields, "Content-Length") or 0)
    while left:
        if not (part := stream.read(min(left, _CHUNK))):
            raise EOFError(f"{_field(fields, 'WARC-Record-ID')} is cut off")
        left -= len(part)
        yield part


def _write(folder: str, p: Archives) -> Callable:
    """Records of a task's pages in as few streams as their size allows; a row for each page says where it went."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, place, name, packed = None, 0, 0, "", None
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = html or b""
                if out is None:
                    name, held, place, packed = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, zlib.compressobj(p.draft, zlib.DEFLATED, 31)
                    out = _create(name)
                    out.write(packed.compress(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", p.date), ("Content-Length", "0")]) + _END))
                digest = payload_digest(payload)
                record = page_record(page_id, url, payload, digest, p.date)
                out.write(packed.compress(record))
                rows.append((name, place, page_id, digest, len(payload)))
                place, held = place + 1, held + len(record)
                if held >= p.size:
                    out.write(packed.flush())
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["archive", "place", "page_id", "digest", "size"])
        if out is not None:
            out.write(packed.flush())
            out.close()

    return write


def write_streams(pages: DataFrame, folder: str, p: Archives) -> DataFrame:
    """Writes a record for each page into archives of one gzip stream each: (archive, place, page_id, digest, size).

    The files are named by the tasks that wrote them, and only those of tasks that ended well are in the table, so an
    archive that a lost executor left is read by nobody.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    return saved(rows.mapInArrow(_write(folder, p), "archive string, place long, page_id long, digest string, size long"))


def repeats(written: DataFrame, least: int) -> DataFrame:
    """(archive, place, refers_to) of the records whose payload equals that of a smaller page_id; only digests meet, no payloads."""
    some = written.where(F.col("size") >= least)
    firsts = saved(some.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n"))  # a table, so that the join may split a payload with many pages
    return some.join(firsts, ["digest", "size"]).where("page_id is null or page_id <> refers_to").select("archive", "place", "refers_to")


def _revisit(fields: list[tuple[str, str]], refers_to: int, http: bytes) -> bytes:
    new = {"warc-type": "revisit", "content-length": str(len(http))}
    out = [(k, new.get(k.lower(), v)) for k, v in fields]
    return _head([*out[:-1], ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), out[-1]]) + http + _END


def _http_of(block: Iterator[bytes]) -> bytes:
    """The HTTP header of a block, which is read to its end and not held."""
    http, whole = b"", False
    for part in block:
        if not whole:
            http += part
            whole = _END in http
    return http[: http.index(_END) + 4] if whole else http


def _normalise(folder: str, p: Archives) -> Callable:
    def members(stream: BinaryIO, refers: dict[int, int]) -> Iterator[tuple[list[tuple[str, str]], bool, Iterator[bytes]]]:
        """Each record's header fields, whether it revisits another, and its bytes in parts."""
        place = 0
        for fields in read_heads(stream):
            block = _block(stream, fields)
            to = None
            if _field(fields, "WARC-Type") in ("response", "resource"):
                to, place = refers.get(place), place + 1
            if to is None:
                yield fields, False, (part for source in ([_head(fields)], block, [_END]) for part in source)
            else:
                yield fields, True, iter([_revisit(fields, to, _http_of(block))])

    def rewrite(source: str, refers: dict[int, int]) -> tuple[str, int, int]:
        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        offset, lines = 0, []
        with _open(source) as whole, gzip.GzipFile(fileobj=whole) as stream, _create(name) as out:
            for fields, revisit, parts in members(stream, refers):
                packed, length = zlib.compressobj(p.level, zlib.DEFLATED, 31), 0
                for part in parts:
                    length += out.write(packed.compress(part))
                length += out.write(packed.flush())
                lines.append(json.dumps({"offset": offset, "length": length, "type": "revisit" if revisit else _field(fields, "WARC-Type"), "id": _field(fields, "WARC-Record-ID")}))
                offset += length
        with _create(f"{name}.idx") as out:
            out.write("".join(f"{x}\n" for x in lines).encode())
        return name, len(lines), offset

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in runs(batches, ["archive"]):
            source = own.column("archive")[0].as_py()
            refers = {k: to for k, to in zip(own.column("place").to_pylist(), own.column("refers_to").to_pylist(), strict=True) if k >= 0}
            name, records, size = rewrite(source, refers)
            yield pa.RecordBatch.from_pylist([{"source": source, "archive": name, "records": records, "bytes": size}], pa.schema([("source", pa.string()), ("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return normalise


def normalised(archives: DataFrame, folder: str, p: Archives, changes: DataFrame | None = None) -> DataFrame:
    """Rewrites archives(archive), whose gzip may be one stream or many, with each record as a member of its own and a
    sidecar (.idx: offset, length, type and id of each member): (source, archive, records, bytes).

    A stream can't be entered in its middle, so an archive is one task's work: it is inflated once and passed on in
    parts, whatever the size of its records. changes(archive, place, refers_to): the responses, counted from 0 in
    their archive, that become revisits. A cut-off stream or one that is no WARC is an error.
    """
    files = archives.select("archive").distinct().withColumns({"place": F.lit(-1).cast("long"), "refers_to": F.lit(None).cast("long")})
    work = files if changes is None else files.unionByName(changes)
    tasks = 2 * archives.select("archive").distinct().count() + 1  # a fixed number: few rows, but much to read for each
    dealt = work.repartition(tasks, "archive").sortWithinPartitions("archive", "place")
    return saved(dealt.mapInArrow(_normalise(folder, p), "source string, archive string, records long, bytes long"))


def _page_id(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.removeprefix("-").isdigit() else None


def _read(payloads: bool) -> Callable:
    names = ["archive", "record_id", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def record(archive: str, member: bytes) -> tuple:
        whole = zlib.decompress(member, 31)
        head, _, rest = whole.partition(_END)
        fields = next(read_heads(io.BytesIO(head + _END)))
        block = rest[: int(_field(fields, "Content-Length") or 0)]
        http, _, payload = block.partition(_END) if "application/http" in (_field(fields, "Content-Type") or "") else (b"", b"", block)
        kind, said = _field(fields, "WARC-Type"), (_field(fields, "WARC-Payload-Digest") or "").removeprefix("sha1:")
        if kind == "revisit":  # without a payload; its HTTP header still tells the size
            lengths = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
            size, digest, payload = int(lengths[0]) if lengths else None, said, None
        else:
            size, digest = len(payload), payload_digest(payload)
            if said and said != digest:
                raise ValueError(f"{_field(fields, 'WARC-Record-ID')} in {archive}: the payload is not that of its digest")
        return archive, _field(fields, "WARC-Record-ID"), _page_id(_field(fields, "WARC-Record-ID")), _field(fields, "WARC-Target-URI"), kind, _page_id(_field(fields, "WARC-Refers-To")), size, digest, payload if payloads else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows, held = [], 0
                with _open(archive) as data, _open(f"{archive}.idx") as index:
                    for line in io.BufferedReader(index):
                        at = json.loads(line)
                        if at["type"] not in ("response", "revisit"):
                            continue
                        data.seek(at["offset"])
                        rows.append(record(archive, data.read(at["length"])))
                        held += 1 + (len(rows[-1][-1] or b"") >> 10)
                        if held >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return read


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The responses and revisits of normalised archives(archive), each member read at its sidecar's offset and inflated alone.

    A payload that is not that of the record's digest is an error. A revisit's size is that of its HTTP header.
    """
    tasks = 2 * archives.count() + 1
    schema = "archive string, record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return archives.select("archive").repartition(tasks, "archive").mapInArrow(_read(payloads), schema)


def archived(pages: DataFrame, p: Archives) -> DataFrame:
    """(source, archive, records, bytes): normalised archives of pages(page_id, url, html), where equal payloads are kept once.

    The html in UTF-8 is the payload, null or empty ones are empty. Of equal payloads of p.least bytes or more, that of
    the smallest page_id is a response and the others are revisits that refer to it; smaller ones are all responses.
    Rows that repeat the smallest page_id are responses each; a page_id of null revisits, unless all are null: then all
    are responses. A url of null is left out. Without pages there are no archives. Other columns are passed over.
    """
    spark = pages.sparkSession
    folder = new_folder(spark)
    written = write_streams(pages, f"{folder}/streams", p)
    out = normalised(written.select("archive"), f"{folder}/archives", p, repeats(written, p.least))
    drop_folder(spark, f"{folder}/streams")
    return out


def warc_round_trip(pages: DataFrame, p: Archives) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from its archives."""
    return read_records(archived(pages, p), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

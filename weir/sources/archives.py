"""Archives read member by member: a table of members first, then each member's own bytes, whatever the archive's size."""

from __future__ import annotations

import codecs
import fnmatch
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.sources.ranged import open_file

_CHUNK = 1 << 20
_INDEX = "archive string, kind string, member string, size long, offset long, packed long, method int, crc long"
_NAMES = ["archive", "kind", "member", "size", "offset", "packed", "method", "crc"]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 5000, weight: Callable[[tuple], int] = lambda r: 1) -> Iterator[pa.RecordBatch]:
    held, heavy = [], 0
    for r in rows:
        held.append(r)
        heavy += weight(r)
        if heavy >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _members(pattern: str) -> Callable:
    def members(path: str) -> Iterator[tuple]:
        with open_file(path) as f:
            if zipfile.is_zipfile(f):
                with zipfile.ZipFile(f) as z:
                    for i in z.infolist():
                        if not i.is_dir() and fnmatch.fnmatch(i.filename, pattern):
                            yield path, "zip", i.filename, i.file_size, i.header_offset, i.compress_size, -1 if i.flag_bits & 1 else i.compress_type, i.CRC
                return
            f.seek(0)
            try:
                with tarfile.open(fileobj=f, mode="r:") as t:  # reads headers only, and seeks from one to the next
                    for m in t:
                        if m.isfile() and fnmatch.fnmatch(m.name, pattern):
                            yield path, "tar", m.name, m.size, m.offset_data, m.size, 0, None
            except tarfile.ReadError:
                yield path, "stream", None, None, None, None, None, None

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _batches(members(path), _NAMES, _TYPES)

    return index


def archive_index(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """archive, kind, member, size, offset, packed, method, crc of the members of the archives below a path whose inner name fits.

    Of a zip its directory is read, of a plain tar its headers. A compressed tar can only be read from its start: it
    is one row of kind stream, without members.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path").mapInArrow(_members(pattern), _INDEX)


def _zip_chunks(path: str, offset: int, packed: int, method: int, crc: int) -> Iterator[bytes]:
    unpack = {0: None, 8: zlib.decompressobj(-15)}
    if method == 12:
        import bz2  # noqa: PLC0415

        unpack[12] = bz2.BZ2Decompressor()
    if method not in unpack:
        raise ValueError(f"{path}: a member is {'encrypted' if method < 0 else f'packed by method {method}'}")
    tool, sum_ = unpack[method], 0
    with open_file(path) as f:
        f.seek(offset)
        head = f.read(30)  # signature to lengths; name and extra field follow
        f.seek(offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
        while packed:
            if not (raw := f.read(min(packed, _CHUNK))):
                raise EOFError(f"{path} is cut off")
            packed -= len(raw)
            while tool is not None and method == 8 and raw:
                data = tool.decompress(raw, 4 * _CHUNK)
                raw = tool.unconsumed_tail
                sum_ = zlib.crc32(data, sum_)
                yield data
            if raw:
                data = tool.decompress(raw) if tool is not None else raw
                sum_ = zlib.crc32(data, sum_)
                yield data
    if tool is not None and method == 8 and (data := tool.flush()):
        sum_ = zlib.crc32(data, sum_)
        yield data
    if sum_ != crc:
        raise ValueError(f"{path}: the check sum of a member is wrong")


def _tar_chunks(path: str, offset: int, size: int) -> Iterator[bytes]:
    with open_file(path) as f:
        f.seek(offset)
        while size:
            if not (data := f.read(min(size, _CHUNK))):
                raise EOFError(f"{path} is cut off")
            size -= len(data)
            yield data


def _opened(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[tuple[str, str, Iterator[bytes]]]:
    """Each member's archive, name and bytes in chunks."""
    for batch in batches:
        for path, kind, member, size, offset, packed, method, crc in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
            if kind == "zip":
                yield path, member, _zip_chunks(path, offset, packed, method, crc)
            elif kind == "tar":
                yield path, member, _tar_chunks(path, offset, size)
            else:
                with open_file(path) as f, tarfile.open(fileobj=f, mode="r|*") as t:
                    for m in t:
                        if m.isfile() and fnmatch.fnmatch(m.name, pattern):
                            data = t.extractfile(m)
                            yield path, m.name, iter(lambda data=data: data.read(_CHUNK), b"")


def _dealt(index: DataFrame, target: int = 128 << 20) -> DataFrame:
    """Members dealt to tasks of about so many bytes, an archive that is a stream to one."""
    facts = index.agg(F.count("*").alias("n"), F.sum("packed").alias("packed"), F.count_if(F.col("kind") == "stream").alias("streams")).first()
    tasks = min(facts.n, max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), (facts.packed or 0) // target + facts.streams)) or 1
    return index.repartition(tasks, "archive", "member")


def member_parts(index: DataFrame, pattern: str = "*", part: int = 8 << 20) -> DataFrame:
    """archive, member, part, content: each member's bytes in parts of about that size (an empty member is one empty part).

    Tasks read just the bytes of their members; a check sum that is wrong is an error.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path, member, chunks in _opened(batches, pattern):
            n, held = 0, bytearray()
            for chunk in chunks:
                held += chunk
                while len(held) >= part:
                    yield path, member, n, bytes(held[:part])
                    del held[:part]
                    n += 1
            if held or not n:
                yield path, member, n, bytes(held)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), ["archive", "member", "part", "content"], [pa.string(), pa.string(), pa.int64(), pa.binary()], 16 << 20, lambda r: 100 + len(r[3]))

    return _dealt(index).mapInArrow(read, "archive string, member string, part long, content binary")


def member_lines(index: DataFrame, pattern: str = "*", encoding: str = "UTF-8") -> DataFrame:
    """archive, member, n, line: the lines of each member from 0, without their ends; a byte order mark is no part of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path, member, chunks in _opened(batches, pattern):
            decoder = codecs.getincrementaldecoder("utf-8-sig" if encoding.upper() == "UTF-8" else encoding)("replace")
            n, rest = 0, ""
            for chunk in chunks:
                *lines, rest = (rest + decoder.decode(chunk)).split("\n")
                for line in lines:
                    yield path, member, n, line.removesuffix("\r")
                    n += 1
            if rest := rest + decoder.decode(b"", True):
                yield path, member, n, rest.removesuffix("\r")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), ["archive", "member", "n", "line"], [pa.string(), pa.string(), pa.int64(), pa.string()], 4 << 20, lambda r: 100 + len(r[3]))

    return _dealt(index).mapInArrow(read, "archive string, member string, n long, line string")


def member_rows(lines: DataFrame, schema: str, kind: str = "csv", header: bool = True) -> DataFrame:
    """Lines of members parsed as CSV or one JSON object a line, with archive and member."""
    some = lines.where(F.trim("line") != "")
    if kind == "csv" and header:
        some = some.where("n > 0")
    parsed = F.from_csv("line", schema) if kind == "csv" else F.from_json("line", schema)
    return some.select("archive", "member", parsed.alias("x")).select("archive", "member", "x.*")

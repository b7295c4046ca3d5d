"""CSV files whose columns are matched by name: their headers differ in order, columns and encoding."""

from __future__ import annotations

import codecs
import csv
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.types import union_relaxed
from weir.sources.ranged import open_file

BOMS = ((codecs.BOM_UTF8, "UTF-8"), (codecs.BOM_UTF16_LE, "UTF-16LE"), (codecs.BOM_UTF16_BE, "UTF-16BE"))
_CHUNK = 1 << 16


def safe_names(names: list[str]) -> list[str]:
    """As Spark names columns of a header: an empty one by its place, each of several equal ones, whatever their case, with its place."""
    low = [n.lower() for n in names]
    return [f"_c{k}" if not n else f"{n}{k}" if low.count(n.lower()) > 1 else n for k, n in enumerate(names)]


def _heads(sep: str, encoding: str) -> Callable:
    def first_line(path: str) -> tuple[str | None, str]:
        """The encoding that a byte order mark tells, and the first line that isn't blank. No more is read than that takes."""
        unpack = zlib.decompressobj(31) if path.endswith(".gz") else None
        with open_file(path) as f:
            data, marked, rest = b"", None, True
            while rest:
                chunk = f.read(_CHUNK)
                rest = bool(chunk)
                data += unpack.decompress(chunk) if unpack else chunk
                mark, marked = next(((m, e) for m, e in BOMS if data.startswith(m)), (b"", None))
                text = codecs.getincrementaldecoder(marked or encoding)("replace").decode(data[len(mark) :], final=not rest)
                lines = text.splitlines(keepends=True)
                for line in lines:
                    if line.strip() and (line.endswith(("\n", "\r")) or not rest):
                        return marked, line.strip("\r\n")
        return marked, ""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("url", pa.string()), ("marked", pa.string()), ("header", pa.list_(pa.string()))])
        for batch in batches:
            rows = []
            for path, url in zip(batch.column("path").to_pylist(), batch.column("url").to_pylist(), strict=True):
                marked, line = first_line(path)
                rows.append({"path": path, "url": url, "marked": marked, "header": next(csv.reader([line], delimiter=sep), [])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return heads


def header_index(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None, other: str = "ISO-8859-1") -> DataFrame:
    """(path, encoding, bom, header) of every CSV file below a path that isn't empty.

    Tasks read each file's first line only. A byte order mark tells the encoding; without one it is `encoding` if that is
    given, else UTF-8 where all lines of the file are that, else `other`: for this the files are read once, line by line.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.select("path", F.col("_metadata.file_path").alias("url")).mapInArrow(_heads(sep, encoding or other), "path string, url string, marked string, header array<string>")
    if encoding is None:
        valid = spark.read.option("recursiveFileLookup", True).text(path).groupBy(F.col("_metadata.file_path").alias("url")).agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"))
        found = found.join(valid, "url", "left").withColumn("own", F.when(F.col("valid"), "UTF-8").otherwise(other))
    else:
        found = found.withColumn("own", F.lit(encoding))
    return found.select("path", F.coalesce("marked", "own").alias("encoding"), F.col("marked").isNotNull().alias("bom"), "header")


def read_csv_by_name(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",", encoding: str | None = None, corrupt: str = "_corrupt_record", extra: bool = True) -> DataFrame:
    """All rows of the CSV files below a path, columns matched by name whatever their case and order.

    schema: types of columns by name, which come first; absent ones are null. Other columns are strings, in the order of
    their first file by path, and left out without `extra`. A row with a value that isn't of its column's type, or with
    too few or too many fields, has its text in the column `corrupt`; it is null in good rows. Files with the same
    header and encoding are one scan; as in any listing of Spark, the driver holds the files' names.
    """
    typed = schema if isinstance(schema, T.StructType) else T.StructType() if schema is None else T.StructType.fromDDL(schema)
    known = {f.name.lower(): f for f in typed}
    groups: dict[tuple, list[str]] = {}
    for r in header_index(spark, path, sep, encoding).orderBy("path").collect():
        groups.setdefault((tuple(safe_names(r.header)), r.encoding), []).append(r.path)
    spelt: dict[str, str] = {f.name.lower(): f.name for f in typed}
    frames = [spark.createDataFrame([], T.StructType([*typed.fields, T.StructField(corrupt, T.StringType())]))]
    for (names, own), paths in groups.items():
        fields = []
        for n in names:
            name = spelt.setdefault(n.lower(), n)
            fields.append(T.StructField(name, known[n.lower()].dataType if n.lower() in known else T.StringType()))
        r = spark.read.option("header", True).option("sep", sep).option("encoding", own).option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)  # else what is asked for would decide which rows are bad
        r = r.option("multiLine", True) if own.startswith("UTF-16") else r
        df = r.schema(T.StructType([*fields, T.StructField(corrupt, T.StringType())])).csv([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths])
        # Spark refuses scans of the bad rows' text alone: it names a column besides
        beside = F.coalesce(F.substring(df[f"`{df.columns[0]}`"].cast("string"), 1, 0), F.lit("")) if fields else F.lit("")
        df = df.withColumn(corrupt, F.concat(corrupt, beside))
        frames.append(df if extra else df.select(*(f"`{f.name}`" for f in fields if f.name.lower() in known), corrupt))
    united = union_relaxed(frames)
    return united.select(*(f"`{c}`" for c in united.columns if c != corrupt), corrupt)


def repair_csv(spark: SparkSession, path: str, target: str, schema: str | T.StructType | None = None, sep: str = ",", encoding: str | None = None, bad: str | None = None) -> None:
    """Writes CSV files of any header, encoding or byte order mark as UTF-8 without a mark, with one header, to the target;
    rows that can't be read go to the folder `bad`, as text, if it is named."""
    df = read_csv_by_name(spark, path, schema, sep, encoding)
    if bad:
        df.where("_corrupt_record is not null").select("_corrupt_record").write.text(bad)
    df.where("_corrupt_record is null").drop("_corrupt_record").write.option("header", True).option("sep", sep).csv(target)

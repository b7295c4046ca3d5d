"""File sources and sinks: formats, listings, archives, lineage, staged and verified writes."""

from __future__ import annotations

import fnmatch
import gzip
import io
import re
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weir.functions.columns import strip_control
from weir.functions.types import union_relaxed
from weir.sources import archives
from weir.sources.ranged import open_file, size_of

SUFFIXES = {"csv": "csv", "tsv": "csv", "txt": "csv", "json": "json", "ndjson": "json", "jsonl": "json", "parquet": "parquet", "pq": "parquet", "xml": "xml", "orc": "orc", "avro": "avro"}


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def _data_files(spark: SparkSession, path: str) -> Iterator:
    """The status of each file at a path, a glob or below a folder, but for hidden ones."""
    fs, p = file_system(spark, path)
    for found in fs.globStatus(p) or []:
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                yield f


def detect_format(spark: SparkSession, path: str) -> str:
    """delta for a folder with _delta_log, iceberg for one with metadata/, else what the suffix of a file or a folder's first file says."""
    if exists(spark, f"{path}/_delta_log"):
        return "delta"
    if exists(spark, f"{path}/metadata"):
        return "iceberg"
    name = next((f.getPath().getName() for f in _data_files(spark, path)), path.rpartition("/")[2])
    for part in reversed(name.lower().removesuffix(".gz").split(".")):
        if part in SUFFIXES:
            return SUFFIXES[part]
    raise ValueError(f"unknown format: {path}")


def read_csv(spark: SparkSession, path: str | list[str], schema=None, header: bool = True, sep: str = ",", encoding: str = "UTF-8", skip_bad: bool = False, corrupt: str | None = None) -> DataFrame:
    """CSV, TSV or TXT, recursively. skip_bad drops malformed rows; corrupt names a column that keeps them."""
    r = spark.read.option("header", header).option("sep", sep).option("encoding", encoding).option("recursiveFileLookup", True).option("enforceSchema", False)
    if skip_bad:
        r = r.option("mode", "DROPMALFORMED")
    if corrupt:
        r = r.option("columnNameOfCorruptRecord", corrupt).option("enforceSchema", True)
    return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def array(path: str) -> bool:
        name = path.lower().removesuffix(".gz")
        if name.endswith((".ndjson", ".jsonl")):
            return False
        with open_file(path) as whole:
            stream = gzip.GzipFile(fileobj=whole) if path.lower().endswith(".gz") else whole
            while chunk := stream.read(4096):
                if text := chunk.lstrip(b" \t\r\n\xef\xbb\xbf"):  # blanks and a byte order mark
                    return text[:1] != b"{"
        return False

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([array(p) for p in batch.column("path").to_pylist()], pa.bool_())], ["path", "is_array"])


def json_shapes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, is_array) of JSON files: whether each holds an array, and not an object a line, by its suffix, else by its first sign.

    Tasks read the starts of the files only.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path").mapInArrow(_shapes, "path string, is_array boolean")


def read_json(spark: SparkSession, path: str | list[str], schema=None, array: bool | None = None) -> DataFrame:
    """One object a line, or (array) files that are one array of objects each; what each file says if neither is asked for.

    Files of both kinds are one scan a kind; without a schema their columns and types are the relaxed union of both.
    """

    def read(path: str | list[str], array: bool) -> DataFrame:
        r = spark.read.option("multiLine", array).option("recursiveFileLookup", True)
        return (r.schema(schema) if schema else r).json(path)

    if array is not None:
        return read(path, array)
    by: dict[bool, list[str]] = {}
    for r in json_shapes(spark, path).orderBy("path").collect():  # as in any listing of Spark, the driver holds the files' names
        by.setdefault(r.is_array, []).append(re.sub(r"([\\\[\]{}*?])", r"\\\1", r.path))
    if len(by) < 2:
        return read(path, True in by)
    return union_relaxed([read(paths, array) for array, paths in by.items()])


def read_parquet(spark: SparkSession, path: str | list[str], pattern: str | None = None, base: str | None = None) -> DataFrame:
    """Files, a folder or globs; folders key=value become columns."""
    r = spark.read
    r = r.option("pathGlobFilter", pattern) if pattern else r
    r = r.option("basePath", base) if base else r
    return r.parquet(*([path] if isinstance(path, str) else path))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema) -> DataFrame:
    """A row for each row_tag element; child texts trimmed, empty ones null. Control characters go before files are parsed."""
    end = f"</{row_tag}>"  # also what splits a large file
    texts = spark.read.text(path, lineSep=end, recursiveFileLookup=True).select(strip_control(F.col("value")).alias("value"))
    start = rf"(?s)<{re.escape(row_tag)}(?:\s[^>]*)?>.*$"
    rows = texts.select(F.concat(F.regexp_extract("value", start, 0), F.lit(end)).alias("value")).where(F.col("value") != end)
    parsed = rows.select(F.from_xml("value", schema, {"rowTag": row_tag}).alias("x")).select("x.*")
    return parsed.withColumns({f.name: F.nullif(F.trim(f.name), F.lit("")) for f in parsed.schema if f.dataType.typeName() == "string"})


def read_delta(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return _jar_format(spark, "delta", path, {} if version is None else {"versionAsOf": str(version)})


def read_iceberg(spark: SparkSession, path: str, snapshot_id: int | None = None) -> DataFrame:
    return _jar_format(spark, "iceberg", path, {} if snapshot_id is None else {"snapshot-id": str(snapshot_id)})


def _jar_format(spark: SparkSession, kind: str, path: str, options: dict[str, str]) -> DataFrame:
    try:
        return spark.read.format(kind).options(**options).load(path)
    except Exception as e:
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find" in str(e):
            raise RuntimeError(f"reading {kind} needs its jar on the class path") from e
        raise


def write_table_format(df: DataFrame, kind: str, path: str, mode: str = "append", overwrite_schema: bool = False) -> None:
    """Delta or Iceberg, where their jar is there."""
    try:
        df.write.format(kind).mode(mode).option("overwriteSchema", overwrite_schema).save(path)
    except Exception as e:
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find" in str(e):
            raise RuntimeError(f"writing {kind} needs its jar on the class path") from e
        raise


def read_any(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame:
    kind = kind or detect_format(spark, path)
    if kind == "csv":
        sep = "\t" if path.lower().removesuffix(".gz").endswith(".tsv") else ","
        return read_csv(spark, path, **({"sep": sep} | options))
    if kind in ("delta", "iceberg"):
        return {"delta": read_delta, "iceberg": read_iceberg}[kind](spark, path, **options)
    readers = {"json": read_json, "parquet": read_parquet, "xml": read_xml}
    return readers[kind](spark, path, **options) if kind in readers else spark.read.format(kind).options(**options).load(path)


def read_all(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Several sources in one table whose columns and types are the relaxed union of theirs."""
    return union_relaxed([read_any(spark, p, **options) for p in paths])


def register(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    df = read_any(spark, path, **options)
    df.createOrReplaceTempView(name)
    return df


def list_files(spark: SparkSession, path: str, where: str | None = None, pattern: str | None = None) -> DataFrame:
    """path, name, modified, size of every file below; the contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    df = (r.option("pathGlobFilter", pattern) if pattern else r).load(path)
    df = df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    return df.where(where) if where else df


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([size_of(p) for p in batch.column("path").to_pylist()], pa.int64())], ["path", "size"])


def named_files(paths: DataFrame) -> DataFrame:
    """(path, size) of the files that paths(path) names; the size of one that isn't there is null. Tasks ask for each file,
    for listings lack empty files, which Spark passes over, and can't show that one is missing."""
    return paths.select(F.col("path").cast("string").alias("path")).mapInArrow(_sizes, "path string, size long")


def check_paths(spark: SparkSession, paths: DataFrame | list[str], largest: int = 5 * 1024**3) -> DataFrame:
    """path, size, problem (missing, empty, too large or null) of named files."""
    named = spark.createDataFrame([(p,) for p in paths], "path string") if isinstance(paths, list) else paths
    return check_files(named_files(named), largest)


def check_files(listing: DataFrame, largest: int = 5 * 1024**3) -> DataFrame:
    """Listing with `problem`: missing (no size), empty, too large, or null."""
    return listing.withColumn("problem", F.when(F.col("size").isNull(), "missing").when(F.col("size") == 0, "empty").when(F.col("size") > largest, "too large"))


def _members(pattern: str):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary())])

        def parts(path: str, data: bytes) -> Iterator[tuple[str, bytes]]:
            if zipfile.is_zipfile(io.BytesIO(data)):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    yield from ((i.filename, z.read(i)) for i in z.infolist() if not i.is_dir() and fnmatch.fnmatch(i.filename, pattern))
            else:
                with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
                    yield from ((m.name, t.extractfile(m).read()) for m in t if m.isfile() and fnmatch.fnmatch(m.name, pattern))

        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for name, content in parts(path, data.as_py()):
                    yield pa.RecordBatch.from_pylist([{"archive": path, "member": name, "size": len(content), "content": content}], schema=schema)

    return members


def archive_members(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """archive, member, size, content of the members of zip and tar archives below a path whose inner name fits.

    A member is one value, of 2 GB at most; archives.member_parts and member_lines read larger ones.
    """
    parts = archives.member_parts(archives.archive_index(spark, path, pattern), pattern, (1 << 31) - 1)
    return parts.select("archive", "member", F.octet_length("content").cast("long").alias("size"), "content")


def members_of(archives: DataFrame, pattern: str = "*") -> DataFrame:
    """The same of archives(path, content). Each is read in one task from one value, which holds 2 GB at most: Spark refuses larger files."""
    return archives.select("path", "content").mapInArrow(_members(pattern), "archive string, member string, size long, content binary")


def member_rows(members: DataFrame, schema: str, kind: str = "csv", header: bool = True) -> DataFrame:
    """The lines of archive members parsed as CSV or one JSON object a line, with archive and member."""
    lines = members.select("archive", "member", F.posexplode(F.split(F.decode("content", "UTF-8"), r"\r?\n")).alias("n", "line")).where("line != ''")
    if kind == "csv" and header:
        lines = lines.where("n > 0")
    parsed = F.from_csv("line", schema) if kind == "csv" else F.from_json("line", schema)
    return lines.select("archive", "member", parsed.alias("x")).select("archive", "member", "x.*")


def lineage(df: DataFrame, name: str = "_source", label: str | None = None) -> DataFrame:
    """Where rows come from: a constant label, or the file's path; of archive members archive::member."""
    if label is not None:
        return df.withColumn(name, F.lit(label))
    if "member" in df.columns and "archive" in df.columns:
        return df.withColumn(name, F.concat_ws("::", "archive", "member"))
    return df.select("*", F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias(name))


def shard_count(rows: int, columns: int, cells: int = 20_000_000, least: int = 50_000) -> int:
    """Shards of at most so many cells, but of so many rows at least, and one at least."""
    return max(1, min(-(-rows * columns // cells), rows // least or 1))


def hash_shard(df: DataFrame, n: int, keys: list[str] | None = None) -> Column:
    """The shard of a row, by its keys or all its columns."""
    return F.pmod(F.xxhash64(*(keys or df.columns)), F.lit(n)).cast("int")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "snappy", rows_per_file: int = 0, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", rows_per_file).partitionBy(*(partition_by or [])).parquet(path)


def write_text(df: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """CSV with a header, or one JSON object a line."""
    w = df.write.mode(mode)
    w.option("header", True).csv(path) if kind == "csv" else w.json(path)


def convert(spark: SparkSession, source: str, target: str, kind: str = "parquet", partition_by: list[str] | None = None, **options) -> None:
    df = read_any(spark, source, **options)
    df.write.mode("overwrite").format(kind).partitionBy(*(partition_by or [])).save(target)


def written(df: DataFrame, path: str) -> int:
    """Writes df and returns its rows, counted on their way in: no second scan of source or result."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get.get("rows") or 0


def stage_and_verify(df: DataFrame, folder: str, expected: int | None = None) -> DataFrame:
    """Writes a new version folder and reads it back; an unexpected count, taken in the write, is an error and the version is not for use."""
    path = f"{folder}/version={uuid.uuid4().hex}"
    n = written(df, path)
    if expected is not None and n != expected:
        raise ValueError(f"staged {n} rows, expected {expected}")
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._weir_path = path
    return staged


def publish(staged: DataFrame, folder: str) -> None:
    """Makes a staged version the current one: a pointer file is written beside the old one and renamed over it in one step."""
    spark = staged.sparkSession
    fs, new = file_system(spark, f"{folder}/NEXT-{uuid.uuid4().hex}")
    out = fs.create(new)
    out.write(bytearray(staged._weir_path.rpartition("/")[2].encode()))
    out.close()
    _rename_over(spark, new, f"{folder}/CURRENT")


def _rename_over(spark: SparkSession, new, target: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, hadoop.Path(target), how)


def current(spark: SparkSession, folder: str) -> DataFrame:
    name = spark.read.text(f"{folder}/CURRENT").first().value
    return spark.read.parquet(f"{folder}/{name}")


def promote_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replaces just the partitions that df holds. df must not read from path."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def load_log_buffer(spark: SparkSession, path: str, target: str | None = None) -> DataFrame:
    """A JSON-lines buffer with its nested columns as JSON text, appended to a Parquet table if one is named."""
    df = read_json(spark, path)
    nested = {f.name: F.to_json(f.name) for f in df.schema if f.dataType.typeName() in ("struct", "array", "map")}
    df = df.withColumns(nested)
    if target:
        df.write.mode("append").parquet(target)
    return df

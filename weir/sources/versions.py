"""Tables as numbered versions, each a list of Parquet files. Writers commit a version against the one that they read."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.archive import retention
from weir.operators.merge import MergeError, Policy, apply_policy, like, require_unique, unique, verify
from weir.sources.files import file_system, stage_and_verify, written
from weir.sources.scratch import scratch


class Conflict(RuntimeError):
    """Another writer has committed since the base was read."""


@dataclass(frozen=True)
class Version:
    """files: the folder of its list (file, rows). batches: the last batch that each writer of batches has committed."""

    number: int
    columns: str
    files: str
    operation: str
    rows: int
    kept: int
    added: int
    removed: int
    at: str
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


def latest(spark: SparkSession, folder: str) -> Version | None:
    fs, path = file_system(spark, f"{folder}/versions/*.json")
    names = sorted(f.getPath().getName() for f in fs.globStatus(path) or [])
    return version(spark, folder, int(names[-1].partition(".")[0])) if names else None


def version(spark: SparkSession, folder: str, number: int) -> Version:
    fs, path = file_system(spark, f"{folder}/versions/{number:020}.json")
    stream = fs.open(path)
    try:
        return Version(**json.loads(bytes(stream.readAllBytes())))
    finally:
        stream.close()


def files_of(spark: SparkSession, folder: str, v: Version) -> DataFrame:
    """(file, rows); a file is named from the table's folder on."""
    return spark.read.schema("file string, rows long").parquet(f"{folder}/{v.files}")


def _read_files(spark: SparkSession, folder: str, schema: T.StructType, files: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{folder}/{f}" for f in files)) if files else spark.createDataFrame([], schema)


def _names(df: DataFrame) -> list[str]:
    """As in any scan, the driver holds the names of files, not their rows."""
    return sorted(r.file for r in df.select("file").collect())


def read(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """The table, or how it was in a version. Columns that came later are null in older files."""
    v = latest(spark, folder) if number is None else version(spark, folder, number)
    if v is None:
        raise FileNotFoundError(f"no version in {folder}")
    return _read_files(spark, folder, v.schema, _names(files_of(spark, folder, v)))


def history(spark: SparkSession, folder: str) -> DataFrame:
    """number, operation, rows, kept, added and removed files, at of each version that is still there."""
    kinds = "number long, operation string, rows long, kept long, added long, removed long, at timestamp"
    return spark.read.schema(kinds).json(f"{folder}/versions")


@dataclass(frozen=True)
class Change:
    """What a writer makes of a base: new rows (None for none), the files that they replace, and a check of what was written."""

    rows: DataFrame | None
    replaced: list[str]
    schema: T.StructType
    check: Callable[[DataFrame], None] | None = None


def change(spark: SparkSession, folder: str, operation: str, of: Callable[[Version | None], Change | None], attempts: int = 5, batch: tuple[str, int] | None = None) -> Version | None:
    """Commits what `of` makes of the latest version. Where another writer was first, it is made again of that writer's
    version; after so many attempts that is a Conflict. batch: a writer and the number of its batch, which is
    committed once, however often it runs. Files of attempts that failed are in no version; expire() removes them.
    """
    for _ in range(attempts):
        base = latest(spark, folder)
        if batch and base and base.batches.get(batch[0], -1) >= batch[1]:
            return base
        made = of(base)
        if made is None:
            return base
        try:
            return _commit(spark, folder, base, made, operation, batch)
        except Conflict:
            continue
    raise Conflict(f"{folder}: others were first {attempts} times")


def _commit(spark: SparkSession, folder: str, base: Version | None, made: Change, operation: str, batch: tuple[str, int] | None) -> Version:
    lists = []
    if base:
        gone = spark.createDataFrame([(f,) for f in made.replaced], "file string")
        lists.append(files_of(spark, folder, base).join(gone, "file", "left_anti"))
    if made.rows is not None:
        place = f"data/{uuid.uuid4().hex}"
        rows = written(made.rows, f"{folder}/{place}")
        new = spark.read.schema(made.schema).parquet(f"{folder}/{place}")
        # no column is read for this, just the files' footers
        sizes = new.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name")).agg(F.count("*").alias("rows"))
        lists.append(sizes.select(F.concat(F.lit(f"{place}/"), "name").alias("file"), "rows").where("rows > 0"))
        if (found := sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) != rows:
            raise MergeError(f"{found} rows in the files, {rows} written")
        if made.check:
            made.check(new)
    listing = f"lists/{uuid.uuid4().hex}"
    whole = lists[0] if len(lists) == 1 else lists[0].unionByName(lists[1])
    whole.coalesce(1).write.parquet(f"{folder}/{listing}")  # a row a file
    counted = spark.read.schema("file string, rows long").parquet(f"{folder}/{listing}").agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    kept = (base.kept + base.added if base else 0) - len(made.replaced)
    batches = (base.batches if base else {}) | ({batch[0]: batch[1]} if batch else {})
    v = Version((base.number if base else 0) + 1, made.schema.json(), listing, operation, counted.rows, kept, counted.files - kept, len(made.replaced), datetime.now(UTC).isoformat(), batches)
    _put(spark, folder, v)
    return v


def _put(spark: SparkSession, folder: str, v: Version) -> None:
    """The version's file appears whole, under a name that only one writer can take: a rename that doesn't overwrite."""
    fs, draft = file_system(spark, f"{folder}/drafts/{uuid.uuid4().hex}.json")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(asdict(v)).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    fs.mkdirs(hadoop.Path(f"{folder}/versions"))
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, hadoop.Path(f"{folder}/versions/{v.number:020}.json"), none)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            fs.delete(draft, False)
            raise Conflict(f"{folder}: version {v.number} is taken") from e
        raise


def replace(spark: SparkSession, folder: str, df: DataFrame, cluster: list[str] | None = None, files: int | None = None, operation: str = "replace") -> Version:
    """A version of the rows of df alone. cluster: rows near by these columns share files, so that later merges touch few; files: how many."""
    rows = df if cluster is None else df.repartitionByRange(*([files] if files else []), *cluster)
    return change(spark, folder, operation, lambda base: Change(rows, _names(files_of(spark, folder, base)) if base else [], df.schema))


def touched(spark: SparkSession, folder: str, v: Version, staging: DataFrame, keys: list[str]) -> list[str]:
    """The files that hold a row with one of staging's keys; only key columns are read, between staging's least and greatest."""
    table = read(spark, folder, v.number)
    wanted = staging.select(*(F.col(f"`{k}`").cast(table.schema[k].dataType).alias(k) for k in keys)).dropna().distinct()
    ends = wanted.agg(*(f(f"`{k}`").alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("a", F.min), ("b", F.max)))).first()
    if ends is None or ends.a0 is None:
        return []
    near = table.select(*(f"`{k}`" for k in keys), F.col("_metadata.file_path").alias("__file"))
    for i, k in enumerate(keys):
        near = near.where(F.col(f"`{k}`").between(F.lit(ends[f"a{i}"]), F.lit(ends[f"b{i}"])))
    found = near.join(wanted, keys, "left_semi").select(F.array_join(F.slice(F.split("__file", "/"), -3, 3), "/").alias("file")).distinct()
    return _names(found)


def merge(spark: SparkSession, folder: str, staging: DataFrame, p: Policy, deleted_at: Column | None = None, late: bool = False, attempts: int = 5, batch: tuple[str, int] | None = None, add_columns: bool = False) -> Version | None:
    """Merges staging by a policy into the table, whose version is made of the files that no staged key touches, as they
    are, and of new files for the rest. The first merge makes the table. Marking what staging lacks and a full refresh touch all files.

    late: of a key's rows, those of the table included, the latest by p.latest_by wins, so that a late row never
    replaces a newer one. add_columns: columns that the table lacks are added, else left out. staging is written once.
    """
    held = stage_and_verify(staging, scratch(spark))

    def of(base: Version | None) -> Change | None:
        if base is None:
            if p.keys and not p.latest_by:
                require_unique(held, p.keys)
            first = unique(held, p.keys, p.latest_by) if p.keys and p.latest_by else held
            return Change(first, [], held.schema)
        new = [f for f in held.schema if f.name not in base.schema.names] if add_columns else []
        schema = T.StructType([*base.schema.fields, *new])
        everything = p.soft_delete or p.mode == "full_refresh"
        by = [p.update_key] if p.mode == "delete_insert" else p.keys
        files = _names(files_of(spark, folder, base)) if everything else touched(spark, folder, base, held, by)
        old = _read_files(spark, folder, schema, files)
        rows = held.select(*schema.names) if new else like(old, held)
        if p.mode == "insert":  # files with a staged key stay; only new keys are added
            if p.latest_by is None:
                require_unique(rows, p.keys)
            return Change(unique(rows, p.keys, p.latest_by).join(old.select(*p.keys), p.keys, "left_anti").select(*schema.names), [], schema)
        if p.mode == "update" and not files:
            return None
        merged = unique(old.unionByName(rows), p.keys, p.latest_by) if late else apply_policy(old, rows, p, deleted_at)
        return Change(merged, files, schema, lambda done: verify(done, rows, p, p.soft_delete, old))

    return change(spark, folder, p.mode, of, attempts, batch)


def delete_where(spark: SparkSession, folder: str, where: Column) -> Version | None:
    """Removes the rows that meet a condition; files without such rows stay."""

    def of(base: Version | None) -> Change | None:
        if base is None:
            return None
        hit = F.coalesce(where, F.lit(False))
        found = read(spark, folder, base.number).where(hit).select(F.array_join(F.slice(F.split("_metadata.file_path", "/"), -3, 3), "/").alias("file")).distinct()
        files = _names(found)
        return Change(_read_files(spark, folder, base.schema, files).where(~hit), files, base.schema) if files else None

    return change(spark, folder, "delete", of)


def compact(spark: SparkSession, folder: str, rows: int, cluster: list[str] | None = None) -> Version | None:
    """Rewrites the files of under half of so many rows as files of about so many."""

    def of(base: Version | None) -> Change | None:
        small = files_of(spark, folder, base).where(F.col("rows") < rows / 2) if base else None
        files = _names(small) if base else []
        if len(files) < 2:
            return None
        n = max(1, round(small.agg(F.sum("rows")).first()[0] / rows))
        old = _read_files(spark, folder, base.schema, files)
        return Change(old.repartitionByRange(n, *cluster) if cluster else old.repartition(n), files, base.schema)

    return change(spark, folder, "compact", of)


def expire(spark: SparkSession, folder: str, today: Column, days: int) -> int:
    """Removes versions other than the latest that are older than so many days, then the files that no version left lists
    and that are as old: also what failed writers left. The number of versions removed.
    """
    last = latest(spark, folder)
    if last is None:
        return 0
    old = retention(history(spark, folder).withColumn("day", F.to_date("at")), "day", today, days).where("expired").where(F.col("number") < last.number)
    gone = sorted(r.number for r in old.select("number").collect())
    for number in gone:
        v = version(spark, folder, number)
        for path in (f"{folder}/versions/{number:020}.json", f"{folder}/{v.files}"):
            fs, p = file_system(spark, path)
            fs.delete(p, True)
    lists = [f"{folder}/{version(spark, folder, r.number).files}" for r in history(spark, folder).select("number").collect()]
    listed = spark.read.schema("file string, rows long").parquet(*lists).select("file").distinct()
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{folder}/data")
    own = there.where(F.date_add(F.to_date("modificationTime"), days) < today).select(F.array_join(F.slice(F.split("path", "/"), -3, 3), "/").alias("file"))
    for r in own.join(listed, "file", "left_anti").toLocalIterator():
        fs, p = file_system(spark, f"{folder}/{r.file}")
        fs.delete(p, False)
    return len(gone)

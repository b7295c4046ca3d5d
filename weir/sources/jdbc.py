"""Database sources and sinks over JDBC."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weir.sources.ranged import size_of
from weir.sources.scratch import scratch


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None, fetch: int = 50_000) -> DataFrame:
    """A query that the database runs."""
    return spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", fetch).options(**(properties or {})).load()


def read_sharded(spark: SparkSession, url: str, table: str, key: str, shards: int, properties: dict[str, str] | None = None, hash_sql: str = "MOD({key}, {n})") -> DataFrame:
    """A table in so many parallel queries, each with the keys of one remainder; null keys go with the first.

    hash_sql: the database's own expression for a number; MOD of a whole number by default.
    """
    number = hash_sql.format(key=key, n=shards)
    number = f"ABS({number})"
    predicates = [f"{number} = {k}" + (f" OR {key} IS NULL" if k == 0 else "") for k in range(shards)]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, properties: dict[str, str] | None = None, expected: int | None = None, bulk: str | None = None) -> None:
    """Bulk load; the rows that the table gained must be as many as expected.

    bulk: the SQL by which the database itself loads a CSV file ({file}, without a header) into {table}. For a database that
    tasks can't reach: they write files into the shared folder, and it loads one after the other.
    """
    spark = df.sparkSession

    def count() -> int:
        with _connection(spark, url, properties or {}) as c:
            found = c.createStatement().executeQuery(f"SELECT COUNT(*) FROM {table}")
            found.next()
            return found.getLong(1)

    before = count() if expected is not None and mode == "append" else 0
    if bulk:
        df.limit(0).write.jdbc(url, table, mode=mode, properties=properties or {})  # makes the table; without rows there are no tasks
        _load_files(df, url, table, properties or {}, bulk)
    else:
        df.write.option("batchsize", batch).jdbc(url, table, mode=mode, properties=properties or {})
    if expected is not None and (n := count() - before) != expected:
        raise ValueError(f"{table}: {n} rows loaded, expected {expected}")


def read_by_quantiles(spark: SparkSession, url: str, table: str, key: str, shards: int, properties: dict[str, str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """A table in so many parallel queries, each with a range of the key that holds about as many rows as another's, however the
    keys, numbers or times, are spread; null keys go with the first. The bounds come from one query of the keys alone."""
    keys = read_query(spark, url, f"SELECT {key} FROM {table}", properties)
    name = keys.columns[0]
    found = keys.select(F.percentile_approx(name, [k / shards for k in range(1, shards)], accuracy)).first()[0] if shards > 1 else None
    bounds = sorted(set(found or []))
    text = [f"{{ts '{b}'}}" if isinstance(b, datetime) else f"{{d '{b}'}}" if isinstance(b, date) else str(b) for b in bounds]
    predicates = [f"{key} < {text[0]} OR {key} IS NULL", *(f"{key} >= {a} AND {key} < {b}" for a, b in zip(text, text[1:], strict=False)), f"{key} >= {text[-1]}"] if text else ["1 = 1"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


@contextmanager
def _connection(spark: SparkSession, url: str, properties: dict[str, str]) -> Iterator:
    """A connection of the driver's, in one transaction."""
    if "driver" in properties:
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    own = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        own.setProperty(k, v)
    c = spark._jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        c.setAutoCommit(False)
        yield c
        c.commit()
    except Exception:
        c.rollback()
        raise
    finally:
        c.close()


def _run(c, sql: str, *values: str) -> int:
    s = c.prepareStatement(sql)
    try:
        for k, v in enumerate(values, 1):
            s.setString(k, v)
        return s.executeUpdate()
    finally:
        s.close()


def _loaded(c, runs: str, run_id: str) -> bool:
    s = c.prepareStatement(f'SELECT "loaded" FROM {runs} WHERE "run_id" = ?')
    try:
        s.setString(1, run_id)
        return s.executeQuery().next()
    finally:
        s.close()


def _load_files(df: DataFrame, url: str, table: str, properties: dict[str, str], bulk: str) -> None:
    """Tasks write the rows, columns in the table's order; the database loads each file. A null is nothing, an empty text has quotes."""
    spark, folder = df.sparkSession, scratch(df.sparkSession)
    text = {"escape": '"', "nullValue": "", "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    df.write.options(**text).csv(folder)
    files = sorted(f for f in map(unquote, spark.read.schema("value string").text(folder).inputFiles()) if size_of(f))
    with _connection(spark, url, properties) as c:
        for f in files:
            f = "/" + f.removeprefix("file:").lstrip("/") if f.startswith("file:") else f
            _run(c, bulk.format(table=table, file=f.replace("'", "''")))


def load_once(df: DataFrame, url: str, table: str, run_id: str, properties: dict[str, str] | None = None, batch: int = 10_000, runs: str = "WEIR_RUNS", bulk: str | None = None) -> bool:
    """Adds the rows of a run to a table, once, however often it is called with one run_id; False if they were there.

    Tasks write to a staging table of the run, which is made anew, so that what a broken run left is gone. A task that ran
    twice leaves rows twice there: their number must be that of the rows sent, else this is an error and nothing is
    loaded. Then one transaction moves them and notes the run in the table `runs`, whose key no other call can take.
    The target is made if it isn't there. With `bulk` the database loads the staging table from files, as in write_table.
    """
    spark, properties = df.sparkSession, properties or {}
    stage = f"{re.sub('[^A-Za-z0-9_.]', '', table)}_STAGE_{hashlib.md5(run_id.encode()).hexdigest()[:12].upper()}"
    known = spark.createDataFrame([], "run_id string, loaded long")
    for name, like in ((runs, known), (table, df)):
        try:
            spark.read.jdbc(url, name, properties=properties).schema  # noqa: B018
        except Exception:
            w = like.limit(0).write
            (w.option("createTableColumnTypes", "run_id VARCHAR(255)") if name == runs else w).jdbc(url, name, mode="ignore", properties=properties)
    with _connection(spark, url, properties) as c:
        if _loaded(c, runs, run_id):
            return False
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if bulk:
        df.limit(0).write.jdbc(url, stage, mode="overwrite", properties=properties)
        _load_files(rows, url, stage, properties, bulk)
    else:
        rows.write.option("batchsize", batch).jdbc(url, stage, mode="overwrite", properties=properties)
    sent = seen.get.get("rows") or 0
    columns = ", ".join(f'"{c}"' for c in df.columns)
    with _connection(spark, url, properties) as c:
        done = not _loaded(c, runs, run_id)
        if done:
            moved = _run(c, f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}")
            if moved != sent:
                raise ValueError(f"{stage}: {moved} rows, {sent} sent")
            _run(c, f'INSERT INTO {runs} ("run_id", "loaded") VALUES (?, {moved})', run_id)
        _run(c, f"DROP TABLE {stage}")
    return done

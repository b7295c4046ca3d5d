"""Timed states, paged and cursor sources over restarts; loads into a database that happen once."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weir.sources import jdbc
from weir.streaming import jobs, paged, states

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


def test_terminal_states_leave_the_store_after_their_time(spark, tmp_path):
    schema, seen = "k string, at timestamp, status string", []

    def run(name, new, ttl):
        source, state = f"{tmp_path}/{name}/in", f"{tmp_path}/{name}/state"
        spark.createDataFrame(new, schema).write.mode("append").parquet(source)
        folded = states.timed_states(spark.readStream.schema(schema).parquet(source), "k", "at", "status", ["DONE"], ttl)
        query = states.run_states(folded, lambda batch, _: seen.extend(tuple(r) for r in batch.collect()), state)
        query.awaitTermination()
        out = sorted(seen)
        seen.clear()
        return out

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    assert run("kept", [("a", at(1), "NEW"), ("a", at(2), "DONE"), ("b", at(1), "NEW")], 3600) == [("a", at(2), "DONE"), ("b", at(1), "NEW")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert run("kept", [("a", at(9), "LATE"), ("b", at(0), "OLD")], 3600) == []  # a restart: still there, nothing changes
    assert run("kept", [("b", at(3), "RUN"), ("a", at(4), "DONE")], 3600) == [("a", at(4), "DONE"), ("b", at(3), "RUN")]
    assert run("left", [("a", at(2), "DONE")], 1) == [("a", at(2), "DONE")]
    time.sleep(2)
    assert run("left", [("a", at(0), "AGAIN")], 1) == [("a", at(0), "AGAIN")]  # the key had left


def _fetch(folder):
    def fetch(page):
        return [(page, x) for x in json.loads((folder / f"{page}.json").read_text())]

    return fetch


def _pages(folder):
    return lambda: len(list(folder.glob("*.json")))


def test_pages_are_read_once_over_restarts(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    spark.dataSource.register(paged.paged_source("units_pages", "page long, x long", _fetch(pages), _pages(pages)))
    for k, more in enumerate(([1, 2], [], [3])):
        (pages / f"{k}.json").write_text(json.dumps(more))
        if k != 1:
            for _ in range(2):
                jobs.append_to(spark.readStream.format("units_pages").load(), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(0, 1), (0, 2), (2, 3)]


def _follow(file):
    def follow(cursor):
        start = int(cursor or 0)
        new = json.loads(file.read_text())[start : start + 2]
        return [(x,) for x in new], str(start + len(new))

    return follow


def test_a_cursor_goes_on_where_it_was(spark, tmp_path):
    file = tmp_path / "rows.json"
    spark.dataSource.register(paged.cursor_source("units_cursor", "x long", _follow(file)))
    for upto in (3, 7):
        file.write_text(json.dumps(list(range(upto))))
        for _ in range(4):
            jobs.append_to(spark.readStream.format("units_cursor").load(), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(x,) for x in range(7)]


def test_a_run_is_loaded_once(spark):
    url = "jdbc:derby:memory:once;create=true"
    df = spark.range(10).select(F.col("id").alias("K"), F.concat(F.lit("v"), "id").alias("lower"))
    stage = "T_STAGE_" + __import__("hashlib").md5(b"run 1").hexdigest()[:12].upper()
    jdbc.write_table(df.limit(3), url, stage, "overwrite", properties=DERBY)  # left by a run that broke off
    assert [jdbc.load_once(df, url, "T", "run 1", DERBY) for _ in range(2)] == [True, False]
    assert jdbc.load_once(df.limit(0), url, "T", "run 0", DERBY)
    assert jdbc.load_once(df.where("K > 7"), url, "T", "run ' 2", DERBY)
    assert rows(jdbc.read_query(spark, url, 'SELECT K, "lower" FROM T', DERBY)) == sorted([*((k, f"v{k}") for k in range(10)), (8, "v8"), (9, "v9")], key=str)
    runs = dict(rows(jdbc.read_query(spark, url, "SELECT * FROM WEIR_RUNS", DERBY)))
    assert runs == {"run 1": 10, "run 0": 0, "run ' 2": 2}
    with pytest.raises(Exception):  # noqa: B017  the stage was dropped
        jdbc.read_query(spark, url, f"SELECT * FROM {stage}", DERBY).count()


def test_shards_by_quantiles_hold_all_rows_evenly(spark):
    url = "jdbc:derby:memory:quantiles;create=true"
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.pow(F.lit(2.0), F.col("id") / 100)).alias("K"), F.col("id").alias("V"))
    jdbc.write_table(df, url, "Q", "overwrite", properties=DERBY)
    found = jdbc.read_by_quantiles(spark, url, "Q", "K", 4, DERBY)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert rows(found.select("V")) == rows(df.select("V")) and len(sizes) == 4 and max(sizes) <= 350
    one = spark.range(5).select(F.lit(1).alias("K"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, id)").alias("T"))
    jdbc.write_table(one, url, "S", "overwrite", properties=DERBY)
    assert jdbc.read_by_quantiles(spark, url, "S", "K", 3, DERBY).count() == 5
    assert jdbc.read_by_quantiles(spark, url, "S", "T", 3, DERBY).count() == 5

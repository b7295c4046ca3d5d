"""Tables of versions: merges of touched files, commits against others, expiry, and streams into them."""

import pytest
from pyspark.sql import functions as F

from weir.operators import merge as M
from weir.sources import files as S
from weir.sources import versions as V
from weir.streaming import jobs

UPSERT = M.Policy("upsert", ["k"])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def folder(spark, tmp_path):
    """Keys 0 to 99 in ten files of ten."""
    path = f"file://{tmp_path}/a table"
    V.replace(spark, path, spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v")), ["k"], 10)
    return path


def some(spark, *pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def test_a_merge_rewrites_the_files_that_hold_its_keys(spark, folder):
    assert V.latest(spark, folder).added == 10
    before = V.read(spark, folder)
    staging = some(spark, (3, "new"), (4, None), (55, "new"), (1000, "more"), (None, "null"))
    v = V.merge(spark, folder, staging, UPSERT)
    assert (v.number, v.rows, v.kept, v.removed) == (2, 102, 8, 2)
    assert rows(V.read(spark, folder)) == rows(M.upsert(before, staging, ["k"]))
    assert rows(V.read(spark, folder, 1)) == rows(before)  # as it was
    v = V.merge(spark, folder, some(spark, (2000, "x")), M.Policy("insert", ["k"]))
    assert (v.rows, v.removed) == (103, 0)
    assert V.merge(spark, folder, some(spark, (2000, "y"), (7, "z")), M.Policy("insert", ["k"])).rows == 103
    v = V.merge(spark, folder, some(spark, (7, "seven"), (5000, "absent")), M.Policy("update", ["k"]))
    assert v.rows == 103 and v.removed == 1 and V.read(spark, folder).where("k = 7").first().v == "seven"
    assert V.merge(spark, folder, some(spark, (5000, "absent")), M.Policy("update", ["k"])).number == v.number
    v = V.delete_where(spark, folder, F.col("k") < 5)
    assert v.rows == 98 and V.delete_where(spark, folder, F.col("k") < 5).number == v.number
    with pytest.raises(M.MergeError):
        V.merge(spark, folder, some(spark, (1, "a"), (1, "b")), UPSERT)
    assert V.latest(spark, folder).number == v.number


def test_days_are_replaced_and_all_files_where_that_is_asked_for(spark, folder):
    v = V.merge(spark, folder, some(spark, (5, "a"), (5, "b")), M.Policy("delete_insert", update_key="k"))
    assert (v.rows, v.removed) == (101, 1)
    v = V.merge(spark, folder, some(spark, (1, "x")), M.Policy("full_refresh"))
    assert rows(V.read(spark, folder)) == [(1, "x")] and v.kept == 0


def test_new_columns_are_null_in_files_that_stay(spark, folder):
    more = some(spark, (5, "five")).withColumn("w", F.lit(1))
    assert V.merge(spark, folder, more, UPSERT).schema.names == ["k", "v"]
    assert V.merge(spark, folder, more, UPSERT, add_columns=True).schema.names == ["k", "v", "w"]
    assert V.read(spark, folder).where("w is not null").count() == 1 and V.read(spark, folder).count() == 100
    assert V.read(spark, folder, 1).columns == ["k", "v"]


def test_of_two_writers_none_loses_rows(spark, folder):
    """The second commits while the first has made its rows but not its version."""
    made = []

    def first(base):
        if not made:
            V.merge(spark, folder, some(spark, (200, "second"), (3, "second")), UPSERT)
        made.append(base.number)
        return V.Change(V.read(spark, folder, base.number).where("k = 3").withColumn("v", F.concat("v", F.lit("+first"))).unionByName(some(spark, (300, "first"))), V.touched(spark, folder, base, some(spark, (3, "")), ["k"]), base.schema)

    V.change(spark, folder, "first", first)
    assert made == [1, 2]  # made again of the second's version
    got = dict(rows(V.read(spark, folder)))
    assert got[200] == "second" and got[300] == "first" and got[3] == "second+first"
    assert [r.operation for r in V.history(spark, folder).orderBy("number").collect()] == ["replace", "upsert", "first"]
    made.clear()
    with pytest.raises(V.Conflict):
        V.change(spark, folder, "first", first, attempts=1)


def test_a_batch_is_committed_once(spark, folder):
    for number, k in ((0, 500), (0, 501), (1, 502), (0, 503)):
        V.merge(spark, folder, some(spark, (k, "b"), (None, "null")), UPSERT, batch=("stream", number))
    assert rows(V.read(spark, folder).where("k >= 500 or k is null")) == sorted([(500, "b"), (502, "b"), (None, "null"), (None, "null")], key=str)


def test_replayed_rows_without_a_key_come_once(spark, tmp_path):
    source, folder, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    schema = "k long, v string, at long"
    spark.createDataFrame([(1, "a", 1), (None, "n", 1), (1, "b", 2)], schema).write.parquet(source)
    for copy in ("state", "other"):  # the batch ran, but its end was not noted
        stream = spark.readStream.schema(schema).parquet(source)
        query = jobs.upsert_into(stream, folder, ["k"], "at", state)
        query.awaitTermination()
        if copy == "state":
            for n in ("0", ".0.crc"):
                (tmp_path / "state" / "commits" / n).unlink()
    assert rows(V.read(spark, folder)) == sorted([(1, "b", 2), (None, "n", 1)], key=str)


def test_compaction_and_expiry(spark, folder, tmp_path):
    for k in range(3):
        V.merge(spark, folder, some(spark, (1000 + k, "x")), UPSERT)
    v = V.compact(spark, folder, 50, ["k"])
    assert v.rows == 103 and v.removed == 13 and v.added == 2 and V.compact(spark, folder, 50) .number == v.number
    S.written(spark.range(5), f"{folder}/data/left")  # by a writer that failed
    files = lambda: len(list((tmp_path / "a table" / "data").rglob("*.parquet")))
    assert V.expire(spark, folder, F.current_date(), 30) == 0 and files() > 13
    assert V.expire(spark, folder, F.date_add(F.current_date(), 31), 30) == 4 and files() == 2
    assert V.read(spark, folder).count() == 103 and V.history(spark, folder).count() == 1
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        V.read(spark, folder, 1)


def test_rows_are_counted_in_the_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(once, "id long")
    assert S.stage_and_verify(df, f"file://{tmp_path}/t", 1000).count() == 1000 and seen.value == 1000
    assert S.stage_and_verify(df.limit(0), f"file://{tmp_path}/t", 0).count() == 0
    with pytest.raises(ValueError, match="staged 1000"):
        S.stage_and_verify(df, f"file://{tmp_path}/t", 7)

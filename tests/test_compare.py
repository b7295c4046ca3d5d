"""Checksum trees and profiles against plain ones."""

import math
from datetime import date

from pyspark.sql import functions as F

from weir.operators import compare as C


def one(df):
    return df.first().asDict()


def test_only_rows_of_differing_buckets_are_joined(spark):
    a = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("s"))
    b = a.where("k <> 5").withColumn("v", F.when(F.col("k") == 9, -1).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(None, 1, "x"), (9999, 2, None)], "k long, v long, s string"))
    for leaves, fan in ((4096, 16), (1000, 7), (1, 2)):
        found, want = one(C.compare_drilldown(a, b, ["k"], leaves=leaves, fan=fan)), one(C.compare_report(a, b, ["k"]))
        joined = found.pop("joined_rows")
        assert found == want and (joined < 100 if leaves > 1 else joined == 6001)
    same = one(C.compare_drilldown(a, a.repartition(3), ["k"]))
    assert same["joined_rows"] == 0 and not same["has_drift"] and same["matched"] == 3000 and same["match_percent"] == 100.0
    assert one(C.compare_drilldown(a.limit(0), a, ["k"]))["missing_in_a"] == 3000
    none = one(C.compare_drilldown(a.limit(0), a.limit(0), ["k"]))
    assert none["rows_a"] == none["rows_b"] == none["joined_rows"] == 0


def test_few_rows_are_joined_of_large_tables_too(spark):
    a = spark.range(800_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    b = a.where("k % 50 <> 3").withColumn("v", F.when(F.col("k") % 50 == 7, -1).otherwise(F.col("v")))
    found, want = one(C.compare_drilldown(a, b, ["k"])), one(C.compare_report(a, b, ["k"]))
    assert 48_000 <= found.pop("joined_rows") < 0.25 * 800_000 and found == want
    trees = [C.checksum_tree(x, ["k"]).cache() for x in (a, b)]
    found = one(C.compare_drilldown(a, b, ["k"], trees=trees))
    assert found.pop("joined_rows") < 0.25 * 800_000 and found == want


def test_kept_trees_tell_what_changed(spark):
    a = spark.range(500).select(F.col("id").alias("k"), F.col("id").alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    trees = [C.checksum_tree(x, ["k"], leaves=256, fan=4).cache() for x in (a, b)]
    assert trees[0].where("level = 0").first().rows == 500 and trees[0].agg(F.max("level")).first()[0] == 4
    want = a.where("k = 77").select(F.pmod(C._hash(["k"]), F.lit(256))).first()[0]
    assert [r.bucket for r in C.differing_leaves(*trees, 4).collect()] == [want]


def test_profiles_of_parts_are_the_profile_of_the_whole(spark):
    rows = [("p", 1, 1.5, "a", date(2024, 1, 1), [1]), ("p", None, math.nan, None, None, None), ("q", 2, -0.0, "b", date(2023, 1, 1), [1]), ("q", 1, 0.0, "é", None, []), (None, 3, math.nan, "a", date(2025, 1, 1), [2])]
    df = spark.createDataFrame(rows, "part string, i int, x double, s string, d date, l array<int>")
    parts = C.profile(df, F.col("part"))
    assert parts.count() == 3 * 6
    key = lambda df: sorted(map(str, df.collect()))
    assert key(C.merged_profile(parts)) == key(C.merged_profile(C.profile(df)))
    got = {r.column: r for r in C.merged_profile(parts).collect()}
    assert (got["x"].low, got["x"].high, got["x"].nulls, got["x"].distinct) == (0.0, 1.5, 0, 3)
    assert (got["i"].low, got["i"].high, got["i"].nulls, got["i"].distinct, got["i"].rows) == (1.0, 3.0, 1, 3, 5)
    assert (got["s"].low_text, got["s"].high_text, got["l"].distinct, got["d"].nulls) == ("a", "é", 3, 2)
    exact = {r.column: (r.type, r.rows, r.nulls, r.distinct) for r in C.exact_profile(df).collect()}
    assert exact == {"part": ("string", 5, 1, 2), "i": ("int", 5, 1, 3), "x": ("double", 5, 0, 3), "s": ("string", 5, 1, 3), "d": ("date", 5, 2, 3), "l": ("array<int>", 5, 1, 3)}
    assert {tuple(r)[2:] for r in C.exact_profile(df.limit(0)).collect()} == {(0, 0, 0)}
    more = df.select("i").withColumn("new", F.lit("z"))
    both = {r.column: (r.rows, r.nulls) for r in C.merged_profile(C.profile(df.drop("part"), F.lit("a")).unionByName(C.profile(more, F.lit("b")))).collect()}
    assert both["new"] == (10, 5) and both["i"] == (10, 2)


def test_a_larger_table_is_redealt_in_more_parts(spark):
    from weir.plans.queries_compare import _redealt  # noqa: PLC0415

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        assert _redealt(spark.range(2_000_000)).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset(size)

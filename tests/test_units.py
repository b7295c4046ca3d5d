"""Edge cases of operators, with rows written by hand."""

import gzip
import io
import subprocess
import sys
import tarfile
import zipfile
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weir.functions import columns as C
from weir.functions.types import apply_contract, common_type, union_relaxed
from weir.operators import archive as A
from weir.operators import compare, logs
from weir.operators import incremental as W
from weir.operators import merge as M
from weir.operators import query as Q
from weir.operators import tables as TB
from weir.plans.job import Job, run_and_publish
from weir.plans.transform import Step, run_steps
from weir.sources import files as S
from weir.sources import jdbc
from weir.sources import versions as V
from weir.streaming import jobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, v string")


@pytest.fixture
def staging(spark):
    return spark.createDataFrame([(2, "B"), (3, None), (4, "d"), (None, "N")], "k int, v string")


def test_update_takes_nulls_and_never_matches_null_keys(target, staging):
    assert rows(M.update(target, staging, ["k"])) == sorted([(1, "a"), (2, "B"), (3, None), (None, "n")], key=str)


def test_insert_new_adds_null_keys(target, staging):
    assert rows(M.insert_new(target, staging, ["k"])) == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (4, "d"), (None, "N")], key=str)


def test_upsert(target, staging):
    merged = M.upsert(target, staging, ["k"])
    assert rows(merged) == sorted([(1, "a"), (2, "B"), (3, None), (None, "n"), (4, "d"), (None, "N")], key=str)
    whole = staging.where("k is not null")
    once = M.upsert(target, whole, ["k"])
    assert rows(M.upsert(once, whole, ["k"])) == rows(once)
    assert rows(M.upsert(target, staging.limit(0), ["k"])) == rows(target)


def test_upsert_of_doubles(spark, target):
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "k int, v string, at int")
    with pytest.raises(M.MergeError):
        M.upsert(target, twice, ["k"])
    assert (2, "y") in rows(M.upsert(target, twice, ["k"], latest_by="at"))


def test_delete_insert_keeps_other_days_and_nulls(spark):
    t = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d3"), (4, None)], "k int, d string")
    s = spark.createDataFrame([(5, "d2"), (6, "d4")], "k int, d string")
    assert rows(M.delete_insert(t, s, "d")) == sorted([(1, "d1"), (3, "d3"), (4, None), (5, "d2"), (6, "d4")], key=str)


def test_soft_delete_is_null_aware(spark):
    t = spark.createDataFrame([(1, "d1", None), (2, "d1", None), (3, "d1", datetime(2020, 1, 1)), (4, "d2", None)], "k int, d string, _is_deleted timestamp_ntz")
    at = F.lit("2024-01-01 00:00:00")
    gone = M.soft_delete(t, spark.createDataFrame([(1,)], "k int"), ["k"], at, scope=F.col("d") == "d1")
    assert {r.k: r._is_deleted for r in gone.collect()} == {1: None, 2: datetime(2024, 1, 1), 3: datetime(2020, 1, 1), 4: None}
    none = M.soft_delete(t, spark.createDataFrame([(1,), (None,)], "k int"), ["k"], at)
    assert rows(none) == rows(t)


def test_schema_rules(spark, target):
    with pytest.raises(M.MergeError):
        M.full_refresh(target, target.drop("v"))
    wide = target.withColumns({"c": F.lit(1), "_run_id": F.lit("r")})
    assert M.reconcile(target, wide, add_new=False) == M.Evolution([("_run_id", "string")], ["c"])
    assert M.reconcile(target, wide, add_new=True).added == [("c", "int"), ("_run_id", "string")]
    with pytest.raises(M.MergeError):
        M.policy_for("SNAPSHOT")
    with pytest.raises(M.MergeError):
        M.policy_for("DELTA", "update")


def test_verify(spark, target, staging):
    p = M.policy_for("CDC", keys=["k"])
    M.verify(M.apply_policy(target, staging, p), staging, p)
    with pytest.raises(M.MergeError):
        M.verify(target, staging, p)
    p = M.policy_for("DELTA", "update", keys=["k"])  # the target lacks key 4
    M.verify(M.apply_policy(target, staging, p), staging, p, target=target)
    assert tuple(M.verification(target.where("k <> 2"), staging, p, target=target).first()) == (2, 1, False)
    with pytest.raises(M.MergeError):
        M.verification(target, staging, p)


def test_a_day_of_several_sources_has_one(spark, target):
    sources = spark.createDataFrame([(date(2024, 1, 1), "b"), (date(2024, 1, 1), "a")], "partition_date date, source string")
    out = C.add_metadata(target, {"source": True}, partition_date=F.lit("2024-01-01").cast("date"), source=sources)
    assert out.count() == target.count() and {r._source for r in out.collect()} == {"a"}


def test_not_in_with_nulls(spark):
    a = spark.createDataFrame([(1, 1), (1, None), (2, 2), (None, None), (3, None)], "x int, y int")
    a.createOrReplaceTempView("na")
    for other in ([(1, 1)], [(1, None)], [(None, None)], [(2, None), (1, 1)], []):
        b = spark.createDataFrame(other, "x int, y int")
        b.createOrReplaceTempView("nb")
        assert rows(Q.not_in(a, b, ["x", "y"])) == rows(spark.sql("SELECT * FROM na WHERE (x, y) NOT IN (SELECT x, y FROM nb)")), other


def test_query_errors(spark, target):
    with pytest.raises(ValueError):
        Q.run(spark, Q.Block(table="missing"), {"t": target})
    with pytest.raises(ValueError):
        Q.predicate(("k", "~~", 1))
    with pytest.raises(ValueError):
        run_steps(spark, [Step("a", ["nothing"], transformer="masking", params={"columns": []})], {"t": target})
    with pytest.raises(TypeError):
        run_steps(spark, [Step("a", ["t"], function=lambda df: 1)], {"t": target})


def test_union_relaxed(spark):
    a = spark.createDataFrame([(1, 100)], "id int, val int")
    b = spark.createDataFrame([(2, "error", True)], "id long, val string, more boolean")
    out = union_relaxed([a, b])
    assert out.dtypes == [("id", "bigint"), ("val", "string"), ("more", "boolean")]
    assert rows(out) == [(1, "100", None), (2, "error", True)]
    assert common_type([]).simpleString() == "string"


def test_contract(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-02 10:11:12")], "a string, b string, t string")
    out = apply_contract(df, {"a": "integer", "b": "integer", "t": "time"})
    assert rows(out) == [(1, None, "10:11:12")]
    with pytest.raises(Exception):  # noqa: B017
        apply_contract(df, {"b": "integer"}, strict=True).collect()


def test_flatten_and_json(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 1, 'y', named_struct('z', 'w')) AS s")
    assert C.flatten(df).columns == ["id", "s_x", "s_y_z"]
    assert C.flatten(df, 1).columns == ["id", "s_x", "s_y"]
    assert C.flatten(df, -1).columns == ["id", "s"]
    texts = spark.createDataFrame([('{"k": 1}', "plain"), ("{}", "a"), (None, "b")], "j string, p string")
    out = C.parse_json(texts)
    assert out.schema["p"].dataType.simpleString() == "string"
    assert [r.j.k if r.j else None for r in out.collect()] == [1, None, None]


def test_names():
    assert C.renamed(["orderDate", "XMLParser", "order_date", "Order-Date", "_keep"]) == ["order_date", "xml_parser", "order_date_1", "order_date_2", "_keep"]
    assert C.renamed(["order_date"], "camel", "caps") == ["OrderDate"]
    assert C.renamed(["order_date"], "camel", "none") == ["orderDate"]
    assert C.renamed(["orderDate"], "kebab", "upper") == ["ORDER-DATE"]
    with pytest.raises(ValueError):
        C.styled_name("a", "camel", "lower")


def test_null_words_and_quarantine(spark):
    df = spark.createDataFrame([("NA", 1), ("x", None), (None, 3)], "s string, n int")
    assert rows(C.null_if(df, ["NA", "n/a"])) == sorted([(None, 1), ("x", None), (None, 3)], key=str)
    good, bad = C.quarantine(df, {"n": F.col("n") > 0, "s": F.col("s").isNotNull()})
    assert rows(good) == [("NA", 1)]
    assert {(r.s, r.quarantine_reason) for r in bad.collect()} == {("x", "n"), (None, "s")}


def test_compare(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (5, "q")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (1, "x"), (3, None), (4, "w")], "k int, v string")
    r = compare.compare_report(a, b, ["k"]).first()
    assert (r.matched, r.mismatched, r.missing_in_a, r.missing_in_b, r.match_percent, r.has_drift) == (2, 1, 1, 1, 66.67, True)
    assert compare.tables_equal(a, a.repartition(3)) and not compare.tables_equal(a, b)
    pairs = spark.createDataFrame([(7, "p"), (7, "p")], "k int, v string")
    assert not compare.tables_equal(a, a.union(pairs))  # equal rows cancel in an xor
    assert compare.checksum(a).first().total != compare.checksum(a.union(pairs)).first().total


def test_cron():
    values, by_day, by_weekday = logs.cron_values("*/15 8-17 * * 1-5")
    assert values[0] == [0, 15, 30, 45] and values[1] == list(range(8, 18)) and values[4] == [1, 2, 3, 4, 5] and not by_day and by_weekday
    assert logs.cron_values("0 0 * * 7")[0][4] == [0]
    for bad in ("* * * *", "61 * * * *", "*/0 * * * *"):
        with pytest.raises(ValueError):
            logs.cron_values(bad)


def test_state_fold_keeps_terminal_states(spark):
    log = spark.createDataFrame([("a", 1, "RUNNING"), ("a", 2, "SUCCESS"), ("a", 3, "RUNNING"), ("b", 1, "QUEUED"), ("b", 2, "RUNNING")], "k string, at int, status string")
    assert rows(logs.state_fold(log, ["k"], "at", "status", ["SUCCESS", "FAILED"])) == [("a", 2, "SUCCESS"), ("b", 2, "RUNNING")]


def test_catchup(spark):
    days = lambda *a: [r[0] for r in W.catchup_dates(spark, *a).collect()]
    assert days("2024-02-27", "2024-03-01") == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert days("2024-03-01", "2024-03-01") == days("nonsense", "2024-03-01") == days(None, "2024-03-01") == [date(2024, 3, 1)]


def test_orphans_need_manifests(spark):
    vault = spark.createDataFrame([("h1",), ("h2",)], "content_hash string")
    assert rows(A.orphans(vault, vault.where("content_hash = 'h1'"))) == [("h2",)]
    with pytest.raises(ValueError):
        A.orphans(vault, vault.limit(0))


def test_csv_encodings_and_bad_rows(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfheader,value\n1,2\n")
    assert S.read_csv(spark, f"{tmp_path}/bom.csv").columns == ["header", "value"]
    (tmp_path / "latin.csv").write_bytes("héader,valué\n1,2\n".encode("latin-1"))
    assert S.read_csv(spark, f"{tmp_path}/latin.csv", encoding="ISO-8859-1").columns == ["héader", "valué"]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nx,3\n4\n5,6\n")
    bad = S.read_csv(spark, f"{tmp_path}/bad.csv", "a int, b int, _bad string", corrupt="_bad").cache()
    assert bad.where("_bad is not null").count() == 2
    assert S.read_csv(spark, f"{tmp_path}/bad.csv", "a int, b int", skip_bad=True).collect() == [(1, 2), (5, 6)]


def test_json_and_xml(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(S.read_json(spark, f"{tmp_path}/a.json", array=True)) == [(1,), (2,)]
    (tmp_path / "x.xml").write_bytes(b"<root>\x00<item><v> Valid\ndata </v><w/></item><item><v>2</v></item></root>")
    assert [r.v for r in S.read_xml(spark, f"{tmp_path}/x.xml", "item", "v string, w string").collect()] == ["Valid\ndata", "2"]
    fixed = spark.createDataFrame([('{"items": [1, 2, ], "meta": "test", }',)], "j string").select(C.repair_json(F.col("j"))).first()[0]
    assert fixed == '{"items": [1, 2], "meta": "test"}'


def test_json_shape_is_read_from_each_file(spark, tmp_path):
    whole, lines = '\ufeff \n[{"a": 1},\n {"a": 2}]', '{"a": 1}\n{"a": 2}\n'
    for name, data, array in (("w.json", whole, True), ("l.json", lines, False), ("l.jsonl", whole, False), ("e.json", "", False), ("b.json", " \n", False)):
        (tmp_path / name).write_text(data, encoding="utf-8")
        assert [r.is_array for r in S.json_shapes(spark, f"{tmp_path}/{name}").collect()] == ([array] if data else []), name
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(whole.encode()))
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "_note").write_text("{")
    (tmp_path / "many" / "a.json").write_text("")
    (tmp_path / "many" / "b.json").write_text('[{"a": 1}, {"a": 2}]')
    for name in ("w.json", "l.json", "z.json.gz", "many", "many/*.json"):
        assert rows(S.read_any(spark, f"{tmp_path}/{name}", "json", schema="a int")) == [(1,), (2,)], name
    (tmp_path / "many" / "c [1].json").write_text('{"b": 3}')
    (tmp_path / "many" / "d.json").write_text('[{"a": 4,\n "b": "x"}]')
    assert rows(S.read_json(spark, f"{tmp_path}/many")) == sorted([(1, None), (2, None), (4, "x"), (None, "3")], key=str)
    assert S.detect_format(spark, f"{tmp_path}/many") == S.detect_format(spark, f"{tmp_path}/man*") == "json"


def test_peek_has_both_ends(spark):
    df = spark.range(100).repartition(4)
    assert [r.id for r in Q.peek(spark, df, "SELECT id FROM self ORDER BY id", 2).collect()] == [0, 1]
    assert [r.id for r in Q.peek(spark, df, "SELECT id FROM self ORDER BY id", 2, tail=True).collect()] == [98, 99]
    assert Q.peek(spark, df.limit(0), rows=2, tail=True).columns == ["id"]


def test_entry_point_goes_without_the_corpus_operators():
    code = """
import sys
sys.modules[sys.argv[1]] = None
import __spark_entry__ as e
assert "job_end_to_end" in e.queries() and not any(q.startswith("op1") or q == "pipeline" for q in e.queries() | e.oracle_sql())
"""
    for absent in ("weir.llm", "public_tokenizers", "tiktoken", "corpus_pipeline"):
        subprocess.run([sys.executable, "-W", "ignore", "-c", code, absent], check=True, cwd=Path(__file__).parents[1])


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("a/part_0.csv", "id,v\n1,x\n")
        z.writestr("a/part_1.csv", "id,v\n2,y\n")
        z.writestr("b/readme.md", "no")
    with tarfile.open(tmp_path / "q.tgz", "w:gz") as t:
        data = b"id,v\n3,z\n"
        info = tarfile.TarInfo("a/part_2.csv")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    members = S.archive_members(spark, str(tmp_path), "a/*.csv")
    parsed = S.lineage(S.member_rows(members, "id int, v string"))
    assert sorted((r.id, r.v, r._source.rpartition("::")[2]) for r in parsed.collect()) == [(1, "x", "a/part_0.csv"), (2, "y", "a/part_1.csv"), (3, "z", "a/part_2.csv")]


def test_detect_and_missing_jars(spark, tmp_path):
    (tmp_path / "d" / "_delta_log").mkdir(parents=True)
    (tmp_path / "i" / "metadata").mkdir(parents=True)
    assert S.detect_format(spark, f"{tmp_path}/d") == "delta" and S.detect_format(spark, f"{tmp_path}/i") == "iceberg"
    assert S.detect_format(spark, "/x/y.csv.gz") == "csv"
    with pytest.raises(RuntimeError):
        S.read_delta(spark, f"{tmp_path}/d", 3)
    with pytest.raises(RuntimeError):
        S.read_iceberg(spark, f"{tmp_path}/i", 4)


def test_files_are_checked(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "full.csv").write_text("abc")
    assert [r["name"] for r in S.check_files(S.list_files(spark, str(tmp_path)), largest=2).where("problem = 'too large'").collect()] == ["full.csv"]
    got = S.check_paths(spark, [f"{tmp_path}/{n}.csv" for n in ("empty", "full", "absent")], largest=3)
    assert [r.problem for r in got.collect()] == ["empty", None, "missing"]


def test_shards(spark):
    assert S.shard_count(0, 10) == 1 and S.shard_count(10_000_000, 20) == 10 and S.shard_count(60_000, 10_000) == 1


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc(spark):
    url = "jdbc:derby:memory:units;create=true"
    df = spark.range(100).select(F.col("id").alias("K"), (F.col("id") * 2).alias("V"))
    jdbc.write_table(df, url, "NUMBERS", "overwrite", properties=DERBY)
    jdbc.write_table(df, url, "NUMBERS", "append", properties=DERBY, expected=100)
    sharded = jdbc.read_sharded(spark, url, "NUMBERS", "K", 4, DERBY)
    assert sharded.rdd.getNumPartitions() == 4 and sharded.count() == 200
    assert jdbc.read_query(spark, url, "SELECT V FROM NUMBERS WHERE K < 3", DERBY).count() == 6
    with pytest.raises(ValueError):
        jdbc.write_table(df, url, "NUMBERS", "append", properties=DERBY, expected=99)


def test_tables(spark):
    for n in ("t_units", "t_like", "t_clone"):
        TB.drop_table(spark, n)
    TB.create_table(spark, "t_units", {"id": "integer", "day": "date"})
    spark.sql("INSERT INTO t_units VALUES (1, DATE '2024-01-01')")
    TB.add_columns(spark, "t_units", {"more": "string"})
    TB.like_table(spark, "t_units", "t_like")
    TB.clone_table(spark, "t_units", "t_clone")
    assert TB.list_columns(spark, "t_like") == ["id", "day", "more"] and spark.table("t_like").count() == 0 and spark.table("t_clone").count() == 1
    assert TB.table_exists(spark, "t_clone") and {"t_units", "t_like"} <= set(TB.list_tables(spark))
    assert TB.describe(spark, "t_units").count() == 3


def test_job_publishes_versions(spark, tmp_path):
    folder = f"file://{tmp_path}/target"
    job = Job(M.policy_for("CDC", keys=["id"]), contract={"id": "integer"}, null_if=["NA"], metadata={"run_id": True}, add_new_columns=True)
    first = spark.createDataFrame([("1", "x"), ("2", "NA")], "id string, v string")
    assert rows(run_and_publish(spark, first, folder, job, "r1")) == sorted([(1, "x", "r1"), (2, None, "r1")], key=str)
    second = spark.createDataFrame([("2", "y", True)], "id string, v string, more boolean")
    for _ in range(2):
        out = run_and_publish(spark, second, folder, job, "r2")
        assert {(r.id, r.v, r._run_id, r.more) for r in out.collect()} == {(1, "x", "r1", None), (2, "y", "r2", True)}
    assert run_and_publish(spark, second.limit(0), folder, job, "r3").count() == 2


def test_stream_restart_adds_nothing(spark, tmp_path):
    source, target, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    spark.createDataFrame([("e1", "p", 1), (None, "q", 2)], "event_id string, payload string, at long").write.json(source)
    for _ in range(2):
        jobs.append_to(jobs.clean(jobs.json_stream(spark, source, "event_id string, payload string, at long"), ["event_id"]), target, state).awaitTermination()
        assert spark.read.parquet(target).count() == 1


def test_update_and_insert_refuse_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "w"), (None, "n"), (None, "m")], "k int, v string")
    for f in (M.update, M.insert_new, M.upsert):
        with pytest.raises(M.MergeError):
            f(target, twice, ["k"])
    p = M.policy_for("DELTA", "update", keys=["k"], latest_by="v", soft_delete="gone")
    assert p.soft_delete == "gone"
    out = M.apply_policy(target.withColumn("gone", F.lit(None).cast("timestamp")), twice.withColumn("gone", F.lit(None).cast("timestamp")), M.Policy("update", ["k"], latest_by="v"))
    assert {(r.k, r.v) for r in out.collect()} == {(1, "y"), (2, "b")}
    with pytest.raises(M.MergeError):
        M.policy_for("FULL_REFRESH", soft_delete="gone")


def test_publishing_that_breaks_off_leaves_the_old_version(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    S.publish(S.stage_and_verify(spark.range(3), folder), folder)

    def breaks(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "_rename_over", breaks)
        with pytest.raises(OSError):
            S.publish(S.stage_and_verify(spark.range(5), folder), folder)
    assert S.current(spark, folder).count() == 3
    S.publish(S.stage_and_verify(spark.range(7), folder), folder)
    assert S.current(spark, folder).count() == 7


def test_json_is_judged_by_all_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") == 2500, "plain").otherwise('{"a": 1}').alias("late"), F.lit('{"a": 1}').alias("a b.c"), F.lit("").alias("blank"), F.lit("{a").alias("broken"))
    out = C.parse_json(df)
    assert [t for _, t in out.dtypes] == ["string", "struct<a:bigint>", "string", "string"]
    assert out.where("late = 'plain'").count() == 1


def test_late_rows_of_a_stream_don_t_replace_newer_ones(spark, tmp_path):
    source, folder, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    for rows in ([(1, "new", 9)], [(1, "old", 3), (2, "b", 1), (2, "c", 2)], [(2, "a", 0)]):
        spark.createDataFrame(rows, "k int, v string, at int").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k int, v string, at int").parquet(source)
        jobs.upsert_into(stream, folder, ["k"], "at", state).awaitTermination()
    assert {tuple(r) for r in V.read(spark, folder).collect()} == {(1, "new", 9), (2, "c", 2)}


def test_exact_percentile_of_large_small_and_tied_groups(spark):
    large = spark.range(25_000).select(F.lit("large").alias("step"), (F.col("id") * 7919 % 25_000 / 3).alias("x"))
    tied = spark.range(12_000).select(F.lit("tied"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")))
    few = spark.createDataFrame([("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None), (None, 3.0), (None, None)], "step string, x double")
    log = large.union(tied).union(few)
    got = {r.step: r for r in logs.p95_duration(log, "step", "x", F.lit(True), 9000.0, 60.0).collect()}
    assert {k: r.samples for k, r in got.items()} == {"large": 25_000, "tied": 12_000, "one": 1, "two": 2, "none": 1, None: 2}
    for r in log.groupBy("step").agg(F.percentile("x", 0.95).alias("p95")).collect():
        assert got[r.step].p95 == (None if r.p95 is None else pytest.approx(r.p95, rel=1e-12)), r
    assert got["one"].time_limit == 60.0 and got["large"].time_limit == 9000.0


def test_slots_of_several_schedules(spark):
    spine = logs.minutes(spark.range(1), F.expr("timestamp_ntz'2024-01-01'"), 31).select("tick")
    got = logs.slots(spine, [("either", "0 0 1 * 1"), ("both", "30 6 * 1 0"), ("never", "0 0 31 2 *")])
    days = {(r.job_id, r.slot.day, r.slot.hour, r.slot.minute) for r in got.where("slot < '2024-02-01'").collect()}
    assert days == {("either", d, 0, 0) for d in (1, 8, 15, 22, 29)} | {("both", d, 6, 30) for d in (7, 14, 21, 28)}


def test_samples_of_each_kind(spark):
    a = spark.range(100).select("id", F.lit(1).alias("v"))
    b = spark.range(50, 130).select("id", F.when(F.col("id") < 80, 2).otherwise(1).alias("v"))
    got = [(r.kind, r.id) for r in compare.compare_samples(a, b, ["id"], mismatched=3, missing=2).collect()]
    assert sorted(got) == [("mismatched", 50), ("mismatched", 51), ("mismatched", 52), ("missing_in_a", 100), ("missing_in_a", 101), ("missing_in_b", 0), ("missing_in_b", 1)]


def test_compatibility_counts_values_that_a_type_cannot_hold(spark):
    target = spark.createDataFrame([], "id long, n int, d date, `a.b` double, gone string")
    staging = spark.createDataFrame([(1, "7", "2024-02-29", 1.5), (2, "x", "2023-02-29", None), (3, None, None, 2.0), (4, "3000000000", "2024-01-01", float("nan"))], "id long, n string, d string, `a.b` double")
    got = {r.column_name: (r.status, r.target_type, r.staging_type, r.n_lost) for r in M.compatibility(target, staging.withColumn("more", F.lit(1))).collect()}
    assert got == {"id": ("same", "bigint", "bigint", 0), "n": ("lossy", "int", "string", 2), "d": ("lossy", "date", "string", 1), "a.b": ("same", "double", "double", 0), "gone": ("missing", "string", None, 0), "more": ("extra", None, "int", 0)}
    with pytest.raises(M.MergeError, match="n: lossy, 2 values of string are no int.*gone: missing"):
        M.require_compatible(target, staging)
    # numbers that a cast changes are lost, whether it rounds or leaves the range; null, nan and empty tables are no loss
    narrow, wide = spark.createDataFrame([], "`a.b` int, id int"), spark.createDataFrame([(2**40, 1.5), (1, 2.0), (None, None)], "id long, `a.b` double")
    assert {r.column_name: (r.status, r.n_lost) for r in M.compatibility(narrow, wide).collect()} == {"a.b": ("lossy", 1), "id": ("lossy", 1)}
    assert {r.status for r in M.compatibility(narrow, wide.limit(0)).collect()} == {"cast"}
    assert {r.status for r in M.compatibility(wide.select(F.col("`a.b`").cast("float").alias("x")), spark.createDataFrame([(float("nan"),), (0.5,)], "x double")).collect()} == {"cast"}
    M.require_compatible(wide, wide)

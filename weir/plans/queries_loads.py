"""Registered queries of incremental loading, merges and archives."""


from pyspark.sql import functions as F

from weir.operators import archive as A
from weir.operators import incremental as W
from weir.operators import merge as M
from weir.plans.job import Job, run_job
from weir.plans.registry import query, table
from weir.sources import files as S
from weir.sources.scratch import scratch

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def _orders(spark, d):
    return table(spark, d, "orders").select(*_COLUMNS)


def _staging(spark, d):
    """A tenth of the orders with new prices, some of them without, and as many new ones."""
    o = _orders(spark, d).where("o_orderkey % 10 = 0")
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice") + 5))
    return changed.unionByName(o.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))


_SQL = """t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
  s AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice + 5 END AS o_totalprice, o_orderdate FROM t WHERE o_orderkey % 10 = 0
  UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM t WHERE o_orderkey % 10 = 0)"""
_KEYS = ["o_orderkey"]


@query("""WITH s AS (SELECT count(o_custkey) FILTER (o_orderpriority = '1-URGENT') AS c, count(o_totalprice) FILTER (o_orderstatus = 'P') AS p FROM orders)
  SELECT 'o_orderkey' AS column_name, 'same' AS status, 'bigint' AS target_type, 'bigint' AS staging_type, CAST(0 AS BIGINT) AS n_lost
  UNION ALL SELECT 'o_custkey', CASE WHEN c > 0 THEN 'lossy' ELSE 'cast' END, 'bigint', 'double', c FROM s
  UNION ALL SELECT 'o_orderstatus', 'missing', 'string', NULL, 0
  UNION ALL SELECT 'o_totalprice', CASE WHEN p > 0 THEN 'lossy' ELSE 'cast' END, 'double', 'string', p FROM s
  UNION ALL SELECT 'o_orderdate', 'cast', 'timestamp_ntz', 'date', 0
  UNION ALL SELECT 'o_status', 'extra', NULL, 'string', 0""")
def merge_compatibility(spark, d):
    """Orders as another system sends them: urgent ones with half customers, open prices with their currency, days."""
    price = F.col("o_totalprice").cast("string")
    sent = table(spark, d, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") + F.when(F.col("o_orderpriority") == "1-URGENT", 0.5).otherwise(0.0)).alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", F.concat(price, F.lit(" EUR"))).otherwise(price).alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.col("o_orderstatus").alias("o_status"),
    )
    return M.compatibility(_orders(spark, d), sent)


@query(f"WITH {_SQL} FROM s")
def merge_full_refresh(spark, d):
    return M.full_refresh(_orders(spark, d), _staging(spark, d))


@query(f"WITH {_SQL} SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderdate = t.o_orderdate) UNION ALL FROM s")
def merge_delete_insert(spark, d):
    return M.delete_insert(_orders(spark, d), _staging(spark, d), "o_orderdate")


_UPDATED = "SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, t.o_orderdate FROM t LEFT JOIN s USING (o_orderkey)"


@query(f"WITH {_SQL} {_UPDATED}")
def merge_update(spark, d):
    return M.update(_orders(spark, d), _staging(spark, d), _KEYS)


@query(f"WITH {_SQL} FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def merge_insert_new(spark, d):
    return M.insert_new(_orders(spark, d), _staging(spark, d), _KEYS)


@query(f"WITH {_SQL} FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def merge_upsert(spark, d):
    return M.upsert(_orders(spark, d), _staging(spark, d), _KEYS)


@query(f"""WITH {_SQL} SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM s) THEN TIMESTAMP '2024-03-01'
  WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2020-01-01' END AS _is_deleted FROM t""")
def merge_soft_delete(spark, d):
    t = _orders(spark, d).select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, F.expr("timestamp_ntz'2020-01-01'")).alias("_is_deleted"))
    return M.soft_delete(t, _staging(spark, d), _KEYS, F.expr("timestamp_ntz'2024-03-01'"), scope=F.col("o_orderstatus") == "F")


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def dml_update(spark, d):
    return M.dml_update(_orders(spark, d).select("o_orderkey", "o_orderstatus", "o_totalprice"), {"o_orderstatus": F.lit("X")}, F.col("o_totalprice") > 200000).drop("o_totalprice")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F')")
def dml_delete(spark, d):
    return M.dml_delete(_orders(spark, d).select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "F")


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey + 20000000, 'N' FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT -1, NULL")
def dml_insert_select(spark, d):
    o = _orders(spark, d)
    more = o.where("o_totalprice > 200000").select((F.col("o_orderkey") + 20_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return M.dml_insert(M.dml_insert(o.select("o_orderkey", "o_orderstatus"), more), [{"o_orderkey": -1}])


@query(f"WITH {_SQL} SELECT count(*) AS expected, count(*) AS found, TRUE AS ok FROM s")
def verify_promotion(spark, d):
    t, s = _orders(spark, d), _staging(spark, d)
    p = M.policy_for("CDC", keys=_KEYS)
    return M.verification(M.apply_policy(t, s, p), s, p)


@query(f"WITH {_SQL} SELECT o_orderkey, o_totalprice, 'run-2' AS _run_id FROM s UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def schema_evolve(spark, d):
    t = _orders(spark, d).select("o_orderkey", "o_totalprice")
    s = _staging(spark, d).select("o_orderkey", "o_totalprice", F.lit("run-2").alias("_run_id"), F.lit(1).alias("unwanted"))
    t, s, _ = M.evolve(t, s, add_new=False)
    return M.upsert(t, s, _KEYS)


@query(f"""WITH {_SQL} SELECT 'run-2' AS run_id, 'orders' AS target_table, 'ADD_COLUMN' AS action, c AS column_name, k AS data_type, TIMESTAMP '2024-03-01' AS executed_at, 'loader' AS executed_by, n AS filled
  FROM (SELECT '_run_id' AS c, 'string' AS k, count(*) AS n FROM s UNION ALL SELECT 'grade', 'int', count(*) FILTER (o_totalprice > 100000) FROM s)""")
def schema_change_log(spark, d):
    """A written table takes in staging with two more columns; the log says which, and how many rows of the new version fill them."""
    folder = scratch(spark)
    S.publish(S.stage_and_verify(_orders(spark, d), folder), folder)
    s = _staging(spark, d).withColumns({"_run_id": F.lit("run-2"), "grade": F.when(F.col("o_totalprice") > 100_000, 1)})
    t, s, e = M.evolve(S.current(spark, folder), s, add_new=True)
    S.publish(S.stage_and_verify(M.upsert(t, s, _KEYS), folder), folder)
    log = M.evolution_log(t, e, "run-2", "orders", F.expr("timestamp_ntz'2024-03-01'"), "loader")
    new = S.current(spark, folder)
    filled = new.agg(*(F.count(c).alias(c) for c, _ in e.added)).unpivot([], [c for c, _ in e.added], "column_name", "filled")
    return log.join(filled, "column_name").where(F.to_date("executed_at") == F.lit("2024-03-01").cast("date"))


@query("SELECT DISTINCT CAST(l_shipdate AS DATE) AS partition_key FROM lineitem")
def partition_keys(spark, d):
    return M.partition_keys(table(spark, d, "lineitem"), "l_shipdate")


# Checkpoints of each customer as a dataset: its orders are the runs.
_CHECKPOINTS = "SELECT o_custkey AS dataset_id, o_orderkey AS run_id, o_orderdate AS created_at, CAST(o_orderdate AS DATE) AS end_value FROM orders"


def _checkpoints(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), F.to_date("o_orderdate").alias("end_value"))


@query(f"FROM ({_CHECKPOINTS}) QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY created_at DESC, run_id DESC) = 1")
def latest_checkpoint(spark, d):
    return W.latest_checkpoint(_checkpoints(spark, d), ["dataset_id"], tie="run_id")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-06-16'")
def incr_range(spark, d):
    return table(spark, d, "orders").where(W.range_predicate("o_orderdate", "1996-03-01", "1996-06-15")).select("o_orderkey", "o_orderdate")


@query("SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-07')")
def incr_dates(spark, d):
    return table(spark, d, "events").where(W.dates_predicate("ts", ["2024-01-03", "2024-01-07"])).select("event_id", "ts")


@query("SELECT event_id, value FROM events WHERE event_id > 100 AND event_id <= 400")
def incr_lsn(spark, d):
    return table(spark, d, "events").where(W.number_predicate("event_id", 100, 400)).select("event_id", "value")


@query("SELECT min(o_orderdate) AS start_value, greatest(max(o_orderdate), TIMESTAMP '1999-01-01') AS end_value, count(*) AS rows_loaded FROM orders")
def high_water_mark(spark, d):
    return W.high_water_mark(table(spark, d, "orders"), "o_orderdate", F.expr("timestamp_ntz'1999-01-01'"))


@query("SELECT d AS partition_date, count(event_id) AS n FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-03', DATE '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY d")
def catchup_dates(spark, d):
    days = W.catchup_dates(spark, "2024-01-02", "2024-01-12")
    events = table(spark, d, "events").select(F.to_date("ts").alias("partition_date"), "event_id")
    return days.join(events, "partition_date", "left").groupBy("partition_date").agg(F.count("event_id").alias("n"))


@query("SELECT CAST(ts AS DATE) AS partition_date, count(*) AS rows_loaded, min(event_id) AS checkpoint_start, max(event_id) AS checkpoint_end, 'events' AS source FROM events GROUP BY 1")
def extract_report(spark, d):
    return W.extract_report(table(spark, d, "events"), F.to_date("ts"), "event_id", F.lit("events"))


@query("SELECT o_orderkey, o_totalprice, FALSE AS merged FROM orders")
def empty_guard(spark, d):
    t = _orders(spark, d)
    df, merged = W.guarded(t.limit(0), t, M.full_refresh, lambda: t.where("o_orderkey < 0"))
    return df.select("o_orderkey", "o_totalprice", F.lit(merged).alias("merged"))


@query("""WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'
  UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate FROM orders WHERE o_orderkey % 5 = 0 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01')
  SELECT o_orderkey AS "OrderKey", o_custkey AS "CustKey", o_orderstatus AS "OrderStatus", o_totalprice AS "TotalPrice", o_orderdate AS "OrderDate", CAST(o_orderdate AS DATE) AS _partition_date, 'run-7' AS _run_id FROM s
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, NULL FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def job_end_to_end(spark, d):
    o = _orders(spark, d)
    names = {"o_orderkey": "order_key", "o_custkey": "cust_key", "o_orderstatus": "order_status", "o_totalprice": "total_price", "o_orderdate": "order_date"}
    target = o.withColumnsRenamed({k: "".join(p.capitalize() for p in v.split("_")) for k, v in names.items()})
    source = o.unionByName(o.where("o_orderkey % 5 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)).withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumnsRenamed(names)
    job = Job(
        M.policy_for("CDC", keys=["OrderKey"]),
        where=[W.range_predicate("order_date", "1996-01-01", "1996-01-31")],
        contract={"order_key": "integer", "total_price": "float"},
        style=("camel", "caps"),
        metadata={"run_id": True, "partition_date": True},
        partition_date=F.to_date("OrderDate"),
    )
    return run_job(spark, source, target, job, "run-7").select("OrderKey", "CustKey", "OrderStatus", "TotalPrice", "OrderDate", "_partition_date", "_run_id")


@query('SELECT sha256(text) AS content_hash, min(doc_id) AS first_key, count(*) AS "references" FROM documents WHERE text IS NOT NULL GROUP BY 1')
def cas_dedupe(spark, d):
    store, _ = A.dedupe_content(table(spark, d, "documents").where("text is not null"), "doc_id", "text")
    return store.drop("text")


@query("SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL) AND text IS NOT NULL")
def orphans(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return A.orphans(docs, docs.where("doc_id % 2 = 0")).select("doc_id")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def archive_restore(spark, d):
    path = scratch(spark)
    o = _orders(spark, d)
    A.archive(o.where("o_orderstatus = 'F'"), path, "job", "orders", "2024-01-01")
    A.archive(o, path, "job", "orders", "2024-01-02")
    return A.restore(spark, path, "job", "orders", "2024-01-02")


@query("SELECT DISTINCT CAST(ts AS DATE) AS partition_date, CAST(CAST(ts AS DATE) + 10 AS DATE) AS expires, CAST(ts AS DATE) + 10 < DATE '2024-01-20' AS expired FROM events")
def retention_expired(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("partition_date")).distinct()
    return A.retention(days, "partition_date", F.lit("2024-01-20").cast("date"), 10)


@query("SELECT job_id, count(*) AS n FROM (SELECT concat('job', doc_id % 3) AS job_id FROM documents WHERE doc_id % 3 = 1) GROUP BY 1")
def manifest_scan(spark, d):
    path = scratch(spark)
    table(spark, d, "documents").select(F.concat(F.lit("job"), F.col("doc_id") % 3).alias("job_id"), F.lit("2024-01-01").alias("partition_date"), F.md5("text").alias("content_hash")).write.json(path)
    return A.read_manifests(spark, path, "job1", "2024-01-01").groupBy("job_id").agg(F.count("*").alias("n"))


def _names_by_nation(spark, d):
    """A text file of names for each nation."""
    path = scratch(spark)
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name")
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(path)
    return path


_NAMES = "f AS (SELECT c_nationkey AS nation, concat(string_agg(c_name, chr(10) ORDER BY c_custkey), chr(10)) AS whole FROM customer GROUP BY 1)"
_NATION = "int(regexp_extract(path, 'c_nationkey=([0-9]+)', 1)) AS nation"


@query(f"WITH {_NAMES} SELECT nation, length(whole)::BIGINT AS size, md5(whole) AS md5 FROM f")
def file_checksums(spark, d):
    return A.file_checksums(spark, _names_by_nation(spark, d), "*.txt").selectExpr(_NATION, "size", "md5")


@query(f"""WITH {_NAMES}, b AS (SELECT nation, whole, unnest(range(0, length(whole), 300)) AS start FROM f)
  SELECT nation, count(*) AS blocks, concat(md5(unhex(string_agg(md5(substr(whole, CAST(start + 1 AS BIGINT), 300)), '' ORDER BY start))), '-', count(*)) AS checksum FROM b GROUP BY nation""")
def block_checksums(spark, d):
    return A.block_checksums(spark, _names_by_nation(spark, d), "*.txt", block=300).selectExpr(_NATION, "blocks", "checksum")


@query("SELECT sum(n) AS rows, TRUE AS all_counted FROM (SELECT count(*) AS n FROM orders)")
def file_rows(spark, d):
    """The rows of each written file, from the footers, beside its checksum."""
    path = scratch(spark)
    _orders(spark, d).repartition(5).write.parquet(path)
    found = A.file_checksums(spark, path, rows=True)
    return found.agg(F.sum("rows").cast("decimal(38,0)").alias("rows"), F.every((F.col("rows") > 0) & (F.length("md5") == 32)).alias("all_counted"))


@query("SELECT event_id, strftime((CAST(ts AS DATE) + INTERVAL 1 MONTH) - INTERVAL 2 DAY, '%Y/%m/%d') AS run_date FROM events")
def resolve_date(spark, d):
    return table(spark, d, "events").select("event_id", W.resolve_date(F.col("ts"), months=1, days=-2, pattern="yyyy/MM/dd").alias("run_date"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-09')")
def incr_paths(spark, d):
    """Files whose path holds one of the dates, and that changed after a time."""
    path = scratch(spark)
    table(spark, d, "events").select("event_id", F.to_date("ts").alias("day")).repartition("day").write.partitionBy("day").parquet(path)
    found = spark.read.parquet(path).where(W.path_predicate(F.col("_metadata.file_path"), "day={YYYY}-{MM}-{DD}", ["2024-01-03", "2024-01-09"]))
    return found.where(W.modified_predicate("_metadata.file_modification_time", 0.0)).select("event_id", "day")



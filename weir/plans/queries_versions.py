"""Registered queries of tables of versions: merges of touched files, history, streams, counts taken in the write."""

from pyspark.sql import functions as F

from weir.operators import merge as M
from weir.plans.registry import query, table
from weir.sources import files as S
from weir.sources import versions as V
from weir.sources.scratch import scratch
from weir.streaming import jobs

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_LATE = "CASE WHEN o_orderkey > m THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice + 5 AS o_totalprice"
_STAGED = f"m AS (SELECT max(o_orderkey) // 2 AS h, max(o_orderkey) * 3 // 4 AS m FROM orders), s AS (SELECT {_LATE} FROM orders, m WHERE o_orderkey > h)"


def _orders(spark, d):
    return table(spark, d, "orders").select(*_COLUMNS)


def _staging(spark, d):
    """New prices for the third quarter of the orders by key, and the last quarter again as new orders."""
    o = _orders(spark, d)
    last = o.agg(F.max("o_orderkey")).first()[0]
    half, most = last // 2, last * 3 // 4
    key = F.when(F.col("o_orderkey") > most, F.col("o_orderkey") + 10_000_000).otherwise(F.col("o_orderkey"))
    return o.where(F.col("o_orderkey") > half).select(key.alias("o_orderkey"), "o_custkey", "o_orderstatus", (F.col("o_totalprice") + 5).alias("o_totalprice"))


def _folder(spark, d):
    folder = scratch(spark)
    V.replace(spark, folder, _orders(spark, d), ["o_orderkey"], 8)
    return folder


@query(f"WITH {_STAGED} SELECT *, TRUE AS some_files_kept FROM (FROM s UNION ALL SELECT {', '.join(_COLUMNS)} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s))")
def merge_touched_files(spark, d):
    """Files of the first half of the keys hold none of staging's, so they stay in the new version."""
    folder = _folder(spark, d)
    v = V.merge(spark, folder, _staging(spark, d), M.policy_for("CDC", keys=["o_orderkey"]))
    return V.read(spark, folder).withColumn("some_files_kept", F.lit(v.kept >= 3 and v.removed <= 5))


@query(f"""WITH {_STAGED}, n AS (SELECT count(*) AS n FROM orders), new AS (SELECT count(*) AS new FROM s WHERE o_orderkey > 10000000), dear AS (SELECT count(*) AS dear FROM (SELECT o_totalprice AS p FROM s UNION ALL SELECT o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)) WHERE p > 200000)
  SELECT 1::BIGINT AS number, 'replace' AS operation, n AS rows FROM n UNION ALL SELECT 2, 'upsert', n + new FROM n, new UNION ALL SELECT 3, 'delete', n + new - dear FROM n, new, dear UNION ALL SELECT 4, 'compact', n + new - dear FROM n, new, dear""")
def version_history(spark, d):
    folder = _folder(spark, d)
    V.merge(spark, folder, _staging(spark, d), M.policy_for("CDC", keys=["o_orderkey"]))
    V.delete_where(spark, folder, F.col("o_totalprice") > 200_000)
    V.compact(spark, folder, 10**9, ["o_orderkey"])
    return V.history(spark, folder).select("number", "operation", "rows")


@query(f"WITH {_STAGED} SELECT *, o_orderkey IN (SELECT o_orderkey FROM s) AS staged FROM (SELECT {', '.join(_COLUMNS)} FROM orders)")
def version_travel(spark, d):
    """The table as it was before a merge and a new column."""
    folder = _folder(spark, d)
    s = _staging(spark, d)
    V.merge(spark, folder, s.withColumn("w", F.lit(1)), M.policy_for("CDC", keys=["o_orderkey"]), add_columns=True)
    old, new = V.read(spark, folder, 1), V.read(spark, folder).where("w = 1").select("o_orderkey", F.lit(True).alias("hit"))
    return old.join(new, "o_orderkey", "left").select(*_COLUMNS, F.coalesce("hit", F.lit(False)).alias("staged"))


@query(f"WITH {_STAGED} SELECT count(*) AS expected, count(*) AS found, TRUE AS ok FROM s WHERE o_orderkey < 10000000")
def verify_update(spark, d):
    """An update, whose staging has keys that the target lacks, is found whole."""
    t, s = _orders(spark, d), _staging(spark, d)
    p = M.policy_for("DELTA", "update", keys=["o_orderkey"])
    return M.verification(M.apply_policy(t, s, p), s, p, target=t)


@query("SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1")
def stage_observed(spark, d):
    """The count of a staged table is taken in its write."""
    path = scratch(spark)
    n = S.written(_orders(spark, d), path)
    return S.read_parquet(spark, path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.lit(n).cast("long").alias("written"))


@query("""SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_id, event_type FROM events
  QUALIFY event_type = 'error' OR row_number() OVER (PARTITION BY user_id, event_type <> 'error' ORDER BY event_id DESC) = 1""")
def stream_upsert_replayed(spark, d):
    """Errors lose their user: rows without a key. The last batch runs twice, as after a failure before its end was noted."""
    source, folder, state = scratch(spark), scratch(spark), scratch(spark)
    events = table(spark, d, "events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_id", "event_type")
    events.write.parquet(source)
    for k in range(2):
        jobs.upsert_into(spark.readStream.schema(events.schema).parquet(source), folder, ["user_id"], "event_id", state).awaitTermination()
        fs, path = S.file_system(spark, f"{state}/commits/0")
        if k == 0 and not fs.delete(path, False):
            raise FileNotFoundError(path.toString())
    return V.read(spark, folder)

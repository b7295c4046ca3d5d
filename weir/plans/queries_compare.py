"""Registered queries of table comparison and profiling."""

from pyspark.sql import functions as F

from weir.operators import compare as C
from weir.plans.registry import query, table


def _pair(spark, d):
    """orders, and a candidate of it: some prices changed, some rows gone, some new."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = o.where("o_orderkey % 11 != 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = o.where("o_orderkey % 13 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return o, changed.unionByName(new).withColumn("extra", F.lit(1))


_CANDIDATE = """c AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 13 = 0), a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)"""


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O'")
def count_where(spark, d):
    return C.count_where(table(spark, d, "orders"), "o_orderstatus = 'O'")


def _redealt(df):
    """The same rows otherwise dealt out, in parts of a fixed size: more of them for a larger table."""
    return df.hint("rebalance")


@query("SELECT count(*) AS rows, TRUE AS equal, FALSE AS equal_after_change FROM lineitem")
def checksum_equal(spark, d):
    li = table(spark, d, "lineitem")
    same = C.checksum(_redealt(li)).select("rows", F.struct("rows", "xor", "total").alias("b"))
    other = C.checksum(li.withColumn("l_quantity", F.when(F.col("l_linenumber") == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))).select(F.struct("rows", "xor", "total").alias("c"))
    one = C.checksum(li).select(F.struct("rows", "xor", "total").alias("a")).join(F.broadcast(same), F.lit(True)).join(F.broadcast(other), F.lit(True))  # one row each
    return one.select("rows", (F.col("a") == F.col("b")).alias("equal"), (F.col("a") == F.col("c")).alias("equal_after_change"))


@query("SELECT TRUE AS reordered, FALSE AS changed, TRUE AS without_price")
def tables_equal(spark, d):
    o, c = _pair(spark, d)
    priced = o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0))
    found = (C.tables_equal(o, o.repartition(5)), C.tables_equal(o, c), C.tables_equal(o, priced, ["o_totalprice"]))
    return spark.createDataFrame([found], "reordered boolean, changed boolean, without_price boolean")


@query(f"""WITH {_CANDIDATE}, j AS (SELECT a.o_orderkey AS ka, c.o_orderkey AS kc, a.o_custkey = c.o_custkey AND a.o_orderstatus = c.o_orderstatus AND a.o_totalprice = c.o_totalprice AS same FROM a FULL JOIN c ON a.o_orderkey = c.o_orderkey)
  SELECT count(ka) AS rows_a, count(kc) AS rows_b, count(*) FILTER (same) AS matched, count(*) FILTER (NOT same) AS mismatched, count(*) FILTER (kc IS NULL) AS missing_in_b, count(*) FILTER (ka IS NULL) AS missing_in_a,
  round(100.0 * count(*) FILTER (same) / (count(*) FILTER (same IS NOT NULL)), 2)::DOUBLE AS match_percent, '' AS only_in_a, 'extra' AS only_in_b, TRUE AS has_drift FROM j""")
def compare_report(spark, d):
    return C.compare_report(*_pair(spark, d), ["o_orderkey"])


@query(f"""WITH {_CANDIDATE} SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM c) AS rows_b, (SELECT count(*) FROM (FROM c EXCEPT FROM a)) AS missing_in_a, (SELECT count(*) FROM (FROM a EXCEPT FROM c)) AS missing_in_b,
  0::BIGINT AS mismatched, (SELECT count(*) FROM a) - (SELECT count(*) FROM (FROM a EXCEPT FROM c)) AS matched, TRUE AS has_drift""")
def compare_without_keys(spark, d):
    return C.compare_sets(*_pair(spark, d))


@query(f"""WITH {_CANDIDATE} SELECT 'extra' AS column, NULL::VARCHAR AS type_a, NULL::BIGINT AS nulls_a, NULL::BIGINT AS distinct_a, 'int' AS type_b, 0::BIGINT AS nulls_b, 1::BIGINT AS distinct_b, FALSE AS same_type
  UNION ALL SELECT 'o_custkey', 'bigint', 0, (SELECT count(DISTINCT o_custkey) FROM a), 'bigint', 0, (SELECT count(DISTINCT o_custkey) FROM c), TRUE
  UNION ALL SELECT 'o_orderkey', 'bigint', 0, (SELECT count(DISTINCT o_orderkey) FROM a), 'bigint', 0, (SELECT count(DISTINCT o_orderkey) FROM c), TRUE
  UNION ALL SELECT 'o_orderstatus', 'string', 0, (SELECT count(DISTINCT o_orderstatus) FROM a), 'string', 0, (SELECT count(DISTINCT o_orderstatus) FROM c), TRUE
  UNION ALL SELECT 'o_totalprice', 'double', 0, (SELECT count(DISTINCT o_totalprice) FROM a), 'double', 0, (SELECT count(DISTINCT o_totalprice) FROM c), TRUE""")
def compare_columns(spark, d):
    return C.compare_columns(*_pair(spark, d))


@query(f"""WITH {_CANDIDATE}, j AS (SELECT coalesce(a.o_orderkey, c.o_orderkey) AS o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN 'missing_in_b' WHEN a.o_orderkey IS NULL THEN 'missing_in_a' WHEN a.o_totalprice <> c.o_totalprice THEN 'mismatched' END AS kind FROM a FULL JOIN c ON a.o_orderkey = c.o_orderkey)
  SELECT kind, o_orderkey FROM j WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind ORDER BY o_orderkey) <= CASE WHEN kind = 'mismatched' THEN 10 ELSE 5 END""")
def compare_samples(spark, d):
    return C.compare_samples(*_pair(spark, d), ["o_orderkey"]).select("kind", "o_orderkey")


@query(f"""WITH {_CANDIDATE}, j AS (SELECT a.o_totalprice = c.o_totalprice AS same FROM a JOIN c ON a.o_orderkey = c.o_orderkey)
  SELECT 3::BIGINT AS datasets, 2::BIGINT AS clean, 1::BIGINT AS drifted, (SELECT round(100.0 * count(*) FILTER (same) / count(*), 2)::DOUBLE FROM j) AS lowest_match""")
def compare_summary(spark, d):
    o, c = _pair(spark, d)
    n = table(spark, d, "nation")
    return C.compare_summary({"orders": C.compare_report(o, c, ["o_orderkey"]), "again": C.compare_report(o, o.repartition(3), ["o_orderkey"]), "nation": C.compare_report(n, n, ["n_nationkey"])})


@query("""SELECT * FROM (SELECT 'has_rows' AS "check", 'abort' AS action, 0::BIGINT AS failures, TRUE AS passed UNION ALL SELECT 'key_not_null:l_orderkey', 'abort', 0, TRUE
  UNION ALL SELECT 'loss', 'abort', CASE WHEN 1000 - count(*) > 10 THEN 1000 - count(*) ELSE 0 END, count(*) >= 990 FROM lineitem
  UNION ALL SELECT 'small_quantity', 'warn', count(*) FILTER (l_quantity > 45), count(*) FILTER (l_quantity > 45) = 0 FROM lineitem
  UNION ALL SELECT 'positive_price', 'quarantine', count(*) FILTER (l_extendedprice <= 0), count(*) FILTER (l_extendedprice <= 0) = 0 FROM lineitem)""")
def audit_rules(spark, d):
    rules = {"small_quantity": (F.col("l_quantity") <= 45, "warn"), "positive_price": (F.col("l_extendedprice") > 0, "quarantine")}
    return C.audit(table(spark, d, "lineitem"), rules, ["l_orderkey"], 1000, 0.01)


@query("SELECT least(count(*), 10) AS rows, least(count(*), 10) AS different, least(count(*), 10) AS known FROM orders")
def sample_n(spark, d):
    """Ten rows, whichever: how many, how many different ones, and how many that the table has."""
    o = table(spark, d, "orders")
    s = C.sample_rows(o, 10).select("o_orderkey", F.lit(True).alias("drawn"))
    known = s.join(o.select("o_orderkey", F.lit(True).alias("there")), "o_orderkey", "left")
    return known.agg(F.count("drawn").alias("rows"), F.count_distinct("o_orderkey").alias("different"), F.count("there").alias("known"))


def _nearly(spark, d):
    """orders, and a copy in which a few prices differ, a few rows are gone and a few are new."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    far = F.col("o_totalprice") > 490_000
    changed = o.where(~far | (F.col("o_orderkey") % 2 > 0)).withColumn("o_totalprice", F.when(far, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return o, changed.unionByName(o.where(far & (F.col("o_orderkey") % 3 == 0)).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))


@query("""WITH a AS (SELECT o_orderkey, o_totalprice FROM orders), c AS (SELECT o_orderkey, CASE WHEN o_totalprice > 490000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM a WHERE NOT (o_totalprice > 490000 AND o_orderkey % 2 = 0)
  UNION ALL SELECT o_orderkey + 10000000, o_totalprice FROM a WHERE o_totalprice > 490000 AND o_orderkey % 3 = 0), j AS (SELECT a.o_orderkey AS ka, c.o_orderkey AS kc, a.o_totalprice = c.o_totalprice AS same FROM a FULL JOIN c ON a.o_orderkey = c.o_orderkey)
  SELECT count(ka) AS rows_a, count(kc) AS rows_b, count(*) FILTER (same) AS matched, count(*) FILTER (NOT same) AS mismatched, count(*) FILTER (kc IS NULL) AS missing_in_b, count(*) FILTER (ka IS NULL) AS missing_in_a,
  round(100.0 * count(*) FILTER (same) / (count(*) FILTER (same IS NOT NULL)), 2)::DOUBLE AS match_percent, '' AS only_in_a, '' AS only_in_b, count(*) FILTER (same) < greatest(count(ka), count(kc)) AS has_drift, TRUE AS few_joined FROM j""")
def compare_drilldown(spark, d):
    """Most buckets are equal, so that few rows are joined."""
    a, b = _nearly(spark, d)
    out = C.compare_drilldown(a, b, ["o_orderkey"])
    return out.withColumn("few_joined", F.col("joined_rows") < 0.2 * F.col("rows_a")).drop("joined_rows")


@query("""SELECT l_returnflag AS part, count(*) AS rows, sum(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END)::BIGINT AS nulls, min(l_quantity)::DOUBLE AS low, max(l_quantity)::DOUBLE AS high, TRUE AS near FROM lineitem GROUP BY 1
  UNION ALL SELECT 'all', count(*), sum(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END)::BIGINT, min(l_quantity)::DOUBLE, max(l_quantity)::DOUBLE, TRUE FROM lineitem""")
def profile_merge(spark, d):
    """Profiles by flag, each and united; distinct values, estimated, are within 3 % of the exact ones."""
    li = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey")
    parts = C.profile(li, F.col("l_returnflag"))
    whole = C.merged_profile(parts).select(F.lit("all").alias("part"), "column", "rows", "nulls", "low", "high", "distinct")
    exact = C.exact_profile(li).where("column = 'l_orderkey'").select(F.col("distinct").alias("exact"))
    orders = whole.where("column = 'l_orderkey'").select(F.col("distinct").alias("estimate"))
    near = exact.join(F.broadcast(orders), F.lit(True)).select((F.abs(F.col("estimate") - F.col("exact")) <= 0.03 * F.col("exact")).alias("near"))  # one row each
    each = parts.select("part", "column", "rows", "nulls", "low", "high").unionByName(whole.drop("distinct")).where("column = 'l_quantity'").drop("column")
    return each.join(F.broadcast(near), F.lit(True))

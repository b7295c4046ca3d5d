"""Registered queries of declarative specs and set operations."""

from pyspark.sql import functions as F

from weir.operators.query import Block, Join, Query, except_common, filtered, not_in, peek, run, semi
from weir.plans.registry import query, table
from weir.plans.transform import Step, by_batch, partition_metrics, run_steps


def _tables(spark, d, *names):
    return {n: table(spark, d, n) for n in names}


@query("SELECT o_orderkey, o_totalprice * 2 AS twice, upper(o_orderstatus) AS status FROM orders")
def q_project(spark, d):
    return run(spark, Block(table="orders", select=["o_orderkey", "o_totalprice * 2 AS twice", "upper(o_orderstatus) AS status"]), _tables(spark, d, "orders"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE (o_totalprice > 100000) AND (o_orderstatus = 'O' OR o_orderstatus = 'F')")
def q_filter(spark, d):
    return run(spark, Block(table="orders", select=["o_orderkey", "o_totalprice"], where=["o_totalprice > 100000", "o_orderstatus = 'O' OR o_orderstatus = 'F'"]), _tables(spark, d, "orders"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def q_pred_dict(spark, d):
    return run(spark, Block(table="orders", where=[{"o_orderstatus": "O", "o_orderpriority": "1-URGENT"}], select=["o_orderkey"]), _tables(spark, d, "orders"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def q_exists(spark, d):
    big = filtered(table(spark, d, "orders"), [("o_totalprice", ">", 200000)]).select(F.col("o_custkey").alias("c_custkey"))
    return semi(table(spark, d, "customer"), big, "c_custkey").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def q_not_exists(spark, d):
    return semi(table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", negate=True).select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('O')")
def q_in_list(spark, d):
    return run(spark, Block(table="lineitem", where=[("l_returnflag", "IN", ["A", "R"]), ("l_linestatus", "NOT IN", ["O"])], select=["l_orderkey", "l_linenumber"]), _tables(spark, d, "lineitem"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey, o_orderstatus) NOT IN (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 250000)")
def q_not_in_sub(spark, d):
    orders = table(spark, d, "orders")
    return not_in(orders, orders.where("o_totalprice > 250000"), ["o_custkey", "o_orderstatus"]).select("o_orderkey", "o_custkey")


@query("SELECT p_partkey FROM part WHERE p_name LIKE '%a%' AND p_size >= 10 AND p_retailprice < 1500 AND p_brand <> 'Brand#11'")
def q_pred_binary(spark, d):
    return run(spark, Block(table="part", where=[("p_name", "LIKE", "%a%"), ("p_size", ">=", 10), ("p_retailprice", "<", 1500), ("p_brand", "<>", "Brand#11")], select=["p_partkey"]), _tables(spark, d, "part"))


def _join(how, on, left="customer", right="orders", select=None):
    def q(spark, d):
        return run(spark, Block(table=left, joins=[Join(right, on, how)], select=select or ["c_custkey", "o_orderkey", "o_totalprice"]), _tables(spark, d, left, right))

    return q


_ON = "c_custkey = o_custkey and o_totalprice > 150000"
for _how in ("inner", "left", "right", "full"):
    _q = _join(_how, _ON)
    _q.__name__ = f"join_{_how}"
    query(f"SELECT c_custkey, o_orderkey, o_totalprice FROM customer {_how} JOIN orders ON {_ON}")(_q)


@query("SELECT n_name, r_name FROM nation CROSS JOIN region")
def join_cross(spark, d):
    return run(spark, Block(table="nation", joins=[Join("region", how="cross")], select=["n_name", "r_name"]), _tables(spark, d, "nation", "region"))


@query("SELECT s.s_suppkey, n.n_nationkey FROM supplier s JOIN nation n ON s.s_nationkey > n.n_nationkey AND s.s_acctbal > n.n_nationkey * 400")
def join_theta(spark, d):
    return run(spark, Block(table="supplier s", joins=[Join("nation n", "s.s_nationkey > n.n_nationkey AND s.s_acctbal > n.n_nationkey * 400")], select=["s.s_suppkey", "n.n_nationkey"]), _tables(spark, d, "supplier", "nation"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def join_semi(spark, d):
    return run(spark, Block(table="orders", joins=[Join("big", "o_orderkey = l_orderkey", "semi")], select=["o_orderkey"]), {"orders": table(spark, d, "orders"), "big": table(spark, d, "lineitem").where("l_quantity > 49")})


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def join_anti(spark, d):
    return run(spark, Block(table="orders", joins=[Join("big", "o_orderkey = l_orderkey", "anti")], select=["o_orderkey"]), {"orders": table(spark, d, "orders"), "big": table(spark, d, "lineitem").where("l_quantity > 45")})


@query("""SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1) o ON c_custkey = o_custkey""")
def join_any(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    from weir.operators import query as q  # noqa: PLC0415

    return q.join_any(table(spark, d, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, min(l_extendedprice) AS least FROM lineitem GROUP BY 1, 2 HAVING count(*) > 10")
def q_group_having(spark, d):
    return run(spark, Block(table="lineitem", select=["l_returnflag", "l_linestatus", "count(*) AS n", "round(sum(l_quantity), 2) AS quantity", "min(l_extendedprice) AS least"], group_by=[1, 2], having=["n > 10"]), _tables(spark, d, "lineitem"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2")
def q_qualify(spark, d):
    return run(spark, Block(table="orders", select=["o_custkey", "o_orderkey", "o_totalprice"], qualify=["row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2"]), _tables(spark, d, "orders"))


def _window(name, expression):
    sql = f"SELECT o_orderkey, {expression} AS w FROM orders"

    def q(spark, d):
        return run(spark, Block(table="orders", select=["o_orderkey", f"{expression} AS w"]), _tables(spark, d, "orders"))

    q.__name__ = name
    query(sql)(q)


_window("win_row_number", "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT)")
_window("win_rank", "CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS BIGINT)")
_window("win_lag", "lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
_window("win_running_sum", "round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def q_topk(spark, d):
    return run(spark, Block(table="orders", select=["o_orderkey", "o_totalprice"], order_by=["o_totalprice DESC", "o_orderkey"], limit=25), _tables(spark, d, "orders"))


@query("""WITH by_customer AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey),
  by_nation AS (SELECT c_nationkey, sum(n)::BIGINT AS n, round(sum(spent), 2) AS spent FROM by_customer JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
  SELECT n_name, n, spent FROM by_nation JOIN nation ON c_nationkey = n_nationkey WHERE n > 5""")
def q_cte_chain(spark, d):
    q = Query(
        [
            Block("by_customer", "orders", ["o_custkey", "count(*) AS n", "round(sum(o_totalprice), 2) AS spent"], group_by=["o_custkey"]),
            Block("by_nation", "by_customer", ["c_nationkey", "sum(n) AS n", "round(sum(spent), 2) AS spent"], [Join("customer", "o_custkey = c_custkey")], group_by=["c_nationkey"]),
        ],
        Block(table="by_nation", joins=[Join("nation", "c_nationkey = n_nationkey")], select=["n_name", "n", "spent"], where=["n > 5"]),
    )
    return run(spark, q, _tables(spark, d, "orders", "customer", "nation"))


@query("SELECT s_name, s_acctbal FROM (SELECT s_name, s_acctbal, s_nationkey FROM supplier) WHERE s_acctbal > 0")
def q_raw_sql(spark, d):
    return run(spark, Block(sql="SELECT s_name, s_acctbal, s_nationkey FROM supplier", where=["s_acctbal > 0"], select=["s_name", "s_acctbal"]), _tables(spark, d, "supplier"))


@query("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY p_brand ORDER BY p_brand LIMIT 1000")
def peek_sql(spark, d):
    return peek(spark, table(spark, d, "part"), "SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM self GROUP BY p_brand ORDER BY p_brand", 1000)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 25")
def peek_tail(spark, d):
    return peek(spark, table(spark, d, "orders"), "SELECT o_orderkey, o_totalprice FROM self ORDER BY o_orderkey", 25, tail=True)


@query("SELECT o_orderkey AS id, o_orderstatus AS state, FALSE AS planned FROM orders UNION ALL SELECT l_orderkey, l_linestatus, TRUE FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-06-01'")
def set_union_all(spark, d):
    log = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), F.lit(False).alias("planned"))
    plan = table(spark, d, "lineitem").where("l_shipdate > timestamp_ntz'1998-06-01'").select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("state"), F.lit(True).alias("planned"))
    return log.unionByName(plan)


@query("SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def set_except(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderkey").alias("k"), F.lit(0).alias("noise"))
    return except_common(o.where("k % 2 = 0"), o.where("k % 2 = 1"), ["k", "noise"])


@query("SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_linenumber = 1 EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_linenumber = 2")
def set_except_all(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber")
    return except_common(li.where("l_linenumber = 1"), li.where("l_linenumber = 2"), ["l_linenumber"], bag=True)


@query("SELECT o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1")
def x_sql_step(spark, d):
    step = Step("a", ["orders", "customer"], query=Block(table="orders", joins=[Join("customer", "o_custkey = c_custkey")], where=["c_mktsegment = 'BUILDING'"], select=["o_orderpriority", "count(*) AS n"], group_by=[1]))
    return run_steps(spark, [step], _tables(spark, d, "orders", "customer"))


@query("SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN '********' END AS c_name, c_acctbal FROM customer WHERE c_acctbal > 1000")
def x_chain(spark, d):
    steps = [Step("rich", ["customer"], query=Block(table="customer", select=["c_custkey", "c_name", "c_acctbal"], where=["c_acctbal > 1000"])), Step("hidden", ["rich"], transformer="masking", params={"columns": ["c_name"]})]
    return run_steps(spark, steps, _tables(spark, d, "customer"))


@query("SELECT p_partkey, p_retailprice, TRUE AS _is_processed FROM part")
def x_python_step(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_retailprice")
    flag = Step("flag", ["part"], function=lambda df: by_batch(df, lambda pdf: pdf.assign(_is_processed=True), "p_partkey long, p_retailprice double, _is_processed boolean"))
    return run_steps(spark, [flag], {"part": part})


@query("""SELECT o_orderstatus AS partition_key, count(*) AS rows_in, sum(CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END)::BIGINT AS rows_out,
  CASE WHEN sum(CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END) = 0 THEN 'EMPTY' ELSE 'DONE' END AS status FROM orders GROUP BY 1""")
def partition_counts(spark, d):
    o = table(spark, d, "orders")
    return partition_metrics(o, o.where("o_totalprice > 300000"), F.col("o_orderstatus"))

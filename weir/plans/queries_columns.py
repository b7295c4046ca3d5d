"""Registered queries of column operators."""

from pyspark.sql import functions as F

from weir.functions import columns as C
from weir.functions.types import apply_contract, override_types, union_relaxed
from weir.plans.registry import query, table


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(38, 9)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders")
def schema_contract(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return apply_contract(o, {"o_orderkey": "string", "o_totalprice": "decimal", "o_orderdate": "date"})


@query("SELECT o_orderkey, nullif(nullif(o_orderstatus, 'P'), 'F') AS o_orderstatus FROM orders")
def null_if(spark, d):
    return C.null_if(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["P", "F"])


@query("SELECT o_orderkey, o_custkey AS c_id, o_orderstatus AS c_s_status, o_totalprice AS c_s_price FROM orders")
def flatten_struct(spark, d):
    nested = table(spark, d, "orders").select("o_orderkey", F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("s")).alias("c"))
    return C.flatten(nested)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def json_autoparse(spark, d):
    return C.flatten(C.parse_json(table(spark, d, "events").select("event_id", "props")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type FROM events")
def sanitize_records(spark, d):
    raw = table(spark, d, "events").select("event_id", "ts", F.concat(F.lit("\x00"), "event_type", F.lit("\x00\x00")).cast("binary").alias("event_type"))
    return C.sanitize(raw)


@query("SELECT n_nationkey AS order_date, n_name AS xml_parser, n_regionkey AS order_date_1, n_name AS _keep FROM nation")
def rename_columns(spark, d):
    n = table(spark, d, "nation")
    return C.rename_columns(n.select(F.col("n_nationkey").alias("orderDate"), F.col("n_name").alias("XMLParser"), F.col("n_regionkey").alias("order_date"), F.col("n_name").alias("_keep")))


@query("SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_shipdate AS DATE) AS l_shipdate, l_linenumber AS _n FROM lineitem")
def cast_overrides(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", F.col("l_linenumber").alias("_n"))
    return override_types(li, {"l_orderkey": "float", "l_shipdate": "date", "_n": "string", "absent": "date"})


@query("""SELECT o_orderkey, 'run-1' AS _run_id, CAST(o_orderdate AS DATE) AS day, concat('orders/', year(o_orderdate)) AS _source,
  TIMESTAMP '2024-02-01 00:00:00' AS _loaded_at, CAST(NULL AS TIMESTAMP) AS _is_deleted FROM orders""")
def meta_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    sources = o.select(F.to_date("o_orderdate").alias("partition_date")).distinct().withColumn("source", F.concat(F.lit("orders/"), F.year("partition_date")))
    wanted = {"run_id": True, "partition_date": "day", "source": True, "loaded_at": True, "deleted": True}
    return C.add_metadata(o, wanted, run_id="run-1", partition_date=F.to_date("o_orderdate"), source=sources, loaded_at=F.expr("timestamp_ntz'2024-02-01 00:00:00'")).drop("o_orderdate")


@query("SELECT c_custkey, CASE WHEN c_name IS NULL THEN NULL ELSE '########' END AS c_name FROM customer")
def mask_fixed(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.masked(F.col("c_name"), "fixed", "#").alias("c_name"))


@query("SELECT c_custkey AS id, sha256(c_name) AS name, concat(repeat('*', greatest(length(c_mktsegment) - 4, 0)::INT), right(c_mktsegment, 4)) AS segment, CAST(c_acctbal AS VARCHAR) AS balance FROM customer")
def mask_contract(spark, d):
    rows = [
        {"source_col": "c_custkey", "target_col": "id", "dtype": "integer", "primary_key": "true"},
        {"source_col": "c_name", "target_col": "name", "masking": "SHA256"},
        {"source_col": "c_mktsegment", "target_col": "segment", "masking": "LAST_4"},
        {"source_col": "c_acctbal", "target_col": "balance", "dtype": "string"},
    ]
    return C.apply_contracts(table(spark, d, "customer"), C.read_contracts(rows))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS VARCHAR) AS s, md5(concat(o_orderkey, '|', o_orderstatus)) AS m, coalesce(nullif(o_orderstatus, 'F'), o_orderpriority) AS c FROM orders")
def scalar_funcs(spark, d):
    t = C.template
    c = F.col
    return table(spark, d, "orders").select("o_orderkey", t("cast_to_date", c("o_orderdate")).alias("d"), t("cast_to_string", c("o_custkey")).alias("s"), t("md5", c("o_orderkey"), c("o_orderstatus")).alias("m"), t("coalesce", F.nullif(c("o_orderstatus"), F.lit("F")), c("o_orderpriority")).alias("c"))


@query("SELECT o_orderstatus, count(*) AS rows, count(DISTINCT (o_orderkey, o_custkey)) AS hashes, TRUE AS same, FALSE AS same_without_one FROM orders GROUP BY 1")
def hash_templates(spark, d):
    """Hashes tell rows apart; a group's hash is the same whatever the order of rows, and another without one of them."""
    o = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    whole = C.template("hash_agg", F.col("o_orderkey"), F.col("o_custkey"))
    last = o.groupBy("o_orderstatus").agg(F.max("o_orderkey").alias("last"))
    left = o.join(last, "o_orderstatus").where("o_orderkey <> last").groupBy("o_orderstatus").agg(whole.alias("less"))
    again = o.repartition(7, "o_orderkey").groupBy("o_orderstatus").agg(whole.alias("again"))
    facts = o.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.count_distinct(C.template("hash", F.col("o_orderkey"), F.col("o_custkey"))).alias("hashes"), whole.alias("whole"))
    joined = facts.join(again, "o_orderstatus").join(left, "o_orderstatus")
    return joined.select("o_orderstatus", "rows", "hashes", (F.col("whole") == F.col("again")).alias("same"), (F.col("whole") == F.col("less")).alias("same_without_one"))


@query("""SELECT event_id, lower(concat(event_type, '-', user_id)) AS label, substring(event_type, 1, 3) AS short, lower(md5(event_type)) AS digest,
  strftime(ts, '%Y%m%d') AS day, date_trunc('day', ts) + INTERVAL 1 DAY AS next_day, date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS days,
  ts + INTERVAL 90 MINUTE AS later, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS level, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def scalar_sql(spark, d):
    table(spark, d, "events").createOrReplaceTempView("scalar_events")
    return spark.sql("""SELECT * EXCEPT (ts, value, props, user_id, event_type) FROM (SELECT *, lower(concat(event_type, '-', user_id)) AS label, substring(event_type, 1, 3) AS short, lower(md5(event_type)) AS digest,
      date_format(ts, 'yyyyMMdd') AS day, cast(date_trunc('DAY', ts) + INTERVAL 1 DAY AS timestamp_ntz) AS next_day, cast(datediff(to_date(ts), DATE '2024-01-01') AS BIGINT) AS days,
      ts + INTERVAL 90 MINUTE AS later, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS level, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM scalar_events)""")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def repair_json(spark, d):
    broken = table(spark, d, "events").select("event_id", F.regexp_replace("props", r"\}$", ", }").alias("props"))
    fixed = broken.withColumn("props", C.repair_json(F.col("props")))
    return fixed.select("event_id", F.from_json("props", "k long").k.alias("k"))


@query(r"SELECT page_id, length(regexp_replace(html, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS n, md5(regexp_replace(html, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS digest FROM pages")
def strip_control(spark, d):
    clean = C.strip_control(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.length(clean).cast("long").alias("n"), F.md5(clean).alias("digest"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws('; ', CASE WHEN l_quantity > 40 THEN 'quantity' END, CASE WHEN l_discount > 0.08 THEN 'discount' END) AS quarantine_reason
  FROM lineitem WHERE l_quantity > 40 OR l_discount > 0.08""")
def quarantine_split(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    _, bad = C.quarantine(li, {"quantity": F.col("l_quantity") <= 40, "discount": F.col("l_discount") <= 0.08})
    return bad.drop("l_quantity", "l_discount")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_acctbal AS DOUBLE) AS amount, c_name AS name, NULL::VARCHAR AS extra FROM customer UNION ALL SELECT s_name, s_suppkey, NULL, s_name FROM supplier")
def union_of_sources(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    return union_relaxed([c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_name").alias("name")), s.select(F.col("s_name").alias("id"), F.col("s_suppkey").alias("amount"), F.col("s_name").alias("extra"))])

"""Registered queries of sources, sinks and streams. Tables are written to a shared scratch folder in a format and read from it."""

import io
import json
import tarfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from weir.operators import tables

from weir.plans.registry import query, table
from weir.sources import archives as R
from weir.sources import csv_by_name as N
from weir.sources import derby, jdbc
from weir.sources import files as S
from weir.sources import versions as V
from weir.sources.ranged import create_file, open_file, size_of
from weir.sources.scratch import scratch
from weir.streaming import jobs, paged, states

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query(_ORDERS)
def scan_csv(spark, d):
    path = scratch(spark)
    S.write_text(_orders(spark, d), path, "csv")
    return S.read_csv(spark, path, _SCHEMA)


@query("SELECT event_id, user_id, event_type, value FROM events")
def scan_json(spark, d):
    path = scratch(spark)
    S.write_text(table(spark, d, "events"), path, "json")
    return S.read_json(spark, path, "event_id long, user_id long, event_type string, value double")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def scan_parquet(spark, d):
    return S.read_parquet(spark, f"{d}/lineitem.parquet").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, nullif(trim(c_name), '') AS c_name FROM customer")
def scan_xml(spark, d):
    path = scratch(spark)
    table(spark, d, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("c_name")).write.format("xml").option("rowTag", "customer").save(path)
    return S.read_xml(spark, path, "customer", "c_custkey long, c_name string")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def scan_auto(spark, d):
    S.register(spark, "auto_orders", f"{d}/orders.parquet")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM auto_orders GROUP BY o_orderstatus")


@query("SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey + 1000000, p_brand FROM part")
def scan_many(spark, d):
    a, b = scratch(spark), scratch(spark)
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    part.write.parquet(f"{a}/x.parquet")
    part.withColumn("p_partkey", F.col("p_partkey") + 1_000_000).write.json(f"{b}/x.json")
    return S.read_all(spark, [f"{a}/x.parquet", f"{b}/x.json"])


@query("SELECT 'orders.parquet' AS name, count(*) > 0 AS has_bytes FROM orders")
def file_listing(spark, d):
    found = S.check_files(S.list_files(spark, f"{d}/orders.parquet", "name LIKE '%.parquet'", "*.parquet"))
    return found.where("problem is null").agg(F.lit("orders.parquet").alias("name"), (F.sum("size") > 0).alias("has_bytes"))


@query("SELECT c_nationkey % 4 AS shard_of_key, count(*) AS rows, count(DISTINCT c_nationkey) AS keys FROM customer GROUP BY 1")
def hash_shard(spark, d):
    """Shards partition the table: each row has one, and rows with one key share it."""
    c = table(spark, d, "customer")
    sharded = c.withColumn("shard", S.hash_shard(c, 8, ["c_nationkey"]))
    whole = sharded.groupBy("c_nationkey").agg(F.count("*").alias("rows"), F.count_distinct("shard").alias("shards")).where("shards = 1")
    return whole.groupBy((F.col("c_nationkey") % 4).alias("shard_of_key")).agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"))


@query("SELECT count(*) AS rows, greatest(1, least(CAST(ceil(count(*) * 11 / 2000000.0) AS BIGINT), greatest(count(*) // 5000, 1))) AS shards FROM lineitem")
def shard_plan(spark, d):
    li = table(spark, d, "lineitem")
    n = li.count()
    return li.agg(F.count("*").alias("rows"), F.lit(S.shard_count(n, len(li.columns), 2_000_000, 5_000)).cast("long").alias("shards"))


@query("SELECT count(*) AS rows, 1::BIGINT AS has_source FROM region")
def lineage(spark, d):
    df = S.lineage(table(spark, d, "region"))
    return df.agg(F.count("*").alias("rows"), F.count_distinct((F.col("_source") != "")).alias("has_source"))


@query("SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1")
def sink_parquet(spark, d):
    path = scratch(spark)
    S.write_parquet(_orders(spark, d).withColumn("y", F.year("o_orderdate")).repartition("y"), path, ["y"], rows_per_file=50_000)
    return S.read_parquet(spark, path).groupBy(F.col("y").cast("long").alias("y")).agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_csv_json(spark, d):
    a, b = scratch(spark), scratch(spark)
    S.write_text(table(spark, d, "supplier").where("s_suppkey % 2 = 0"), a, "csv")
    S.write_text(table(spark, d, "supplier").where("s_suppkey % 2 = 1"), b, "json")
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    return S.read_csv(spark, a, schema).unionByName(S.read_json(spark, b, schema))


@query("SELECT p_partkey, p_name, p_size FROM part")
def convert(spark, d):
    a, b = scratch(spark), scratch(spark)
    S.write_text(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), f"{a}/part.json", "json")
    S.convert(spark, f"{a}/part.json", b, partition_by=["p_size"])
    return S.read_parquet(spark, b).select("p_partkey", "p_name", F.col("p_size").cast("int").alias("p_size"))


@query(_ORDERS)
def stage_verify(spark, d):
    o = _orders(spark, d)
    folder = scratch(spark)
    S.publish(S.stage_and_verify(o, folder, o.count()), folder)
    return S.current(spark, folder)


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS version FROM orders")
def promote_partition(spark, d):
    path = scratch(spark)
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus")
    S.promote_partitions(o.withColumn("version", F.lit(0)), path, ["o_orderstatus"])
    S.promote_partitions(o.where("o_orderstatus = 'F'").withColumn("version", F.lit(1)), path, ["o_orderstatus"])
    return S.read_parquet(spark, path)


@query("SELECT event_id, concat('{\"type\":\"', event_type, '\",\"user\":', user_id, '}') AS detail FROM events")
def log_flatten(spark, d):
    path = scratch(spark)
    table(spark, d, "events").select("event_id", F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("detail")).write.json(path)
    return S.load_log_buffer(spark, path)


@query(_ORDERS + " WHERE o_custkey IS NOT NULL")
def stream_clean(spark, d):
    source, target, state = scratch(spark), scratch(spark), scratch(spark)
    S.write_text(_orders(spark, d), source, "json")
    for _ in range(2):  # the second run finds nothing new
        jobs.append_to(jobs.clean(jobs.json_stream(spark, source, _SCHEMA), ["o_custkey"]), target, state).awaitTermination()
    return S.read_parquet(spark, target).drop("processed_at")


@query("SELECT event_id, value FROM events")
def stream_incremental(spark, d):
    target, state = scratch(spark), scratch(spark)
    source = scratch(spark)
    events = table(spark, d, "events").select("event_id", "value")

    def each(batch, n):  # a batch that runs again writes its own folder anew
        batch.write.mode("overwrite").parquet(f"{target}/batch={n}")

    for part in (0, 1):
        events.where(f"event_id % 2 = {part}").write.mode("append").parquet(source)
        jobs.pick_up(spark, source, "parquet", "event_id long, value double", state, each).awaitTermination()
    return S.read_parquet(spark, target).drop("batch")


@query("SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def stream_upsert(spark, d):
    source, folder, state = scratch(spark), scratch(spark), scratch(spark)
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    half = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for part in (f"event_id > {half}", f"event_id <= {half}"):  # the older rows come late
        events.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        jobs.upsert_into(stream, folder, ["user_id"], "event_id", state).awaitTermination()
    return V.read(spark, folder)


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, max(ts) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') > 0")
def stream_state(spark, d):
    source, state = scratch(spark), scratch(spark)
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("status"))
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    out = scratch(spark)

    def each(batch, n):
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    folded = jobs.fold_states(stream, "user_id", "ts", "status", ["purchase"])
    folded.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    last = S.read_parquet(spark, out).where("status = 'purchase'").groupBy("user_id").agg(F.max("ts").cast("timestamp_ntz").alias("last_purchase"))
    return last


def _zips(key, t):
    """An archive of two CSV files and a note for each key."""
    rows = t.sort_by("c_custkey").to_pylist()
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for part in (0, 1):
            z.writestr(f"part_{part}.csv", "c_custkey,c_name\n" + "".join(f"{r['c_custkey']},{r['c_name']}\n" for r in rows if r["c_custkey"] % 2 == part))
        z.writestr("readme.md", "no rows")
    return pa.table({"path": [f"nation_{key[0].as_py()}.zip"], "content": [held.getvalue()]})


@query("SELECT concat('nation_', c_nationkey, '.zip') AS archive, concat('part_', c_custkey % 2, '.csv') AS member, c_custkey, c_name FROM customer")
def scan_archive(spark, d):
    path = scratch(spark)
    table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name").groupBy("c_nationkey").applyInArrow(_zips, "path string, content binary").write.parquet(path)
    return S.member_rows(S.members_of(spark.read.parquet(path), "*.csv"), "c_custkey long, c_name string")


def _packed(folder):
    """Writes an archive of the months' orders as CSV for each year: zip files, but of odd years tar files."""

    def packed(key, t):
        year, rows = key[0].as_py(), t.sort_by("o_orderkey").to_pylist()
        name = f"{folder}/orders_{year}.{'tar' if year % 2 else 'zip'}"
        texts = {m: "".join(f"{r['o_orderkey']},{r['o_custkey']}\n" for r in rows if r["month"] == m) for m in sorted({r["month"] for r in rows})}
        with create_file(name) as out:
            if year % 2:
                with tarfile.open(fileobj=out, mode="w|") as tar:
                    for m, text in texts.items():
                        data = f"o_orderkey,o_custkey\n{text}".encode()
                        info = tarfile.TarInfo(f"csv/{m:02}.csv")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
            else:
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for m, text in texts.items():
                        z.writestr(f"csv/{m:02}.csv", f"o_orderkey,o_custkey\n{text}")
                    z.writestr("readme.md", "no rows")
        return pa.table({"name": [name]})

    return packed


@query("SELECT concat('orders_', year(o_orderdate), CASE WHEN year(o_orderdate) % 2 = 1 THEN '.tar' ELSE '.zip' END) AS archive, printf('csv/%02d.csv', month(o_orderdate)) AS member, o_orderkey, o_custkey FROM orders WHERE month(o_orderdate) >= 10")
def archive_ranges(spark, d):
    """Of archives in files just the members of the last quarter, each by its own range of bytes."""
    folder, done = scratch(spark), scratch(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    o.groupBy("year").applyInArrow(_packed(folder), "name string").write.parquet(done)
    found = R.member_rows(R.member_lines(R.archive_index(spark, folder, "csv/1?.csv")), "o_orderkey long, o_custkey long")
    return found.withColumn("archive", F.element_at(F.split("archive", "/"), -1))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def jdbc_round_trip(spark, d):
    """Into a database and back in four shards. The database that Spark brings lives in the driver: it loads the files of tasks, which read it packed."""
    url, names = derby.new_database(spark), derby.PROPERTIES
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    upper = supplier.toDF(*map(str.upper, supplier.columns))
    jdbc.write_table(upper.limit(0), url, "SUPPLIER", "overwrite", properties=names)
    jdbc.write_table(upper, url, "SUPPLIER", "append", properties=names, expected=supplier.count(), bulk=derby.IMPORT)
    return jdbc.read_sharded(spark, derby.packed(spark, url), "SUPPLIER", "S_SUPPKEY", 4, names).toDF(*supplier.columns)


def _texts(lines, mark, header):
    """CSV files of a few thousand lines(k, line), each a value that holds a whole file with a mark before its header."""
    whole = lines.groupBy(F.floor(F.col("k") / 5000).alias("file")).agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return whole.select("file", F.concat(F.lit(f"{mark}{header}\n"), F.array_join("lines", "\n")).alias("value"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 2::BIGINT AS calls_that_loaded FROM supplier")
def jdbc_staged_load(spark, d):
    """Two runs, each called twice, into one table, read back in shards by quantiles."""
    url, names = derby.new_database(spark), derby.PROPERTIES
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    middle = supplier.agg(F.percentile_approx("s_suppkey", 0.5)).first()[0]
    loaded = [jdbc.load_once(supplier.where(part), url, "SUPPLIER", run, names, bulk=derby.IMPORT) for part, run in ((f"s_suppkey <= {middle}", "r1"), (f"s_suppkey > {middle}", "r2")) for _ in range(2)]
    found = jdbc.read_by_quantiles(spark, derby.packed(spark, url), "SUPPLIER", '"s_suppkey"', 4, names)
    return found.withColumn("calls_that_loaded", F.lit(sum(loaded)).cast("long"))


def _page_of(folder):
    def fetch(page):
        with open_file(f"{folder}/{page}.json") as f:
            return [(r["event_id"], r["user_id"], r["value"]) for r in map(json.loads, f.read().decode().splitlines())]

    return fetch


def _pages_in(folder):
    def pages():
        n = 0
        while size_of(f"{folder}/{n}.json") is not None:
            n += 1
        return n

    return pages


def _write_pages(folder):
    """Each batch's rows of a page as a file of JSON lines."""

    def pages(key, t):
        with create_file(f"{folder}/{key[0].as_py()}.json") as out:
            out.write("".join(json.dumps(r) + "\n" for r in t.select(["event_id", "user_id", "value"]).to_pylist()).encode())
        return pa.table({"page": [key[0].as_py()]})

    return pages


@query("SELECT event_id, user_id, value FROM events")
def stream_paged(spark, d):
    """Pages of a thousand events, of which half are there for the first run and all for the next, which goes on where that ended."""
    folder, target, state = scratch(spark), scratch(spark), scratch(spark)
    events = table(spark, d, "events").select("event_id", "user_id", "value", F.floor((F.col("event_id") - F.lit(table(spark, d, "events").agg(F.min("event_id")).first()[0])) / 1000).cast("long").alias("page"))
    pages = events.agg(F.max("page")).first()[0] + 1
    name = f"pages_{uuid.uuid4().hex}"
    spark.dataSource.register(paged.paged_source(name, "event_id long, user_id long, value double", _page_of(folder), _pages_in(folder)))
    for part in (F.col("page") < pages // 2, F.col("page") >= pages // 2):
        events.where(part).groupBy("page").applyInArrow(_write_pages(folder), "page long").write.mode("overwrite").format("noop").save()
        for _ in range(2):  # the second finds nothing new
            jobs.append_to(spark.readStream.format(name).load(), target, state).awaitTermination()
    return S.read_parquet(spark, target)


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, max(ts) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') > 0")
def stream_state_ttl(spark, d):
    """States in RocksDB, over three runs with thirds of the events: late rows of a later run don't undo a purchase."""
    source, state, out = scratch(spark), scratch(spark), scratch(spark)
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("status"), "event_id")

    def each(batch, n):
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    for part in (2, 0, 1):
        events.where(F.col("event_id") % 3 == part).drop("event_id").write.mode("append").parquet(source)
        stream = spark.readStream.schema("user_id string, ts timestamp, status string").parquet(source)
        folded = states.timed_states(stream, "user_id", "ts", "status", ["purchase"], 3600)
        states.run_states(folded, each, state).awaitTermination()
    last = S.read_parquet(spark, out).where("status = 'purchase'")
    return last.groupBy("user_id").agg(F.max("ts").cast("timestamp_ntz").alias("last_purchase"))


@query("SELECT c_custkey, concat(c_name, ' é') AS c_name FROM customer WHERE c_custkey % 7 <> 0")
def repair_csv(spark, d):
    """CSV files with a byte order mark, or in another encoding and order, of which every seventh row has too many fields or a
    wrong type; read from their repaired copy."""
    path, fixed, bad = scratch(spark), scratch(spark), scratch(spark)
    c = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" é")).alias("c_name"))
    line = F.concat_ws(",", "c_custkey", "c_name")
    broken = F.when(F.col("c_custkey") % 2 == 0, F.concat(line, F.lit(",more"))).otherwise(F.concat(F.lit("x"), line))
    lines = c.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 7 == 0, broken).otherwise(line).alias("line"))
    _texts(lines, "\ufeff", "c_custkey,c_name").write.partitionBy("file").text(f"{path}/marked")
    c.where("c_custkey % 3 = 0").select("c_name", F.when(F.col("c_custkey") % 7 == 0, "none").otherwise(F.col("c_custkey").cast("string")).alias("C_CustKey")).write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/latin")
    N.repair_csv(spark, path, fixed, "c_custkey long, c_name string", bad=bad)
    return S.read_csv(spark, fixed, "c_custkey long, c_name string")


@query("""SELECT CASE WHEN o_orderkey % 5 = 1 AND o_orderkey % 50 = 1 THEN NULL ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 5 = 1 AND o_orderkey % 50 = 1 THEN o_orderkey END AS bad_key, o_custkey,
  CASE o_orderkey % 5 WHEN 4 THEN concat(o_orderstatus, 'é') ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 5 = 3 THEN 'extra' END AS note FROM orders""")
def scan_csv_by_name(spark, d):
    """Orders in files of five kinds: as they are, in another order, without prices, with a column more and a byte order mark, in latin-1."""
    path = scratch(spark)
    o = _orders(spark, d).drop("o_orderdate")
    part = lambda k: o.where(F.col("o_orderkey") % 5 == k)
    key = F.when(F.col("o_orderkey") % 50 == 1, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string")).alias("O_OrderKey")
    kinds = [part(0), part(1).select("o_totalprice", "o_orderstatus", key, "o_custkey"), part(2).drop("o_totalprice"), part(3).select(F.col("o_custkey").alias("\ufeffo_custkey"), "o_orderkey", F.lit("extra").alias("note"), "o_totalprice", "o_orderstatus"), part(4).withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("é")))]
    for k, df in enumerate(kinds):
        df.write.option("header", True).option("encoding", "ISO-8859-1" if k == 4 else "UTF-8").csv(f"{path}/{k}")
    df = N.read_csv_by_name(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    return df.withColumn("bad_key", F.regexp_extract("_corrupt_record", "x([0-9]+)", 1).cast("long")).drop("_corrupt_record")


@query("SELECT NULL AS problem, count(*) AS rows FROM orders UNION ALL SELECT 'missing', count(DISTINCT o_orderstatus) FROM orders")
def file_check(spark, d):
    """The files that a version of orders lists, and for each status one that isn't there."""
    folder = scratch(spark)
    v = V.replace(spark, folder, _orders(spark, d), ["o_orderkey"], 8)
    listed = V.files_of(spark, folder, v).select(F.concat(F.lit(f"{folder}/"), "file").alias("path"), "rows")
    gone = _orders(spark, d).select("o_orderstatus").distinct().select(F.concat(F.lit(f"{folder}/data/gone-"), "o_orderstatus").alias("path"), F.lit(1).cast("long").alias("rows"))
    named = listed.unionByName(gone)
    return S.check_paths(spark, named).join(named, "path").groupBy("problem").agg(F.sum("rows").alias("rows"))


@query("SELECT s_suppkey, s_name, NULL::INT AS grade, 0::BIGINT AS rows_of_like FROM supplier")
def like_table(spark, d):
    """A table of the catalog, one like it without rows, a clone with rows and a column more."""
    names = [f"weir_{k}_{uuid.uuid4().hex}" for k in ("own", "like", "clone")]
    own, empty, clone = names
    path = scratch(spark)
    try:
        tables.create_table(spark, own, {"s_suppkey": "integer", "s_name": "string"})
        supplier = table(spark, d, "supplier")
        supplier.select(*(supplier[f.name].cast(f.dataType).alias(f.name) for f in spark.table(own).schema)).write.insertInto(own)
        tables.like_table(spark, own, empty)
        tables.clone_table(spark, own, clone)
        tables.add_columns(spark, clone, {"grade": "integer"})
        rows = spark.table(clone).join(F.broadcast(spark.table(empty).agg(F.count("*").alias("rows_of_like"))), F.lit(True))  # one row
        rows.withColumns({"s_suppkey": F.col("s_suppkey").cast("long"), "grade": F.col("grade").cast("int")}).write.parquet(path)
    finally:
        for n in names:
            tables.drop_table(spark, n)
    return S.read_parquet(spark, path)

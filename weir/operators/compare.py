"""Comparison and profiling of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.query import except_common
from weir.sources.files import stage_and_verify
from weir.sources.scratch import scratch


def count_where(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).agg(F.count("*").alias("n"))


def _hash(columns: list[str]) -> Column:
    """Of a row; nulls are told apart by their positions, for xxhash64 passes over them."""
    nulls = F.concat_ws("", *(F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns))
    return F.xxhash64(nulls, *(F.col(f"`{c}`") for c in columns))


def checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: rows, xor and sum of row hashes, whatever the order. The sum tells pairs of equal rows, which cancel in the xor."""
    h = _hash(columns or sorted(df.columns))
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(h.cast("decimal(38,0)")).alias("total"))


def tables_equal(a: DataFrame, b: DataFrame, exclude: list[str] | None = None) -> bool:
    """Equal bags of rows on the common columns: counts and checksums in one pass each, then exact differences."""
    common = sorted((set(a.columns) & set(b.columns)) - set(exclude or []))
    x, y = checksum(a, common).first(), checksum(b, common).first()
    if x != y:
        return False
    return except_common(a, b, exclude, bag=True).isEmpty() and except_common(b, a, exclude, bag=True).isEmpty()


def _matched(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keyed rows of both sides in one full join, nulls in keys equal: in_a, in_b, same."""
    left = a.select(*(F.col(k).alias(f"a_{k}") for k in keys), F.struct(F.lit(1).alias("__is"), *columns).alias("a"))
    right = b.select(*(F.col(k).alias(f"b_{k}") for k in keys), F.struct(F.lit(1).alias("__is"), *columns).alias("b"))
    on = reduce(Column.__and__, (F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys))
    same = reduce(Column.__and__, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns), F.lit(True))
    joined = left.join(right, on, "full")
    own = [F.when(F.col("a").isNotNull(), F.col(f"a_{k}")).otherwise(F.col(f"b_{k}")).alias(k) for k in keys]
    return joined.select(*own, "a", "b", F.col("a").isNotNull().alias("in_a"), F.col("b").isNotNull().alias("in_b"), same.alias("same"))


def _columns(a: DataFrame, b: DataFrame, keys: list[str], exclude: list[str] | None) -> list[str]:
    return sorted((set(a.columns) & set(b.columns)) - set(keys) - set(exclude or []))


def _percent() -> Column:
    shared = F.col("matched") + F.col("mismatched")
    return F.when(shared > 0, F.round(100.0 * F.col("matched") / shared, 2)).otherwise(100.0)


def compare_report(a: DataFrame, b: DataFrame, keys: list[str], exclude: list[str] | None = None) -> DataFrame:
    """One row: rows of both sides, matched, mismatched, missing on either side, match_percent, has_drift, columns of one side only.

    a is the baseline. match_percent = round(100 * matched / (matched + mismatched), 2), 100 where nothing is shared.
    """
    m = _matched(a, b, keys, _columns(a, b, keys, exclude))
    both, n = F.col("in_a") & F.col("in_b"), F.count_if
    out = m.agg(
        n("in_a").alias("rows_a"), n("in_b").alias("rows_b"), n(both & F.col("same")).alias("matched"), n(both & ~F.col("same")).alias("mismatched"),
        n(F.col("in_a") & ~F.col("in_b")).alias("missing_in_b"), n(F.col("in_b") & ~F.col("in_a")).alias("missing_in_a"),
    )
    out = out.withColumn("match_percent", _percent())
    only_a, only_b = sorted(set(a.columns) - set(b.columns)), sorted(set(b.columns) - set(a.columns))
    drift = (F.col("mismatched") > 0) | (F.col("missing_in_a") > 0) | (F.col("missing_in_b") > 0) | F.lit(bool(only_a or only_b))
    return out.withColumns({"only_in_a": F.lit(",".join(only_a)), "only_in_b": F.lit(",".join(only_b)), "has_drift": drift})


def compare_sets(a: DataFrame, b: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """compare_report without keys, from set differences both ways."""
    missing_b, missing_a = (except_common(x, y, exclude).agg(F.count("*").alias(n)) for x, y, n in ((a, b, "missing_in_b"), (b, a, "missing_in_a")))
    common = sorted((set(a.columns) & set(b.columns)) - set(exclude or []))
    sums = [checksum(x, common).select(F.struct("rows", "xor", "total").alias(n)) for x, n in ((a, "sa"), (b, "sb"))]
    one = reduce(lambda x, y: x.join(F.broadcast(y), F.lit(True)), [missing_b, missing_a, *sums])  # one row each
    silent = (F.col("missing_in_a") == 0) & (F.col("missing_in_b") == 0) & (F.col("sa") != F.col("sb"))
    out = one.select(F.col("sa.rows").alias("rows_a"), F.col("sb.rows").alias("rows_b"), "missing_in_a", "missing_in_b", F.when(silent, F.col("sa.rows")).otherwise(F.lit(0)).cast("long").alias("mismatched"))
    return out.withColumn("matched", F.col("rows_a") - F.col("missing_in_b") - F.col("mismatched")).withColumn("has_drift", (F.col("missing_in_a") > 0) | (F.col("missing_in_b") > 0) | (F.col("mismatched") > 0))


def _comparable(c: Column, kind: str) -> Column:
    """A value that hashes as it compares: one zero, maps as text."""
    if kind in ("double", "float"):
        return c + F.lit(0.0)
    return F.to_json(c) if "map<" in kind else c


def exact_profile(df: DataFrame) -> DataFrame:
    """column, type, rows, nulls, distinct of each column, exactly.

    A row becomes a short one (column, hash of 128 bits) for each column. Equal ones are added up before they are
    dealt out by both, so that neither a wide row nor a frequent value is sent again and again.
    """
    cells = []
    for k, c in enumerate(df.columns):
        value = _comparable(F.col(f"`{c}`"), df.schema[c].dataType.simpleString())
        some = F.col(f"`{c}`").isNotNull()
        cells.append(F.struct(F.lit(k).alias("k"), F.when(some, F.xxhash64(value)).alias("a"), F.when(some, F.xxhash64(F.lit("second"), value)).alias("b")))
    values = df.select(F.explode(F.array(*cells)).alias("x")).groupBy("x.k", "x.a", "x.b").agg(F.count("*").alias("n"))
    facts = values.groupBy("k").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("a").alias("distinct"))
    names = df.sparkSession.createDataFrame([(k, c, df.schema[c].dataType.simpleString()) for k, c in enumerate(df.columns)], "k int, column string, type string")
    zero = [F.coalesce(n, F.lit(0)).alias(n) for n in ("rows", "nulls", "distinct")]
    return F.broadcast(names).join(facts, "k", "left").select("column", "type", *zero)  # a row a column


def compare_columns(a: DataFrame, b: DataFrame, approximate: bool = False) -> DataFrame:
    """For each column of either side: types, whether they agree, nulls and distinct values on both sides; approximate ones in one pass for a side."""
    names = sorted(set(a.columns) | set(b.columns))

    def side(df: DataFrame, tag: str) -> DataFrame:
        found = merged_profile(profile(df)) if approximate else exact_profile(df)
        return found.select("column", F.col("type").alias(f"type_{tag}"), F.col("nulls").alias(f"nulls_{tag}"), F.col("distinct").alias(f"distinct_{tag}"))

    spine = a.sparkSession.createDataFrame([(n,) for n in names], "column string")
    out = spine.join(side(a, "a"), "column", "left").join(side(b, "b"), "column", "left")
    return out.withColumn("same_type", F.coalesce(F.col("type_a") == F.col("type_b"), F.lit(False)))


def profile(df: DataFrame, by: Column | None = None, precision: int = 14) -> DataFrame:
    """part, column, type, rows, nulls, low and high (numbers and times as double, else text), sketch of distinct values: a table to keep.

    Profiles of parts (days, files, loads), each named differently, are taken once each; merged_profile() of any of them is the profile of their
    union, without a look at the rows. Each part is one aggregation, its sketches a few KB a column.
    """
    facts = [F.count("*").alias("rows")]
    for k, c in enumerate(df.columns):
        kind = df.schema[c].dataType.simpleString()
        value, number = F.col(f"`{c}`"), kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp"))
        plain = F.unix_micros(value.cast("timestamp")) / 1e6 if kind.startswith(("date", "timestamp")) else value.cast("double") if number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if number else F.to_json(value) if kind.startswith(("map", "array", "struct")) else value.cast("string")
        # sums, bounds and sketch of a column; NaN is no bound
        bound = F.when(~F.isnan(plain), plain)
        seen = F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(_comparable(value, kind))), F.lit(precision))
        facts += [F.count(value).alias(f"n{k}"), F.min(bound).alias(f"a{k}"), F.max(bound).alias(f"b{k}"), F.min(text).alias(f"c{k}"), F.max(text).alias(f"d{k}"), seen.alias(f"s{k}")]
    wide = df.groupBy((by if by is not None else F.lit(None).cast("string")).cast("string").alias("part")).agg(*facts)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("type"), F.col("rows"), (F.col("rows") - F.col(f"n{k}")).alias("nulls"), *(F.col(f"{x}{k}").alias(n) for x, n in (("a", "low"), ("b", "high"), ("c", "low_text"), ("d", "high_text"), ("s", "sketch")))) for k, c in enumerate(df.columns)]
    return wide.select("part", F.explode(F.array(*rows)).alias("x")).select("part", "x.*")


def merged_profile(profiles: DataFrame) -> DataFrame:
    """column, type, rows, nulls, distinct (estimated, within about 1 %), low, high, low_text, high_text of the union of the parts;
    a column whose type changed has both, and is null in the rows of parts that lack it."""
    whole = profiles.select("part", "rows").distinct().agg(F.sum("rows").alias("all"))
    out = profiles.groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("type"), F.sum("rows").alias("__rows"), F.sum("nulls").alias("__nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
        *(f(c).alias(c) for c, f in (("low", F.min), ("high", F.max), ("low_text", F.min), ("high_text", F.max))),
    )
    out = out.join(F.broadcast(whole), F.lit(True))  # one row
    return out.select("column", "type", F.col("all").alias("rows"), (F.col("__nulls") + F.col("all") - F.col("__rows")).alias("nulls"), "distinct", "low", "high", "low_text", "high_text")


def compare_samples(a: DataFrame, b: DataFrame, keys: list[str], exclude: list[str] | None = None, mismatched: int = 10, missing: int = 5) -> DataFrame:
    """The first differing rows by key, at most so many of each kind: kind, keys, both sides as JSON.

    One join for all kinds; each partition ranks its own rows and hands on no more than the limit, so that a kind with most rows is never in one task.
    """
    m = _matched(a, b, keys, _columns(a, b, keys, exclude)).where("not (in_a and in_b and same)")
    kind = F.when(~F.col("in_b"), "missing_in_b").when(~F.col("in_a"), "missing_in_a").otherwise("mismatched")
    first = m.withColumn("__kind", kind).withColumn("__rank", F.row_number().over(Window.partitionBy("__kind").orderBy(*keys))).where(F.col("__rank") <= max(mismatched, missing))
    some = first.where(F.col("__rank") <= F.when(F.col("__kind") == "mismatched", mismatched).otherwise(missing))
    return some.select(F.col("__kind").alias("kind"), *keys, F.to_json(F.col("a").dropFields("__is")).alias("row_a"), F.to_json(F.col("b").dropFields("__is")).alias("row_b"))


def compare_summary(reports: dict[str, DataFrame]) -> DataFrame:
    """One row over many datasets' reports: datasets, clean, drifted, lowest match_percent."""
    rows = reduce(DataFrame.unionByName, (r.select(F.lit(n).alias("dataset"), "has_drift", "match_percent") for n, r in reports.items()))
    return rows.agg(F.count("*").alias("datasets"), F.count_if(~F.col("has_drift")).alias("clean"), F.count_if("has_drift").alias("drifted"), F.min("match_percent").alias("lowest_match"))


def audit(df: DataFrame, rules: dict[str, tuple[Column, str]], keys: list[str] | None = None, expected_rows: int | None = None, max_loss: float | None = None) -> DataFrame:
    """For each check: failures, action, passed. rules: name -> (what a row must meet, action); a null test fails.

    Also that there are rows, that keys hold no null, and, given the expected number, that no larger share is lost.
    """
    checks: dict[str, tuple[Column, str]] = {"has_rows": (F.when(F.count("*") == 0, 1).otherwise(0).cast("long"), "abort")}
    for k in keys or []:
        checks[f"key_not_null:{k}"] = (F.count_if(F.col(k).isNull()), "abort")
    if expected_rows is not None and max_loss is not None:
        lost = F.greatest(F.lit(expected_rows) - F.count("*"), F.lit(0))
        checks["loss"] = (F.when(lost > F.lit(expected_rows * max_loss), lost).otherwise(0).cast("long"), "abort")
    for name, (ok, action) in rules.items():
        checks[name] = (F.count_if(~F.coalesce(ok, F.lit(False))), action)
    one = df.agg(*(c.alias(f"c{n}") for n, (c, _) in enumerate(checks.values())))
    rows = F.array(*(F.struct(F.lit(name).alias("check"), F.lit(action).alias("action"), F.col(f"c{n}").alias("failures")) for n, (name, (_, action)) in enumerate(checks.items())))
    return one.select(F.explode(rows).alias("x")).select("x.*", (F.col("x.failures") == 0).alias("passed"))


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def checksum_tree(df: DataFrame, keys: list[str], columns: list[str] | None = None, leaves: int = 1 << 16, fan: int = 256) -> DataFrame:
    """level, bucket, rows, xor, total: sums of row hashes by bucket of the key's hash, and of buckets `fan` by `fan` up to one root (level 0).

    A table's tree is a small table to keep: at most leaves * fan / (fan - 1) rows, whatever its size. Trees of
    the same keys, columns and sizes tell where two tables differ without a look at their rows.
    """
    columns = columns or sorted(set(df.columns) - set(keys))
    h = _hash([*keys, *columns])
    level = df.groupBy(F.pmod(_hash(keys), F.lit(leaves)).alias("bucket")).agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(h.cast("decimal(38,0)")).alias("total"))
    depth = 0
    while fan**depth < leaves:
        depth += 1
    up = [F.struct(F.lit(d).alias("level"), F.floor(F.col("bucket") / F.lit(fan ** (depth - d))).alias("bucket")) for d in range(depth + 1)]
    return level.select(F.explode(F.array(*up)).alias("x"), "rows", "xor", "total").groupBy("x.level", "x.bucket").agg(F.sum("rows").alias("rows"), F.bit_xor("xor").alias("xor"), F.sum("total").alias("total"))


def differing_leaves(tree_a: DataFrame, tree_b: DataFrame, fan: int = 256) -> DataFrame:
    """(bucket) of the leaves whose sums differ; level by level only what lies below a difference is compared."""
    depth = tree_a.unionByName(tree_b).agg(F.max("level")).first()[0] or 0
    found: DataFrame | None = None
    for d in range(depth + 1):
        a, b = (t.where(F.col("level") == d).select("bucket", F.struct("rows", "xor", "total").alias(n)) for t, n in ((tree_a, "a"), (tree_b, "b")))
        both = a.join(b, "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")
        if found is not None:
            both = both.join(found.select(F.col("bucket").alias("above")), F.floor(F.col("bucket") / F.lit(fan)) == F.col("above"), "left_semi")
        found = both
    return found


def _in_buckets(df: DataFrame, keys: list[str], leaves: int, wanted: DataFrame) -> DataFrame:
    return df.withColumn("__bucket", F.pmod(_hash(keys), F.lit(leaves))).join(wanted.withColumnRenamed("bucket", "__bucket"), "__bucket", "left_semi").drop("__bucket")


def compare_drilldown(a: DataFrame, b: DataFrame, keys: list[str], exclude: list[str] | None = None, leaves: int | None = None, fan: int = 256, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """compare_report, for which only rows of differing buckets are joined, with the number of those, joined_rows.

    Two sums over the tables, or their kept trees, tell the buckets; equal ones count as matched. Where most rows differ,
    compare_report is the shorter way. Without `leaves` there are 65,536, and where a bucket of so many has more than two
    rows and over a twentieth of the rows are in differing ones, these rows alone are summed again, in buckets of about one
    or two rows: how many rows are joined depends on how many differ, and not on the size of the tables.
    """
    columns = _columns(a, b, keys, exclude)
    first = leaves or 1 << 16
    summed = lambda pair, n, k: tuple(stage_and_verify(checksum_tree(x, keys, columns, n, k), scratch(a.sparkSession)) for x in pair)
    tree_a, tree_b = trees or summed((a, b), first, fan)  # written, so that each table is summed once, however many levels are compared
    wanted = differing_leaves(tree_a, tree_b, fan)
    some = [_in_buckets(df, keys, first, F.broadcast(wanted)) for df in (a, b)]  # at most `first` numbers
    if leaves is None:
        low = tree_a.unionByName(tree_b).agg(F.max("level")).first()[0] or 0
        own = tree_a.unionByName(tree_b).where(F.col("level") == low).join(F.broadcast(wanted.withColumn("in", F.lit(1))), "bucket", "left")
        rows, within = own.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("in") == 1, F.col("rows"))), F.lit(0))).first()
        if rows > 4 * first and 20 * within > rows:
            finer = 1 << (int(rows) // 4).bit_length()
            wanted = differing_leaves(*summed(some, finer, finer), finer)  # no levels between: most of them differ
            some = [_in_buckets(df, keys, finer, wanted) for df in some]
    report = compare_report(*some, keys, exclude)
    roots = [t.where("level = 0").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(n)) for t, n in ((tree_a, "all_a"), (tree_b, "all_b"))]
    out = reduce(lambda x, y: x.join(F.broadcast(y), F.lit(True)), [report, *roots])  # one row each
    out = out.withColumns({"joined_rows": F.col("rows_a") + F.col("rows_b"), "matched": F.col("matched") + F.col("all_a") - F.col("rows_a")})
    out = out.withColumns({"rows_a": F.col("all_a"), "rows_b": F.col("all_b")}).drop("all_a", "all_b")
    return out.withColumn("match_percent", _percent())

"""Declarative queries: a spec of clauses over named tables, built with the DataFrame API."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A predicate: SQL text, {column: value} (all equal), a Column, or (column, operator, value).
Predicate = str | dict[str, Any] | Column | tuple


@dataclass(frozen=True)
class Join:
    table: str
    on: str | list[str] | None = None
    how: str = "inner"


@dataclass(frozen=True)
class Block:
    """One query block. qualify filters on window results; sql stands alone or is wrapped by the other clauses."""

    name: str = ""
    table: str | None = None
    select: list[str] = field(default_factory=list)
    joins: list[Join] = field(default_factory=list)
    where: list[Predicate] = field(default_factory=list)
    group_by: list[str | int] = field(default_factory=list)
    having: list[str] = field(default_factory=list)
    qualify: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=list)
    limit: int | None = None
    sql: str | None = None
    sql_file: str | None = None


@dataclass(frozen=True)
class Query:
    """Blocks in order, each seeing the earlier ones; the result is `main`, or else the last block."""

    blocks: list[Block] = field(default_factory=list)
    main: Block | None = None


_COMPARE = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "<>": lambda c, v: c != v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "LIKE": lambda c, v: c.like(v), "NOT LIKE": lambda c, v: ~c.like(v), "ILIKE": lambda c, v: c.ilike(v), "RLIKE": lambda c, v: c.rlike(v),
    "IS": lambda c, v: c.isNull() if v is None else c.eqNullSafe(v), "IS NOT": lambda c, v: c.isNotNull() if v is None else ~c.eqNullSafe(v),
    "BETWEEN": lambda c, v: c.between(*v), "IN": lambda c, v: c.isin(list(v)), "NOT IN": lambda c, v: ~c.isin(list(v)),
}


def predicate(p: Predicate) -> Column:
    if isinstance(p, Column):
        return p
    if isinstance(p, str):
        return F.expr(p)
    if isinstance(p, dict):
        return reduce(Column.__and__, (F.col(k) == v for k, v in p.items()), F.lit(True))
    column, op, value = p
    try:
        return _COMPARE[op.strip().upper()](F.expr(column), value)
    except KeyError:
        raise ValueError(f"unknown operator {op!r}") from None


def filtered(df: DataFrame, where: list[Predicate]) -> DataFrame:
    """Rows that meet all predicates."""
    return df.filter(reduce(Column.__and__, map(predicate, where))) if where else df


def semi(df: DataFrame, other: DataFrame, on: str | list[str] | Column, negate: bool = False) -> DataFrame:
    """EXISTS: rows with a match in other; NOT EXISTS: rows without one. A null key never matches."""
    return df.join(other, on, "left_anti" if negate else "left_semi")


def not_in(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """NOT IN over a subquery, null-aware: a row stays only if no row of other is equal or unknown to it.

    Two rows are unknown to each other if a comparison has a null and no other column differs. Rows are taken by which
    columns are null, on either side, so that each case that there is becomes an anti join on what both know: one
    where no column holds a null.
    """
    def has(nulls: tuple[bool, ...]) -> Column:
        return reduce(Column.__and__, (F.col(c).isNull() if n else F.col(c).isNotNull() for c, n in zip(columns, nulls, strict=True)))

    def cases(rows: DataFrame) -> list[tuple[bool, ...]]:
        return sorted(tuple(r) for r in rows.select(*(F.col(c).isNull().alias(c) for c in columns)).distinct().collect())

    other = other.select(*columns)
    there = cases(other)
    parts = [df.limit(0)]
    for nulls in cases(df) if there else []:
        part = df.where(has(nulls))
        for theirs in there:
            known = [c for c, a, b in zip(columns, nulls, theirs, strict=True) if not a and not b]
            part = part.join(other.where(has(theirs)).select(*known).distinct(), known, "left_anti") if known else part.limit(0)
        parts.append(part.select(df.columns))
    return reduce(DataFrame.unionByName, parts) if there else df


def join_any(df: DataFrame, other: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Left join with at most one row of other for a key: the first in the given order."""
    rest = [c for c in other.columns if c not in keys]
    first = other.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")) if rest else other.select(*keys).distinct()
    joined = df.join(first, keys, "left")
    return joined.select(*df.columns, *(F.col(f"__row.{c}").alias(c) for c in rest))


_HOW = {"inner": "inner", "left": "left", "right": "right", "full": "full", "outer": "full", "semi": "left_semi", "anti": "left_anti"}


def _joined(df: DataFrame, joins: list[Join], tables: dict[str, DataFrame]) -> DataFrame:
    for j in joins:
        other = _table(j.table, tables)
        if j.how == "cross":
            df = df.crossJoin(other)
        elif j.on is None:
            raise ValueError(f"a join with {j.table} needs a condition")
        else:
            df = df.join(other, F.expr(j.on) if isinstance(j.on, str) else j.on, _HOW[j.how.lower()])
    return df


def _table(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    table, _, alias = name.partition(" ")
    if table not in tables:
        raise ValueError(f"unknown table {table!r}; known: {', '.join(sorted(tables))}")
    return tables[table].alias(alias.strip() or table)


def _bare(expression: str) -> str:
    """What stands before the alias of a select item."""
    head, found, _ = expression.rpartition(" AS ") if " AS " in expression else expression.rpartition(" as ")
    return head if found else expression


def build(spark: SparkSession, block: Block, tables: dict[str, DataFrame]) -> DataFrame:
    text = block.sql
    if block.sql_file:
        if text:
            raise ValueError("give sql or sql_file, not both")
        text = "\n".join(r.value for r in spark.read.text(block.sql_file, wholetext=True).collect())
    if text:
        if block.table or block.joins:
            raise ValueError("raw sql takes the place of a table and its joins")
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        df = spark.sql(text)
    elif block.table:
        df = _joined(_table(block.table, tables), block.joins, tables)
    else:
        raise ValueError("a block needs a table or sql")
    df = filtered(df, block.where)
    items = block.select or ["*"]
    if block.group_by:
        keys = [F.expr(_bare(items[k - 1]) if isinstance(k, int) else k) for k in block.group_by]
        texts = {_bare(items[k - 1]) if isinstance(k, int) else k for k in block.group_by}
        aggregates = [F.expr(i) for i in items if _bare(i) not in texts]
        names = [f"__key{n}" for n in range(len(keys))]
        grouped = df.groupBy(*(k.alias(n) for k, n in zip(keys, names, strict=True))).agg(*aggregates)
        key_of = dict(zip((_bare(items[k - 1]) if isinstance(k, int) else k for k in block.group_by), names, strict=True))
        plain = [c for c in grouped.columns if c not in names]
        out, rest = [], iter(plain)
        for i in items:
            if _bare(i) in key_of:
                out.append(F.col(key_of[_bare(i)]).alias(i[len(_bare(i)) + 4 :] if _bare(i) != i else i.rpartition(".")[2]))
            else:
                out.append(F.col(f"`{next(rest)}`"))
        df = grouped.select(*out)
    elif block.select:
        df = df.select(*map(F.expr, block.select))
    df = filtered(df, block.having)
    for n, q in enumerate(block.qualify):
        df = _qualified(df, q, f"__qualify{n}")
    if block.order_by:
        df = df.orderBy(*map(_order, block.order_by))
    return df if block.limit is None else df.limit(block.limit)


def _qualified(df: DataFrame, condition: str, name: str) -> DataFrame:
    """QUALIFY: a window function can't stand in a filter, so the condition becomes a column first."""
    return df.withColumn(name, F.expr(condition)).filter(name).drop(name)


def _order(item: str) -> Column:
    words = item.split()
    return F.desc(" ".join(words[:-1])) if words[-1].lower() == "desc" else F.asc(" ".join(words[:-1]) if words[-1].lower() == "asc" else item)


def run(spark: SparkSession, query: Query | Block, tables: dict[str, DataFrame]) -> DataFrame:
    """The result of a query over named tables. The first block without a table reads the only table there is."""
    if isinstance(query, Block):
        query = Query(main=query)
    known = dict(tables)
    out = None
    for n, b in enumerate(query.blocks):
        if n == 0 and not b.table and not b.sql and not b.sql_file and len(tables) == 1:
            b = Block(**{**b.__dict__, "table": next(iter(tables))})
        out = build(spark, b, known)
        if b.name:
            known[b.name] = out
    if query.main:
        return build(spark, query.main, known)
    if out is None:
        raise ValueError("an empty query")
    return out


def peek(spark: SparkSession, df: DataFrame, sql: str = "SELECT * FROM self", rows: int = 20, tail: bool = False) -> DataFrame:
    """The first rows of ad-hoc SQL over a table named self, or (tail) the last ones; those come to the driver, so many at most."""
    df.createOrReplaceTempView("self")
    out = spark.sql(sql)
    return spark.createDataFrame(out.tail(rows), out.schema) if tail else out.limit(rows)


def except_common(a: DataFrame, b: DataFrame, exclude: list[str] | None = None, bag: bool = False) -> DataFrame:
    """Rows of a that b lacks, on the sorted common columns: distinct, or as often as they are more (bag)."""
    common = sorted((set(a.columns) & set(b.columns)) - set(exclude or []))
    a, b = a.select(*common), b.select(*common)
    return a.exceptAll(b) if bag else a.subtract(b)


def column_sets(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    return {"common": sorted(set(a.columns) & set(b.columns)), "only_left": sorted(set(a.columns) - set(b.columns)), "only_right": sorted(set(b.columns) - set(a.columns))}

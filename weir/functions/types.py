"""Generic column types, casts to them, and unions of tables whose types differ."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERIC: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "decimal": T.DecimalType(38, 9),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "json": T.StringType(),
    "binary": T.BinaryType(),
}


def spark_type(generic: str) -> T.DataType:
    try:
        return GENERIC[generic.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown type {generic!r}; known: {', '.join(GENERIC)}") from None


def apply_contract(df: DataFrame, columns: dict[str, str], strict: bool = False) -> DataFrame:
    """Casts the named columns to generic types; the others pass, in their order. Not strict: what can't be cast is null."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"contract names absent columns: {', '.join(missing)}")

    def column(name: str) -> F.Column:
        if name not in columns:
            return F.col(f"`{name}`")
        wanted, c = columns[name], F.col(f"`{name}`")
        if wanted.lower() == "json" and isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c).alias(name)
        if wanted.lower() == "time":
            return F.date_format(c.cast("timestamp"), "HH:mm:ss").alias(name)
        kind = spark_type(wanted)
        return (c.cast(kind) if strict else c.try_cast(kind)).alias(name)

    return df.select(*map(column, df.columns))


def override_types(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """As apply_contract, before a write: columns whose name starts with _ keep their type, absent ones are passed over."""
    return apply_contract(df, {k: v for k, v in columns.items() if k in df.columns and not k.startswith("_")})


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """The type that holds all of them: equal, else whole numbers, else double, else date and time, else string."""
    some = [t for t in types if not isinstance(t, T.NullType)]
    if not some:
        return T.StringType()
    if all(t == some[0] for t in some):
        return some[0]
    if all(isinstance(t, _WHOLE) for t in some):
        return T.LongType()
    if all(isinstance(t, T.DecimalType) or isinstance(t, _WHOLE) for t in some):
        return T.DecimalType(38, 9)
    if all(isinstance(t, T.NumericType) for t in some):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in some):
        return T.TimestampNTZType()
    return T.StringType()


def union_relaxed(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames: columns in order of first sight, absent ones null, types widened to the common one."""
    if not frames:
        raise ValueError("nothing to unite")
    seen: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema:
            seen.setdefault(f.name, []).append(f.dataType)
    wide = {n: common_type(ts) for n, ts in seen.items()}

    def column(df: DataFrame, n: str) -> F.Column:
        if n not in df.columns:
            return F.lit(None).cast(wide[n]).alias(n)
        own, c = df.schema[n].dataType, F.col(f"`{n}`")
        if own != wide[n] and isinstance(own, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        return c.cast(wide[n]).alias(n)

    return reduce(DataFrame.union, (df.select(*(column(df, n) for n in wide)) for df in frames))

"""Operators on columns: nulls, nested values, JSON text, names, metadata, masks, repair, quarantine."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.types import GENERIC


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def null_if(df: DataFrame, values: list[str]) -> DataFrame:
    """The listed values become null in every string column."""
    return df.withColumns({c: F.when(~F.col(c).isin(values), F.col(c)) for c in _strings(df)}) if values else df


def flatten(df: DataFrame, depth: int = 0) -> DataFrame:
    """Structs give way to parent_child columns at the end. depth: levels to open, 0 all, -1 none."""
    level = 0
    while depth >= 0 and (depth == 0 or level < depth):
        structs = [f for f in df.schema if isinstance(f.dataType, T.StructType)]
        if not structs:
            break
        gone = {f.name for f in structs}
        keep = [F.col(f"`{c}`") for c in df.columns if c not in gone]
        opened = [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}_{g.name}") for f in structs for g in f.dataType]
        df, level = df.select(*keep, *opened), level + 1
    return df


def parse_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """String columns of JSON objects or arrays become structs, arrays or maps of an inferred schema; "", {}, [] and null become null.

    Without names, a column is taken for JSON if it has values, and each of them in all rows parses as an object or an
    array; other columns stay as they are. The schemas are inferred in the same aggregation.
    """
    names = _strings(df) if columns is None else columns
    if not names:
        return df
    facts = []
    for c in names:
        text = F.col(quoted(c))
        blank = text.isNull() | (F.trim(text) == "")
        parsed = F.ltrim(text).rlike(r"^[{\[]") & F.try_parse_json(text).isNotNull()
        facts += [F.coalesce(F.bool_and(blank | F.coalesce(parsed, F.lit(False))) & F.bool_or(~blank), F.lit(False)), F.expr(f"schema_of_variant_agg(try_parse_json({quoted(c)}))")]
    found = df.agg(*(f.alias(f"f{k}") for k, f in enumerate(facts))).first()
    out = {}
    for k, c in enumerate(names):
        kind = re.sub(r"\bOBJECT<", "STRUCT<", found[2 * k + 1] or "VOID")
        if (columns is not None or found[2 * k]) and kind not in ("VOID", "VARIANT"):
            out[c] = F.from_json(F.when(~F.trim(quoted(c)).isin("", "{}", "[]", "null"), F.col(quoted(c))), kind)
    return df.withColumns(out)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sanitize(df: DataFrame) -> DataFrame:
    """Binary as text, NULs cut from both ends of texts, dates and times as yyyy-MM-dd HH:mm:ss."""
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            c = c.cast("string")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            out[f.name] = F.regexp_replace(c, r"^\x00+|\x00+$", "")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out)


CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def repair_json(c: Column) -> Column:
    """Without commas before a closing bracket."""
    return F.regexp_replace(c, r",\s*([\]}])", "$1")


#: What a name is made of: capitals before a capitalised word, a word with its first capitals, capitals alone.
PIECE = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]*[a-z0-9]+|[A-Z]+")
CASES = {"lower": str.lower, "upper": str.upper, "caps": lambda p: p[:1].upper() + p[1:], "title": str.title, "none": str}
JOINTS = {"snake": "_", "kebab": "-", "camel": ""}


def styled_name(name: str, style: str = "snake", case: str = "lower") -> str:
    """A name in a style (snake, kebab, camel, none) and case (lower, upper, caps, title, none); a leading _ keeps it as it is."""
    if style == "camel" and case not in ("caps", "none"):
        raise ValueError("camel goes with caps or none")
    if name[:1] == "_":
        return name
    pieces = [name] if style == "none" else PIECE.findall(name) or [name]
    if style == "camel":
        pieces = [CASES["title" if k or case == "caps" else "lower"](p.lower()) for k, p in enumerate(pieces)]
        case = "none"
    return JOINTS.get(style, "").join(CASES[case](p) for p in pieces)


def renamed(names: list[str], style: str = "snake", case: str = "lower") -> list[str]:
    """Styled names; one that is taken gets _1, _2, ..."""
    taken: dict[str, int] = {}  # each name given out, and the number that a next one of the same style would try
    for n in names:
        base = new = styled_name(n, style, case)
        while new in taken:
            taken[base] += 1
            new = f"{base}_{taken[base]}"
        taken[new] = 0
    return list(taken)


def rename_columns(df: DataFrame, style: str = "snake", case: str = "lower") -> DataFrame:
    return df.toDF(*renamed(df.columns, style, case))


META = {"run_id": "_run_id", "partition_date": "_partition_date", "source": "_source", "loaded_at": "_loaded_at", "deleted": "_is_deleted"}


def add_metadata(df: DataFrame, wanted: dict[str, bool | str], *, run_id: str = "", partition_date: Column | None = None, source: Column | DataFrame | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Adds the wanted columns: True for the usual name, a string for another. Columns that exist are left alone.

    source: a column, or a table (partition_date, source) that is joined, of several rows for a day the least; `deleted` is a null timestamp, live rows.
    """
    names = {k: META[k] if v is True else v for k, v in wanted.items() if v}
    new = {k: n for k, n in names.items() if n not in df.columns}
    day = partition_date if partition_date is not None else F.lit(None).cast("date")
    values = {"run_id": F.lit(run_id), "partition_date": day, "loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(), "deleted": F.lit(None).cast("timestamp_ntz")}
    if "source" in new:
        if isinstance(source, DataFrame):
            of = source.groupBy(F.col("partition_date").alias("__day")).agg(F.min("source").alias(new["source"]))
            df = df.withColumn("__day", day).join(of, "__day", "left").drop("__day")
        else:
            df = df.withColumn(new["source"], source if source is not None else F.lit(None).cast("string"))
    return df.withColumns({n: values[k] for k, n in new.items() if k != "source"})


def masked(c: Column, rule: str = "fixed", char: str = "*") -> Column:
    """fixed: eight signs for any value; sha256: hex digest; last_4: signs for all but the last four."""
    text = c.cast("string")
    rule = rule.lower()
    if rule == "fixed":
        return F.when(c.isNotNull(), F.lit(char * 8))
    if rule == "sha256":
        return F.sha2(text, 256)
    if rule == "last_4":
        hidden = F.greatest(F.length(text) - 4, F.lit(0))
        return F.concat(F.repeat(F.lit(char), hidden), F.right(text, F.lit(4)))
    raise ValueError(f"unknown mask {rule!r}")


@dataclass(frozen=True)
class Contract:
    """One column: where it comes from, its name and type, its mask, whether it is of the key."""

    source: str
    target: str
    kind: str = "string"
    mask: str = ""
    key: bool = False


def apply_contracts(df: DataFrame, contracts: list[Contract]) -> DataFrame:
    def column(c: Contract) -> Column:
        source = F.col(f"`{c.source}`")
        return (masked(source, c.mask) if c.mask else source.try_cast(GENERIC[c.kind])).alias(c.target)

    return df.select(*map(column, contracts))


def read_contracts(rows: list[dict[str, str]]) -> list[Contract]:
    """From the rows of a contract file: source_col, target_col, dtype, masking, primary_key."""
    return [Contract(r["source_col"], r.get("target_col") or r["source_col"], (r.get("dtype") or "string").lower(), r.get("masking") or "", (r.get("primary_key") or "").lower() in ("1", "true", "y", "yes")) for r in rows]


def template(name: str, *columns: Column) -> Column:
    """The named scalar and aggregate templates."""
    one = columns[0]
    made = {
        "cast_to_date": lambda: one.cast("date"),
        "cast_to_string": lambda: one.cast("string"),
        "md5": lambda: F.md5(F.concat_ws("|", *(c.cast("string") for c in columns))),
        "coalesce": lambda: F.coalesce(*columns),
        "hash": lambda: F.xxhash64(*columns),
        "hash_agg": lambda: F.bit_xor(F.xxhash64(*columns)),
    }
    if name not in made:
        raise ValueError(f"unknown template {name!r}")
    return made[name]()


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all rules, and the rest with quarantine_reason, the names of the rules they break. A null test counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    judged = df.withColumn("quarantine_reason", F.array_join(broken, "; "))
    return judged.where("quarantine_reason = ''").drop("quarantine_reason"), judged.where("quarantine_reason != ''")


"""Table maintenance: merges as pure functions of target and staging, schema evolution, verification."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


class MergeError(ValueError):
    pass


def require_columns(target: DataFrame, staging: DataFrame) -> None:
    missing = [c for c in target.columns if c not in staging.columns]
    if missing:
        raise MergeError(f"staging lacks columns of the target: {', '.join(missing)}")


def like(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Staging with the target's columns and types."""
    require_columns(target, staging)
    return staging.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema))


def compatibility(target: DataFrame, staging: DataFrame) -> DataFrame:
    """column_name, status, target_type, staging_type, n_lost of each column of either table: whether staging can be loaded.

    missing: staging lacks it. extra: the target does. same: the types are. Else n_lost counts the staging values that the
    target's type can't hold: those whose cast is null, and numbers that the cast changes; cast if there are none, lossy if
    there are. Types without a cast between them raise. All columns are judged in one pass over staging, which reads only
    columns whose types differ.
    """
    of, have = {f.name: f.dataType for f in target.schema}, {f.name: f.dataType for f in staging.schema}

    def lost(name: str) -> Column:
        value = F.col("`" + name.replace("`", "``") + "`")
        held = value.try_cast(of[name])
        changed = held.try_cast(have[name]) != value if isinstance(have[name], NumericType) else F.lit(False)
        return F.count_if(value.isNotNull() & (held.isNull() | F.coalesce(changed, F.lit(True))))

    differ = [c for c in of if c in have and of[c] != have[c]]
    counts = staging.agg(*(lost(c).alias(f"n{k}") for k, c in enumerate(differ))) if differ else target.sparkSession.range(1)

    def row(name: str) -> Column:
        n = F.col(f"n{differ.index(name)}") if name in differ else F.lit(0)
        status = F.when(n > 0, "lossy").otherwise("cast") if name in differ else F.lit("missing" if name not in have else "extra" if name not in of else "same")
        types = (F.lit(t[name].simpleString() if name in t else None).cast("string") for t in (of, have))
        return F.struct(F.lit(name).alias("column_name"), status.alias("status"), *(t.alias(c) for t, c in zip(types, ("target_type", "staging_type"), strict=True)), n.cast("long").alias("n_lost"))

    return counts.select(F.inline(F.array(*map(row, dict.fromkeys([*of, *have])))))


def require_compatible(target: DataFrame, staging: DataFrame) -> None:
    """Raises if staging lacks a column or has values that the target's types can't hold."""
    bad = compatibility(target, staging).where("status in ('missing', 'lossy')").collect()  # a row a column
    if bad:
        raise MergeError("; ".join(f"{r.column_name}: {r.status}" + (f", {r.n_lost} values of {r.staging_type} are no {r.target_type}" if r.n_lost else "") for r in bad))


def full_refresh(target: DataFrame, staging: DataFrame) -> DataFrame:
    return like(target, staging)


def delete_insert(target: DataFrame, staging: DataFrame, key: Column | str) -> DataFrame:
    """Target rows whose key value staging has are replaced by staging's rows; null keys stay. All key values at once."""
    k = F.col(key) if isinstance(key, str) else key
    values = staging.select(k.alias("__key")).where("__key is not null").distinct()
    kept = target.withColumn("__key", k).join(values, "__key", "left_anti").select(target.columns)
    return kept.unionByName(like(target, staging))


def unique(staging: DataFrame, keys: list[str], latest_by: str | None = None) -> DataFrame:
    """Staging with one row for a key: the one with the largest `latest_by` (null the least); rows with a null in the key all stay."""
    if latest_by is None:
        return staging
    rest = F.struct(F.col(latest_by).alias("__by"), *(c for c in staging.columns if c not in keys))
    whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    last = staging.where(whole).groupBy(*keys).agg(F.max(rest).alias("__row"))
    last = last.select(*(F.col(c) if c in keys else F.col(f"__row.{c}") for c in staging.columns))
    return last.unionByName(staging.where(~whole))


def require_unique(staging: DataFrame, keys: list[str]) -> None:
    whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    twice = staging.where(whole).groupBy(*keys).count().where("count > 1").limit(1).count()
    if twice:
        raise MergeError(f"staging has several rows for one ({', '.join(keys)})")


def update(target: DataFrame, staging: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Matched target rows take all other columns from staging, nulls too. Several staging rows for a key are an error."""
    if check:
        require_unique(staging, keys)
    staging = like(target, staging)
    s = staging.select(*keys, F.struct(*(c for c in target.columns if c not in keys), F.lit(True).alias("__is")).alias("__new"))
    joined = target.join(s, keys, "left")
    return joined.select(*(F.col(c) if c in keys else F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns))


def insert_new(target: DataFrame, staging: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Staging rows whose key the target lacks are added; a key with a null never matches, so its row is added. Several rows for a key are an error."""
    if check:
        require_unique(staging, keys)
    return target.unionByName(like(target, staging).join(target.select(*keys), keys, "left_anti").select(target.columns))


def upsert(target: DataFrame, staging: DataFrame, keys: list[str], latest_by: str | None = None, check: bool = True) -> DataFrame:
    """Update of the matched and insert of the new, in one anti join: staging replaces what it matches."""
    staging = unique(staging, keys, latest_by)
    if check and latest_by is None:
        require_unique(staging, keys)
    return target.join(staging.select(*keys), keys, "left_anti").select(target.columns).unionByName(like(target, staging))


def soft_delete(target: DataFrame, staging: DataFrame, keys: list[str], at: Column, column: str = "_is_deleted", scope: Column | None = None) -> DataFrame:
    """Live rows in scope whose key staging lacks get a time of deletion.

    As NOT IN: one null in staging's keys leaves nothing to delete, and a target row with a null key is left alone
    unless staging is empty. Judged on the target as it was before the merge.
    """
    wanted = (scope if scope is not None else F.lit(True)) & F.col(column).isNull()
    nulls = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    facts = staging.agg(F.coalesce(F.bool_or(nulls), F.lit(False)).alias("__nulls"), (F.count("*") == 0).alias("__none"))
    have = staging.select(*keys).distinct().withColumn("__have", F.lit(True))
    joined = target.join(have, keys, "left").join(F.broadcast(facts), F.lit(True))  # one row
    gone = F.coalesce(wanted, F.lit(False)) & F.col("__have").isNull() & ~F.col("__nulls") & (~nulls | F.col("__none"))
    return joined.select(*(F.when(gone, at.cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in target.columns))


def dml_update(df: DataFrame, values: dict[str, Column], where: Column) -> DataFrame:
    hit = F.coalesce(where, F.lit(False))
    return df.select(*(F.when(hit, values[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns))


def dml_delete(df: DataFrame, where: Column) -> DataFrame:
    return df.filter(~F.coalesce(where, F.lit(False)))


def dml_insert(df: DataFrame, rows: DataFrame | list[dict]) -> DataFrame:
    """With the rows of a query, or literal records whose absent columns are null."""
    if isinstance(rows, list):
        rows = df.sparkSession.createDataFrame([tuple(r.get(c) for c in df.columns) for r in rows], df.schema)
    return df.unionByName(like(df, rows))


@dataclass(frozen=True)
class Policy:
    """mode: full_refresh, delete_insert (needs update_key), upsert, update or insert (need keys)."""

    mode: str
    keys: list[str] | None = None
    update_key: str | None = None
    latest_by: str | None = None
    soft_delete: str | None = None


LOADS = {"FULL_REFRESH": "full_refresh", "SNAPSHOT": "delete_insert", "CDC": "upsert"}
DELTAS = {"delete_insert": "delete_insert", "update_insert": "upsert", "update": "update"}


def policy_for(load: str, merge: str | None = None, keys: list[str] | None = None, update_key: str | None = None, latest_by: str | None = None, soft_delete: str | None = None) -> Policy:
    """The policy of a load type: FULL_REFRESH, SNAPSHOT, CDC, or DELTA with a merge of its own.

    soft_delete: a column in which target rows that staging lacks get a time of deletion; it needs keys.
    """
    load = load.upper()
    mode = DELTAS.get(merge or "") if load == "DELTA" else LOADS.get(load)
    if mode is None:
        raise MergeError(f"no policy for {load} with {merge}")
    if mode == "delete_insert" and not update_key:
        raise MergeError(f"{load} needs an update key")
    if mode in ("upsert", "update") and not keys:
        raise MergeError(f"{load} needs a primary key")
    if soft_delete and not keys:
        raise MergeError(f"{load} needs a primary key to mark what is gone")
    return Policy(mode, keys, update_key, latest_by, soft_delete)


def apply_policy(target: DataFrame, staging: DataFrame, p: Policy, deleted_at: Column | None = None, scope: Column | None = None) -> DataFrame:
    """The merged table. Missing rows are marked on the target before the merge."""
    if p.soft_delete:
        target = soft_delete(target, staging, p.keys, deleted_at if deleted_at is not None else F.current_timestamp(), p.soft_delete, scope)
    if p.mode == "full_refresh":
        return full_refresh(target, staging)
    if p.mode == "delete_insert":
        return delete_insert(target, staging, p.update_key)
    if p.mode == "update":
        return update(target, unique(staging, p.keys, p.latest_by), p.keys, p.latest_by is None)
    if p.mode == "insert":
        return insert_new(target, unique(staging, p.keys, p.latest_by), p.keys, p.latest_by is None)
    return upsert(target, staging, p.keys, p.latest_by)


def verification(merged: DataFrame, staging: DataFrame, p: Policy, deleted: str | None = None, target: DataFrame | None = None) -> DataFrame:
    """One row: expected and found rows, ok.

    full_refresh: all rows. delete_insert: live rows with staging's key values. Else: staged keys found in the result; of
    an update only those that the target had, which is needed for that.
    """
    if p.mode == "full_refresh":
        expected, found = staging.agg(F.count("*").alias("expected")), merged.agg(F.count("*").alias("found"))
    elif p.mode == "delete_insert":
        live = merged.where(F.col(deleted).isNull()) if deleted else merged
        values = staging.select(p.update_key).distinct()
        expected = staging.where(F.col(p.update_key).isNotNull()).agg(F.count("*").alias("expected"))
        found = live.join(values, p.update_key, "left_semi").agg(F.count("*").alias("found"))
    else:
        whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in p.keys))
        staged = staging.where(whole).select(*p.keys).distinct()
        if p.mode == "update":
            if target is None:
                raise MergeError("an update is verified against the target as it was")
            staged = staged.join(target.select(*p.keys), p.keys, "left_semi")
        expected = staged.agg(F.count("*").alias("expected"))
        found = staged.join(merged.select(*p.keys), p.keys, "left_semi").agg(F.count("*").alias("found"))
    return expected.join(F.broadcast(found), F.lit(True)).withColumn("ok", F.col("expected") == F.col("found"))  # one row each


def verify(merged: DataFrame, staging: DataFrame, p: Policy, deleted: str | None = None, target: DataFrame | None = None) -> None:
    r = verification(merged, staging, p, deleted, target).first()
    if not r.ok:
        raise MergeError(f"{p.mode}: expected {r.expected} rows, found {r.found}")


@dataclass(frozen=True)
class Evolution:
    """What a load changes in the target: columns added, and staging columns left out."""

    added: list[tuple[str, str]]
    dropped: list[str]


def reconcile(target: DataFrame, staging: DataFrame, add_new: bool, metadata: tuple[str, ...] = ("_run_id", "_partition_date", "_source", "_loaded_at", "_is_deleted")) -> Evolution:
    """Missing columns are an error; metadata columns are always added, others only if allowed, else left out."""
    require_columns(target, staging)
    new = [f for f in staging.schema if f.name not in target.columns]
    added = [(f.name, f.dataType.simpleString()) for f in new if add_new or f.name in metadata]
    return Evolution(added, [f.name for f in new if f.name not in {n for n, _ in added}])


def evolve(target: DataFrame, staging: DataFrame, add_new: bool) -> tuple[DataFrame, DataFrame, Evolution]:
    e = reconcile(target, staging, add_new)
    return target.withColumns({n: F.lit(None).cast(t) for n, t in e.added}), staging.drop(*e.dropped), e


def evolution_log(df: DataFrame, e: Evolution, run_id: str, table: str, at: Column, by: str) -> DataFrame:
    """One row for each added column, for the schema-change log; df gives the session."""
    rows = df.sparkSession.createDataFrame([(run_id, table, "ADD_COLUMN", n, t) for n, t in e.added], "run_id string, target_table string, action string, column_name string, data_type string")
    return rows.withColumns({"executed_at": at, "executed_by": F.lit(by)})


def partition_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct values of a partition key, times cut to days."""
    c = F.to_date(key) if df.schema[key].dataType.typeName().startswith("timestamp") else F.col(key)
    return df.select(c.alias("partition_key")).where("partition_key is not null").distinct()

"""Incremental loading: checkpoints, the predicates they give, high-water marks, days to catch up."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_checkpoint(checkpoints: DataFrame, by: list[str], at: str = "created_at", tie: str | None = None) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in checkpoints.columns if c not in by]
    order = F.struct(at, *([tie] if tie else []))
    last = checkpoints.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return last.select(*(F.col(c) if c in by else F.col(f"__row.{c}") for c in checkpoints.columns))


def _day(value: str | None) -> date | None:
    try:
        return date.fromisoformat(value[:10]) if value and re.fullmatch(r"\d{4}-\d\d-\d\d", value[:10]) else None
    except ValueError:
        return None


def range_predicate(column: str, start: str | None, end: str | None) -> Column:
    """start <= column, and column before the day after end if end is a date, else column <= end. Without bounds, all rows."""
    c, parts = F.col(column), []
    if start:
        parts.append(c >= F.lit(start).cast("timestamp_ntz") if _day(start) else c >= F.lit(start))
    if end:
        parts.append(c < F.lit(str(_day(end) + timedelta(days=1))).cast("timestamp_ntz") if _day(end) and len(end) <= 10 else c <= F.lit(end))
    return reduce(Column.__and__, parts, F.lit(True))


def number_predicate(column: str, start: int | float | None, end: int | float | None) -> Column:
    """LSN and offset ranges: start < column <= end."""
    parts = [F.col(column) > F.lit(start)] if start is not None else []
    return reduce(Column.__and__, parts + ([F.col(column) <= F.lit(end)] if end is not None else []), F.lit(True))


def dates_predicate(column: str, dates: list[str]) -> Column:
    return F.to_date(column).isin([date.fromisoformat(d) for d in dates]) if dates else F.lit(False)


def path_predicate(path: Column, pattern: str, dates: list[str]) -> Column:
    """Paths that hold the pattern filled with one of the dates: {YYYY}, {MM}, {DD}, {partition_date}."""
    def filled(d: str) -> str:
        y, m, day = d.split("-")
        return pattern.format(YYYY=y, MM=m, DD=day, partition_date=d)

    return reduce(Column.__or__, (path.contains(filled(d)) for d in dates), F.lit(False))


def modified_predicate(column: str, epoch: float) -> Column:
    return F.col(column) > F.timestamp_micros(F.lit(int(epoch * 1_000_000)))


def high_water_mark(df: DataFrame, key: str, old: Column | None = None) -> DataFrame:
    """One row: smallest and largest key, rows; the largest never falls behind the old mark."""
    end = F.max(key) if old is None else F.greatest(F.max(key), old)
    return df.agg(F.min(key).alias("start_value"), end.alias("end_value"), F.count("*").alias("rows_loaded"))


def catchup_dates(spark: SparkSession, start: str | None, end: str, delta: bool = True) -> DataFrame:
    """The days to load: each after start up to end; the end alone if not delta, or if start is absent, no date, or not before it."""
    first, last = _day(start), _day(end)
    if not delta or first is None or last is None or first >= last:
        return spark.range(1).select(F.lit(end).try_cast("date").alias("partition_date"))
    days = F.sequence(F.lit(first + timedelta(days=1)), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("partition_date"))


def resolve_date(now: Column, years: int = 0, months: int = 0, days: int = 0, override: str | None = None, pattern: str = "yyyy-MM-dd") -> Column:
    """A run's partition date as text: the override, or a time moved by an offset."""
    return F.lit(override) if override else F.date_format(F.date_add(F.add_months(F.to_date(now), 12 * years + months), days), pattern)


def extract_report(df: DataFrame, partition: Column, key: str, source: Column | None = None, file: Column | None = None) -> DataFrame:
    """For each partition: rows, files, first and last key, source."""
    facts = [F.count("*").alias("rows_loaded"), F.min(key).alias("checkpoint_start"), F.max(key).alias("checkpoint_end")]
    facts += [F.count_distinct(file).alias("files")] if file is not None else []
    facts += [F.min(source).alias("source")] if source is not None else []
    return df.groupBy(partition.alias("partition_date")).agg(*facts)


def guarded(staging: DataFrame, target: DataFrame, merge, retry=None) -> tuple[DataFrame, bool]:
    """merge(target, staging), or the target as it is if staging, and what one retry reads, hold no row; and whether it merged."""
    if staging.isEmpty() and retry is not None:
        staging = retry()
    return (target, False) if staging.isEmpty() else (merge(target, staging), True)


def checkpoint_row(spark: SparkSession, values: dict, at: datetime) -> DataFrame:
    """A row for the checkpoint table."""
    schema = "run_id string, job_id string, dataset_id string, partition_date date, checkpoint_type string, checkpoint_start_value string, checkpoint_end_value string, rows_loaded long, source string, created_at timestamp_ntz"
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple((values | {"created_at": at}).get(n) for n in names)], schema)

"""Analytics of append-only logs: latest states, schedules, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], where: Column | None = None) -> DataFrame:
    """The row of each key with the largest order values, of those that meet the condition. Aggregated, not sorted: a hot key is pre-reduced."""
    rest = [c for c in df.columns if c not in keys]
    some = df if where is None else df.where(where)
    last = some.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return last.select(*(F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns))


def argmax_tuple(df: DataFrame, keys: list[str], value: str, order: list[Column], name: str) -> DataFrame:
    """For each key the value at the largest tuple."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


_FIELDS = (("minute", 0, 59), ("hour", 0, 23), ("dom", 1, 31), ("month", 1, 12), ("dow", 0, 7))


def cron_values(expression: str) -> tuple[list[list[int]], bool, bool]:
    """Allowed values of minute, hour, day, month, weekday (0 Sunday), and whether day and weekday are restricted."""
    fields = expression.split()
    if len(fields) != 5:
        raise ValueError(f"a recurrence has five fields: {expression!r}")
    out = []
    for text, (name, low, high) in zip(fields, _FIELDS, strict=True):
        values: set[int] = set()
        for item in text.split(","):
            body, _, step = item.partition("/")
            a, _, b = body.partition("-")
            first = low if body == "*" else int(a)
            last = high if body == "*" or (step and not b) else int(b or a)
            if not (low <= first <= last <= high) or (step and int(step) < 1):
                raise ValueError(f"bad {name} {item!r}")
            values |= set(range(first, last + 1, int(step or 1)))
        out.append(sorted({v % 7 for v in values} if name == "dow" else values))
    return out, fields[2] != "*", fields[4] != "*"


def slots(spine: DataFrame, schedules: list[tuple[str, str]]) -> DataFrame:
    """(job_id, slot): the ticks of spine(tick) at which each (job_id, recurrence) fires.

    One join on minute and hour for all schedules, of which each is at most 1440 rows; days are tested on what it finds.
    """
    rows = []
    for job, expression in schedules:
        (minute, hour, dom, month, dow), by_day, by_weekday = cron_values(expression)
        rows.append((job, minute, hour, dom, month, dow, by_day and by_weekday))
    table = spine.sparkSession.createDataFrame(rows, "job_id string, minutes array<int>, hours array<int>, days array<int>, months array<int>, weekdays array<int>, either boolean")
    table = table.withColumn("minute", F.explode("minutes")).withColumn("hour", F.explode("hours")).drop("minutes", "hours")
    ticks = spine.select("tick", F.minute("tick").alias("minute"), F.hour("tick").alias("hour"))
    day, weekday = F.array_contains("days", F.dayofmonth("tick")), F.array_contains("weekdays", F.dayofweek("tick") - 1)
    fits = F.array_contains("months", F.month("tick")) & F.when(F.col("either"), day | weekday).otherwise(day & weekday)
    return ticks.join(table, ["minute", "hour"]).where(fits).select("job_id", F.col("tick").alias("slot"))


def minutes(df: DataFrame, start: Column, days: int = 1) -> DataFrame:
    """(…, tick): each minute from a time for so many days, both ends included: 1441 a day."""
    return df.withColumn("tick", F.explode(F.sequence(start, start + F.expr(f"interval {days} day"), F.expr("interval 1 minute"))))


def missing_slots(planned: DataFrame, logged: DataFrame, keys: list[str], as_of: Column, soon: int = 60) -> DataFrame:
    """Planned slots without a log row; due_soon: the slot comes within so many minutes of a time."""
    wait = F.timestamp_diff("MINUTE", as_of, F.col("slot"))
    return planned.join(logged.select(*keys).distinct(), keys, "left_anti").withColumn("due_soon", (wait >= 0) & (wait <= soon))


def policy_pick(planned: DataFrame, key: str, as_of: Column) -> DataFrame:
    """planned(key, slot, is_snapshot): of snapshots the latest due slot and the next two, of others the two oldest."""
    due = F.col("slot") <= as_of
    p = planned.withColumn("due", due)
    newest = F.row_number().over(Window.partitionBy(key, "due").orderBy(F.desc("slot")))
    oldest = F.row_number().over(Window.partitionBy(key, "due").orderBy("slot"))
    first = F.row_number().over(Window.partitionBy(key).orderBy("slot"))
    p = p.withColumns({"newest": newest, "oldest": oldest, "first": first})
    snapshot = (F.col("due") & (F.col("newest") == 1)) | (~F.col("due") & (F.col("oldest") <= 2))
    return p.where((F.col("is_snapshot") & snapshot) | (~F.col("is_snapshot") & (F.col("first") <= 2))).drop("newest", "oldest", "first")


def error_rollup(log: DataFrame, keys: list[str], at: str, status: str, detail: str, failed: str = "FAILED", success: str = "SUCCESS", tie: str | None = None) -> DataFrame:
    """For keys that ever failed: first and last failure, failures, detail of the last one, whether the latest state is a success."""
    bad = F.col(status) == failed
    order = F.struct(at, *([tie] if tie else []))
    out = log.groupBy(*keys).agg(
        F.min(F.when(bad, F.col(at))).alias("first_failure"), F.max(F.when(bad, F.col(at))).alias("last_failure"), F.count_if(bad).alias("failures"),
        F.max_by(F.col(detail), F.when(bad, order)).alias("last_detail"), (F.max_by(status, order) == success).alias("resolved"),
    )
    return out.where("failures > 0")


def p95_duration(log: DataFrame, step: str, duration: str, where: Column, cap: float, default: float, factor: float = 1.5, enough: int = 10, approximate: bool = False) -> DataFrame:
    """For each step: samples, p95, and a limit: p95 * factor up to the cap, the default for few samples.

    The exact percentile lies between two estimates, on all sides of small groups: durations below them are counted,
    only those between them are ordered. Samples without a duration count, but don't enter the percentile.
    """
    some = log.where(where).select(F.col(step).alias("step"), F.col(duration).cast("double").alias("x"))
    if approximate:
        out = some.groupBy("step").agg(F.count("*").alias("samples"), F.percentile_approx("x", 0.95, 10_000).alias("p95"))
    else:
        n = F.count("x")
        e = F.percentile_approx("x", [0.0, 0.949, 0.951, 1.0], 10_000)  # at most n / 10,000 places off
        range_ = some.groupBy("step").agg(F.count("*").alias("samples"), (0.95 * (n - 1)).alias("place"), F.when(n < 10_000, e[0]).otherwise(e[1]).alias("low"), F.when(n < 10_000, e[3]).otherwise(e[2]).alias("high"))
        inside = some.alias("s").join(range_.alias("r"), F.col("s.step").eqNullSafe(F.col("r.step"))).where("x <= high")
        counts = inside.groupBy("r.step", "place", F.when(F.col("x") >= F.col("low"), F.col("x")).alias("x")).agg(F.count("*").alias("n"))  # null: all below
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("step").orderBy(F.asc_nulls_first("x"))))
        at = [F.min(F.when(F.col("upto") > edge, F.col("x"))) for edge in (F.floor("place"), F.ceil("place"))]
        part = F.max(F.col("place") - F.floor("place"))
        found = upto.groupBy("step").agg(((1 - part) * at[0] + part * at[1]).alias("p95"))
        out = range_.alias("r").join(found.alias("f"), F.col("r.step").eqNullSafe(F.col("f.step")), "left").select("r.step", "samples", "p95")
    out = out.withColumnRenamed("step", step)
    return out.withColumn("time_limit", F.when(F.col("samples") > enough, F.least(F.col("p95") * factor, F.lit(cap))).otherwise(F.lit(default)))


def slot_id(keys: list[Column], slot: Column) -> Column:
    """yyyyMMdd-HHmmss- and eight digits of a hash of keys and slot."""
    text = F.concat_ws("|", *(k.cast("string") for k in keys), F.date_format(slot, "yyyy-MM-dd HH:mm:ss"))
    return F.concat(F.date_format(slot, "yyyyMMdd-HHmmss-"), F.substring(F.md5(text), 1, 8))


def expired_slots(planned: DataFrame, key: str, as_of: Column) -> DataFrame:
    """planned with next_slot and expired: the key's next slot has passed."""
    following = F.lead("slot").over(Window.partitionBy(key).orderBy("slot"))
    return planned.withColumn("next_slot", following).withColumn("expired", F.coalesce(F.col("next_slot") <= as_of, F.lit(False)))


def current_state(log: DataFrame, planned: DataFrame, keys: list[str], order: list[Column], status: str = "status") -> DataFrame:
    """Latest logged states and, as PENDING, planned slots that the log lacks."""
    latest = latest_per_key(log, keys, order).select(*keys, status)
    waiting = planned.join(log.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit("PENDING").alias(status))
    return latest.unionByName(waiting)


def state_fold(log: DataFrame, keys: list[str], at: str, status: str, terminal: list[str], tie: str | None = None) -> DataFrame:
    """The state of each key: a terminal status is never undone by another, and the newer time wins among equals."""
    order = [F.col(status).isin(terminal), F.col(at), *([F.col(tie)] if tie else [])]
    return latest_per_key(log, keys, order)


def daily_digest(log: DataFrame, day: Column, at: str, sections: dict[str, Column]) -> DataFrame:
    """(section, rows) of a day: how many rows of it each condition holds for."""
    one = log.where(F.to_date(at) == day).agg(*(F.count_if(c).alias(f"s{n}") for n, c in enumerate(sections.values())))
    rows = F.array(*(F.struct(F.lit(name).alias("section"), F.col(f"s{n}").alias("rows")) for n, name in enumerate(sections)))
    return one.select(F.explode(rows).alias("x")).select("x.*")

"""Recurrences in a column: the next occurrence by search in sorted arrays, and all of a range, without a spine of minutes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed names of months and weekdays, in order.
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
WEEKDAYS = "SUN MON TUE WED THU FRI SAT".split()

_ITEM = r"(\*|[0-9]+(-[0-9]+)?)(/[0-9]+)?"
_FIELD = rf"{_ITEM}(,{_ITEM})*"


def _numbers(field: Column, names: list[str], first: int) -> Column:
    return reduce(lambda c, kn: F.regexp_replace(c, kn[1], str(kn[0])), enumerate(names, first), F.upper(field))


def _values(field: Column, low: int, high: int) -> Column:
    """The sorted values of a field, null if one is out of its range or a step is 0."""

    def item(x: Column) -> Column:
        body, step = F.split_part(x, F.lit("/"), F.lit(1)), F.split_part(x, F.lit("/"), F.lit(2))
        start, end = F.split_part(body, F.lit("-"), F.lit(1)), F.split_part(body, F.lit("-"), F.lit(2))
        a = F.when(body == "*", F.lit(low)).otherwise(start.try_cast("int"))
        b = F.when((body == "*") | ((end == "") & (step != "")), F.lit(high)).when(end == "", a).otherwise(end.try_cast("int"))
        every = F.when(step == "", 1).otherwise(step.try_cast("int"))
        return F.when((a >= low) & (a <= b) & (b <= high) & (every >= 1), F.sequence(a, b, F.greatest(every, F.lit(1))))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(field, ","), item))))


def with_recurrence(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with a recurrence of five fields (minute, hour, day of month, month, weekday with 0 and 7 for Sunday; names allowed) as
    sorted arrays: struct(minutes, hours, days, months, weekdays, by_day, by_weekday). Null for what is none.

    Each step is a projection, so that the next ones use its value and don't repeat its expression.
    """
    parts = [F.col(f"__f{k}") for k in range(5)]
    out = df.withColumn("__f", F.split(F.trim(F.col(f"`{text}`")), r"\s+"))
    fields = [F.get("__f", F.lit(k)) for k in range(5)]
    fields[3], fields[4] = _numbers(fields[3], MONTHS, 1), _numbers(fields[4], WEEKDAYS, 0)
    out = out.withColumns({f"__f{k}": F.when(F.size("__f") == 5, f) for k, f in enumerate(fields)})
    out = out.withColumn("__fits", reduce(Column.__and__, (F.coalesce(p.rlike(f"^{_FIELD}$"), F.lit(False)) for p in parts)))
    out = out.withColumns({f"__v{k}": F.when(F.col("__fits"), _values(p, a, b)) for k, (p, a, b) in enumerate(zip(parts, (0, 0, 1, 1, 0), (59, 23, 31, 12, 7), strict=True))})
    weekdays = F.array_sort(F.array_distinct(F.transform("__v4", lambda x: x % 7)))
    values = [*(F.col(f"__v{k}") for k in range(4)), weekdays]
    struct = F.struct(*(v.alias(n) for v, n in zip(values, ("minutes", "hours", "days", "months", "weekdays"), strict=True)), (parts[2] != "*").alias("by_day"), (parts[4] != "*").alias("by_weekday"))
    whole = reduce(Column.__and__, (F.col(f"__v{k}").isNotNull() for k in range(5)))
    return out.withColumn(name, F.when(whole, struct)).drop("__f", "__fits", *(f"__{c}{k}" for c in "fv" for k in range(5)))


def _read_once(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the recurrence in a column and its minutes of a day ({name}_minutes), of which each different text is read once and not row by row; null for what is none.

    The text that is read is an aggregate, so that no condition on what it says is moved to where all rows are.
    """
    texts = df.groupBy(F.col(f"`{text}`").alias("__key")).agg(F.max(F.col(f"`{text}`")).alias("__text"))
    minutes = F.flatten(F.transform(F.col(f"{name}.hours"), lambda h: F.transform(F.col(f"{name}.minutes"), lambda m: h * 60 + m)))
    read = with_recurrence(texts, "__text", name).drop("__text").withColumn(f"{name}_minutes", minutes)
    return df.join(read, F.col(f"`{text}`") == F.col("__key"), "left").drop("__key")


def _day_in_month(r: Column, start: Column) -> Column:
    """The first fitting day from a date to the end of its month, or null; where both day and weekday are restricted either will do."""
    last = F.last_day(start)
    day = F.get(F.filter(r.days, lambda d: (d >= F.dayofmonth(start)) & (d <= F.dayofmonth(last))), F.lit(0))
    by_day = F.date_add(F.trunc(start, "MM"), day - 1)
    ahead = F.array_min(F.transform(r.weekdays, lambda w: F.pmod(w - (F.dayofweek(start) - 1), F.lit(7))))
    weekday = F.date_add(start, ahead)
    by_weekday = F.when(weekday <= last, weekday)
    found = F.when(r.by_day & r.by_weekday, F.least(by_day, by_weekday)).when(r.by_day, by_day).when(r.by_weekday, by_weekday).otherwise(start)
    return F.when(F.array_contains(r.months, F.month(start)), found)


def with_next(df: DataFrame, text: str, at: Column, name: str = "next") -> DataFrame:
    """df with the first occurrence after a time (timestamp_ntz) of the recurrence in a column: null where there is none, as on
    30 February, or the text is no recurrence.

    The next minute, hour, day and month are found by search in the recurrence's arrays, so that the work for a row does
    not depend on how far away it is: today, else this month, else one of the next twelve, else one of 97, in which any
    day of a month comes, of leap years too.
    """
    r = F.col("__r")
    t, today, hour, start = (F.col(f"__{c}") for c in ("t", "today", "hour", "start"))
    out = _read_once(df, text, "__r")
    out = out.withColumn("__t", F.date_trunc("minute", at.cast("timestamp_ntz")).cast("timestamp_ntz") + F.expr("interval 1 minute"))
    out = out.withColumns({"__today": F.to_date(t), "__hour": F.hour(t), "__least": F.minute(t), "__first": F.get(r.minutes, F.lit(0))})
    minute = F.when(F.array_contains(r.hours, hour), F.get(F.filter(r.minutes, lambda m: m >= F.col("__least")), F.lit(0)))
    out = out.withColumns({"__minute": minute, "__later": F.get(F.filter(r.hours, lambda h: h > hour), F.lit(0))})
    # minutes of today, if there are some left
    out = out.withColumn("__left", F.coalesce(hour * 60 + F.col("__minute"), F.col("__later") * 60 + F.col("__first")))
    out = out.withColumn("__start", F.when(F.col("__left").isNotNull(), today).otherwise(F.date_add(today, 1)))
    out = out.withColumns({"__day": _day_in_month(r, start), "__month": F.trunc(start, "MM")})
    for a, b in ((1, 12), (13, 97)):
        months = F.transform(F.sequence(F.lit(a), F.lit(b)), lambda k: _day_in_month(r, F.add_months(F.col("__month"), k)))
        out = out.withColumn("__day", F.when(F.col("__day").isNotNull() | r.isNull(), F.col("__day")).otherwise(F.get(F.filter(months, lambda d: d.isNotNull()), F.lit(0))))
    minutes = F.when((F.col("__day") == today) & F.col("__left").isNotNull(), F.col("__left")).otherwise(F.get(r.hours, F.lit(0)) * 60 + F.col("__first"))
    out = out.withColumn(name, F.when(r.isNotNull(), F.col("__day").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)))
    return out.drop("__r", "__r_minutes", "__t", "__today", "__hour", "__least", "__first", "__minute", "__later", "__left", "__start", "__day", "__month")


def occurrences(df: DataFrame, text: str, start: Column, end: Column, name: str = "slot") -> DataFrame:
    """df with a row for each occurrence of the recurrence in a column from a time to another, both included; only they are made."""
    out = _read_once(df, text, "__r").withColumns({"__a": start.cast("timestamp_ntz"), "__b": end.cast("timestamp_ntz")}).where("__r is not null and __a <= __b")
    r = F.col("__r")
    day, weekday = F.array_contains(r.days, F.dayofmonth("__day")), F.array_contains(r.weekdays, F.dayofweek("__day") - 1)
    out = out.withColumn("__day", F.explode(F.sequence(F.to_date("__a"), F.to_date("__b"))))
    out = out.where(F.array_contains(r.months, F.month("__day")) & F.when(r.by_day & r.by_weekday, day | weekday).otherwise(day & weekday))
    midnight = F.col("__day").cast("timestamp_ntz")
    passed = lambda t: F.timestamp_diff("MICROSECOND", midnight, F.col(t)) / F.lit(60e6)
    # minutes of the day are compared as numbers, so that times are only made of those that are wanted
    out = out.withColumns({"__from": F.ceil(passed("__a")), "__to": F.floor(passed("__b"))}).withColumn("__minute", F.explode("__r_minutes"))
    out = out.where(F.col("__minute").between(F.col("__from"), F.col("__to")))
    return out.withColumn(name, midnight + F.make_dt_interval(mins=F.col("__minute"))).drop("__r", "__r_minutes", "__a", "__b", "__day", "__from", "__to", "__minute")


def expired_recurrences(planned: DataFrame, text: str, slot: str, as_of: Column) -> DataFrame:
    """planned with next_slot, by its recurrence and not by other rows, and expired: that has passed."""
    out = with_next(planned, text, F.col(slot), "next_slot")
    return out.withColumn("expired", F.coalesce(F.col("next_slot") <= as_of.cast("timestamp_ntz"), F.lit(False)))

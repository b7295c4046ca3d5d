"""Recurrences against a search minute by minute and against the parser of fixed schedules."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from weir.operators import logs
from weir.operators import recurrence as R


def fits(expression, day):
    (_, _, dom, month, dow), by_day, by_weekday = logs.cron_values(expression)
    d, w = day.day in dom, day.isoweekday() % 7 in dow
    return day.month in month and (d or w if by_day and by_weekday else d and w)


def plain_next(expression, at):
    (minutes, hours, *_), _, _ = logs.cron_values(expression)
    at = at.replace(second=0, microsecond=0) + timedelta(minutes=1)
    day = at.replace(hour=0, minute=0)
    for _ in range(366 * 9):
        if fits(expression, day):
            for h in hours:
                for m in minutes:
                    if (t := day.replace(hour=h, minute=m)) >= at:
                        return t
        day += timedelta(days=1)
    return None


def cases():
    rng = random.Random(11)
    field = lambda a, b: rng.choice(["*", "*", f"*/{rng.randint(1, 9)}", str(rng.randint(a, b)), f"{rng.randint(a, (a + b) // 2)}-{rng.randint((a + b) // 2, b)}", f"{rng.randint(a, b)},{rng.randint(a, b)}", f"{rng.randint(a, b)}/3"])
    times = [datetime(2023, 12, 31, 23, 59, 59, 999999), datetime(2024, 2, 28, 12), datetime(2024, 2, 29, 23, 59), datetime(2097, 3, 1), datetime(2024, 7, 31, 0, 0)]
    out = [(" ".join((field(0, 59), field(0, 23), field(1, 31), field(1, 12), field(0, 7))), datetime(2000, 1, 1) + timedelta(minutes=rng.randrange(50 * 525_600), seconds=rng.randrange(60))) for _ in range(150)]
    fixed = ["* * * * *", "0 0 29 2 *", "0 0 31 4,6 *", "30 6 30 2 *", "59 23 31 12 *", "0 0 1 * 1", "0 12 * * 7", "*/7 5 */2 * 1-5", "0 0 29 2 1"]
    return out + [(e, t) for e in fixed for t in times]


def test_next_occurrences(spark):
    df = spark.createDataFrame([(k, e, t) for k, (e, t) in enumerate(cases())], "k int, e string, t timestamp_ntz")
    got = {r.k: (r.e, r.t, r.n) for r in R.with_next(df, "e", F.col("t"), "n").collect()}
    wrong = [(e, t, n, want) for e, t, n in got.values() if n != (want := plain_next(e, t))]
    assert not wrong, wrong[:5]


def test_names_and_what_is_no_recurrence(spark):
    at = datetime(2024, 1, 31, 10, 0)
    texts = ["0 9 * feb MON-fri", " 0  9\t* 2 1-5 ", None, "", "* * * *", "* * * * * *", "60 * * * *", "* 24 * * *", "* * 0 * *", "* * * 13 *", "*/0 * * * *", "5-2 * * * *", "a * * * *", "* * * * 8"]
    df = spark.createDataFrame([(k, e, at) for k, e in enumerate(texts)], "k int, e string, t timestamp_ntz")
    got = [r.n for r in R.with_next(df, "e", F.col("t"), "n").orderBy("k").collect()]
    assert got == [datetime(2024, 2, 1, 9)] * 2 + [None] * (len(texts) - 2)
    assert R.with_next(spark.createDataFrame([("* * * * *", None)], "e string, t timestamp"), "e", F.col("t")).first()["next"] is None


def test_occurrences_are_those_of_a_spine(spark):
    schedules = [("a", "*/20 8-9 * * 1-5"), ("b", "0 0 1 * 1"), ("c", "15 * 31 * *"), ("d", "nonsense")]
    start, end = datetime(2024, 1, 30, 8, 20), datetime(2024, 3, 5, 0, 0)
    df = spark.createDataFrame([(*s, start, end) for s in schedules], "job_id string, e string, a timestamp_ntz, b timestamp_ntz")
    got = {(r.job_id, r.slot) for r in R.occurrences(df, "e", F.col("a"), F.col("b")).collect()}
    spine = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz").select(F.explode(F.expr("sequence(a, b, interval 1 minute)")).alias("tick"))
    assert got == {tuple(r) for r in logs.slots(spine, schedules[:3]).collect()} and len(got) > 100


def test_equal_texts_are_read_once(spark, tmp_path):
    """The plan reads fields above the aggregation by text and nowhere else, the filters on what they say included."""
    spark.range(1000).select(F.element_at(F.array(F.lit("*/20 8-9 * * 1-5"), F.lit("no"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("e"), F.expr("timestamp_ntz'2024-01-01'").alias("t")).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    for out in (R.occurrences(df, "e", F.col("t"), F.col("t")+ F.expr("interval 1 day")), R.with_next(df, "e", F.col("t"))):
        plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        grouped = [k for k, line in enumerate(plan) if "Aggregate [e#" in line]
        assert len(grouped) == 1
        reading = [k for k, line in enumerate(plan) if "RLIKE" in line]
        assert reading and all(k < grouped[0] and depth(plan[k]) < depth(plan[grouped[0]]) for k in reading)
        joined = next(k for k, line in enumerate(plan) if "Join" in line)
        assert all(k > joined for k in reading)
        assert out.count() == (334 * 6 if "slot" in out.columns else 1000)

"""Registered queries of log analytics: events are the log (user_id the key, event_type the status, value the duration)."""

from pyspark.sql import functions as F

from weir.operators import logs as L
from weir.operators import recurrence as R
from weir.plans.registry import query, table



def _events(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query("SELECT event_id, ts, user_id, event_type, value FROM events WHERE value > 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, d):
    return L.latest_per_key(_events(spark, d), ["user_id"], [F.col("ts"), F.col("event_id")], F.col("value") > 1)


@query("SELECT user_id, event_type AS status FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'click' DESC, ts DESC, event_id DESC) = 1")
def argmax_tuple(spark, d):
    return L.argmax_tuple(_events(spark, d), ["user_id"], "event_type", [F.col("event_type") == "click", F.col("ts"), F.col("event_id")], "status")


_JOBS = [("quarter", "*/15 8-17 * * 1-5"), ("monthly", "0 0 1 * 1"), ("twice", "5,35 * * * *")]
_SPINE = "(SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 MINUTE)) AS tick)"
_SLOTS = f"""p AS (SELECT 'quarter' AS job_id, tick AS slot FROM {_SPINE} WHERE minute(tick) % 15 = 0 AND hour(tick) BETWEEN 8 AND 17 AND isodow(tick) <= 5
  UNION ALL SELECT 'monthly', tick FROM {_SPINE} WHERE minute(tick) = 0 AND hour(tick) = 0 AND (day(tick) = 1 OR isodow(tick) = 1)
  UNION ALL SELECT 'twice', tick FROM {_SPINE} WHERE minute(tick) IN (5, 35))"""
# A slot is logged if an event came in its minute, and taken by job by the event's number.
_LOG = "l AS (SELECT ['quarter', 'monthly', 'twice'][event_id % 3 + 1] AS job_id, date_trunc('minute', ts) AS slot, ts, event_id, event_type AS status FROM events)"


def _spine(spark):
    return L.minutes(spark.range(1), F.expr("timestamp_ntz'2024-01-01'"), 30).select("tick")


def _planned(spark):
    return L.slots(_spine(spark), _JOBS)


def _log(spark, d):
    job = F.element_at(F.array(*(F.lit(j) for j in ("quarter", "monthly", "twice"))), (F.col("event_id") % 3 + 1).cast("int"))
    return table(spark, d, "events").select(job.alias("job_id"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("slot"), "ts", "event_id", F.col("event_type").alias("status"))


@query(f"WITH {_SLOTS}, {_LOG} SELECT p.job_id, p.slot, count(l.event_id) AS logged FROM p LEFT JOIN l USING (job_id, slot) GROUP BY 1, 2")
def spine_match(spark, d):
    return _planned(spark).join(_log(spark, d), ["job_id", "slot"], "left").groupBy("job_id", "slot").agg(F.count("event_id").alias("logged"))


@query(f"""WITH {_SLOTS}, {_LOG} SELECT job_id, slot, slot >= TIMESTAMP '2024-01-15 12:00:00' AND slot <= TIMESTAMP '2024-01-15 13:00:00' AS due_soon FROM p
  WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.job_id = p.job_id AND l.slot = p.slot)""")
def missing_slots(spark, d):
    return L.missing_slots(_planned(spark), _log(spark, d), ["job_id", "slot"], F.expr("timestamp_ntz'2024-01-15 12:00:00'"))


@query(f"""WITH {_SLOTS}, {_LOG}, w AS (SELECT job_id, slot, slot <= TIMESTAMP '2024-01-15 12:00:00' AS due, job_id <> 'twice' AS is_snapshot FROM p WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.job_id = p.job_id AND l.slot = p.slot)),
  r AS (SELECT *, row_number() OVER (PARTITION BY job_id, due ORDER BY slot DESC) AS newest, row_number() OVER (PARTITION BY job_id, due ORDER BY slot) AS oldest, row_number() OVER (PARTITION BY job_id ORDER BY slot) AS first FROM w)
  SELECT job_id, slot, is_snapshot, due FROM r WHERE CASE WHEN is_snapshot THEN (due AND newest = 1) OR (NOT due AND oldest <= 2) ELSE first <= 2 END""")
def policy_pick(spark, d):
    at = F.expr("timestamp_ntz'2024-01-15 12:00:00'")
    waiting = L.missing_slots(_planned(spark), _log(spark, d), ["job_id", "slot"], at).select("job_id", "slot", (F.col("job_id") != "twice").alias("is_snapshot"))
    return L.policy_pick(waiting, "job_id", at)


@query("""SELECT user_id, min(ts) FILTER (event_type = 'error') AS first_failure, max(ts) FILTER (event_type = 'error') AS last_failure, count(*) FILTER (event_type = 'error') AS failures,
  arg_max(event_id, (ts, event_id)) FILTER (event_type = 'error') AS last_detail, arg_max(event_type, (ts, event_id)) = 'purchase' AS resolved FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'error') > 0""")
def error_rollup(spark, d):
    return L.error_rollup(_events(spark, d), ["user_id"], "ts", "event_type", "event_id", "error", "purchase", "event_id")


@query("""SELECT event_type, count(*) AS samples, round(quantile_cont(value, 0.95), 6) AS p95, round(CASE WHEN count(*) > 10 THEN least(quantile_cont(value, 0.95) * 1.5, 120.0) ELSE 60.0 END, 6) AS time_limit
  FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY event_type""")
def p95_duration(spark, d):
    out = L.p95_duration(_events(spark, d), "event_type", "value", F.col("ts") >= F.expr("timestamp_ntz'2024-01-05'"), 120.0, 60.0)
    return out.withColumns({"p95": F.round("p95", 6), "time_limit": F.round("time_limit", 6)})


@query("SELECT event_id, concat(strftime(ts, '%Y%m%d-%H%M%S-'), substring(md5(concat(user_id, '|', event_type, '|', strftime(ts, '%Y-%m-%d %H:%M:%S'))), 1, 8)) AS slot_id FROM events")
def slot_id(spark, d):
    return table(spark, d, "events").select("event_id", L.slot_id([F.col("user_id"), F.col("event_type")], F.col("ts")).alias("slot_id"))


@query("""WITH p AS (SELECT DISTINCT concat('user-', user_id) AS job_id, date_trunc('hour', ts) AS slot FROM events)
  SELECT job_id, slot, lead(slot) OVER w AS next_slot, coalesce(lead(slot) OVER w <= TIMESTAMP '2024-01-15 12:00:00', FALSE) AS expired FROM p WINDOW w AS (PARTITION BY job_id ORDER BY slot)""")
def expired_slots(spark, d):
    """The hours in which each user had events are the slots of a job."""
    used = table(spark, d, "events").select(F.concat(F.lit("user-"), "user_id").alias("job_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot")).distinct()
    return L.expired_slots(used, "job_id", F.expr("timestamp_ntz'2024-01-15 12:00:00'"))


@query(f"""WITH {_SLOTS}, {_LOG} SELECT job_id, slot, status FROM (FROM l QUALIFY row_number() OVER (PARTITION BY job_id, slot ORDER BY ts DESC, event_id DESC) = 1)
  UNION ALL SELECT job_id, slot, 'PENDING' FROM p WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.job_id = p.job_id AND l.slot = p.slot)""")
def current_state(spark, d):
    return L.current_state(_log(spark, d), _planned(spark), ["job_id", "slot"], [F.col("ts"), F.col("event_id")])


@query("SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type IN ('purchase', 'error') DESC, ts DESC, event_id DESC) = 1")
def state_fold(spark, d):
    return L.state_fold(_events(spark, d), ["user_id"], "ts", "event_type", ["purchase", "error"], "event_id")


@query("SELECT 'clicks' AS section, count(*) FILTER (event_type = 'click') AS rows FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' UNION ALL SELECT 'large', count(*) FILTER (value > 50) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'")
def daily_digest(spark, d):
    return L.daily_digest(_events(spark, d), F.lit("2024-01-05").cast("date"), "ts", {"clicks": F.col("event_type") == "click", "large": F.col("value") > 50})


_RECURRENCES = [*_JOBS, ("leap", "30 6 29 2 *")]
_TICKS = "(SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2028-03-01', INTERVAL 1 MINUTE)) AS tick)"
_NEXT = f"""p AS (SELECT 0 AS job, tick AS slot FROM {_TICKS} WHERE minute(tick) % 15 = 0 AND hour(tick) BETWEEN 8 AND 17 AND isodow(tick) <= 5 UNION ALL SELECT 1, tick FROM {_TICKS} WHERE minute(tick) = 0 AND hour(tick) = 0 AND (day(tick) = 1 OR isodow(tick) = 1)
  UNION ALL SELECT 2, tick FROM {_TICKS} WHERE minute(tick) IN (5, 35) UNION ALL SELECT 3, tick FROM {_TICKS} WHERE minute(tick) = 30 AND hour(tick) = 6 AND day(tick) = 29 AND month(tick) = 2),
  e AS (SELECT event_id, ts, event_id % 4 AS job FROM events)"""


def _recurring(spark, d):
    text = F.element_at(F.array(*(F.lit(r) for _, r in _RECURRENCES)), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", "ts", text.alias("recurrence"))


@query(f"WITH {_NEXT} SELECT event_id, slot AS next FROM e ASOF JOIN p ON e.job = p.job AND e.ts < p.slot")
def cron_next(spark, d):
    """The next occurrence after every event, each with a recurrence of its own."""
    return R.with_next(_recurring(spark, d), "recurrence", F.col("ts"), "next").select("event_id", "next")


@query(f"WITH {_NEXT} SELECT event_id, slot AS next_slot, slot <= TIMESTAMP '2024-01-15 12:00:00' AS expired FROM e ASOF JOIN p ON e.job = p.job AND e.ts < p.slot")
def expired_recurrences(spark, d):
    return R.expired_recurrences(_recurring(spark, d), "recurrence", "ts", F.expr("timestamp_ntz'2024-01-15 12:00:00'")).select("event_id", "next_slot", "expired")


@query(f"WITH {_NEXT} SELECT event_id, count(*) AS slots, min(slot) AS first_slot, max(slot) AS last_slot FROM e JOIN p ON e.job = p.job AND p.slot BETWEEN e.ts AND e.ts + INTERVAL 2 DAY GROUP BY event_id")
def planned_slots(spark, d):
    """The occurrences in the two days after every event."""
    found = R.occurrences(_recurring(spark, d), "recurrence", F.col("ts"), F.col("ts") + F.expr("interval 2 days"))
    return found.groupBy("event_id").agg(F.count("*").alias("slots"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))

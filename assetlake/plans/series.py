"""Queries over counters, transfers and metric series."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import counters, text
from assetlake.operators import series as s
from assetlake.operators.scan import Running, running
from assetlake.plans.fixtures import READINGS_SQL, RUN_EVENTS_SQL, limits, run_events
from assetlake.plans.registry import query
from assetlake.session import cut_lineage

COUNTER_RATE_SQL = (
    "WITH"
    + READINGS_SQL
    + """, prior AS (
  SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM readings),
kept AS (
  SELECT *, lag(counter) OVER w AS last_counter, lag(t) OVER w AS last_t
  FROM prior WHERE seen IS NULL OR t > seen WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, t, round_even(((counter - last_counter) / (t - last_t)) / 1000000000.0, 4) AS used,
       cpu_limit AS allocated
FROM kept WHERE last_t IS NOT NULL AND counter <> 0 AND cpu_limit <> 0
"""
)


def readings(load):
    """A running CPU counter per user, read at whole hours, stored as a table of readings."""
    events = run_events(load).select(
        "event_id", "user_id", (F.col("hour") * 3600).alias("t"), "cents", limits().alias("cpu_limit")
    )
    total = Running("counter", "sum", F.col("cents") * 9_999_991)
    return cut_lineage(running(events, ["user_id"], ["event_id"], [total]), "readings")


@query("counter_rate", COUNTER_RATE_SQL)
def counter_rate(load):
    return s.counter_rate(readings(load), ["user_id"], "event_id", "t", "counter", "cpu_limit")


TRAILING_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, buckets AS (SELECT user_id, hour, sum(cents)::BIGINT AS units FROM run_events GROUP BY 1, 2),
rates AS (
  SELECT *, coalesce(round_even(sum(units) OVER w / count(*) OVER w, 0), 0)::BIGINT AS rate
  FROM buckets WINDOW w AS (PARTITION BY user_id ORDER BY hour RANGE BETWEEN 20 PRECEDING AND 1 PRECEDING))
"""
)


def trailing(load):
    buckets = s.per_bucket(run_events(load), ["user_id"], "hour", "cents")
    return s.trailing_rate(buckets, ["user_id"], "hour")


@query("trailing_rate", TRAILING_SQL + "SELECT * FROM rates")
def trailing_rate(load):
    return trailing(load)


@query(
    "transfer_eta",
    TRAILING_SQL
    + """SELECT user_id, hour, units, rate, done, total,
                CASE WHEN rate = 0 THEN 0 ELSE round_even((total - done) / rate, 0)::BIGINT END AS eta
         FROM (SELECT *, sum(units) OVER (PARTITION BY user_id ORDER BY hour)::BIGINT AS done,
                      sum(units) OVER (PARTITION BY user_id)::BIGINT AS total FROM rates)""",
)
def transfer_eta(load):
    totals = run_events(load).groupBy("user_id").agg(F.sum("cents").alias("total"))
    rates = cut_lineage(trailing(load), "rates")
    return s.transfer_eta(rates, totals, ["user_id"], "hour")


_ELAPSED_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, timed AS (SELECT *, (us - min(us) OVER (PARTITION BY user_id)) / 3600000000.0 AS e FROM run_events)
"""
)


def _elapsed(load):
    return s.with_elapsed(run_events(load), ["user_id"], F.col("us"), unit=3600)


@query(
    "adaptive_downsample",
    _ELAPSED_SQL
    + """SELECT user_id, step, max(event_id) AS event_id, arg_max(cents, event_id) AS cents
         FROM (SELECT *, (CASE WHEN e < 15 THEN floor(e) WHEN e < 60 THEN 15 + floor((e - 15) / 5) * 5
                               ELSE 60 + floor((e - 60) / 15) * 15 END)::BIGINT AS step FROM timed)
         GROUP BY 1, 2""",
)
def adaptive_downsample(load):
    return s.adaptive_downsample(_elapsed(load), ["user_id"], "event_id", ["cents"])


@query(
    "metric_series_long",
    _ELAPSED_SQL
    + """SELECT user_id, event_id, round_even(e, 0)::BIGINT AS x, 'TIME' AS x_type, 'System' AS category,
                'cpu' AS group_tag, 'cpu_used' AS tag, cents / 100 AS value FROM timed
         UNION ALL
         SELECT user_id, event_id, round_even(e, 0)::BIGINT, 'TIME', 'System', 'memory', 'mem_used_gb',
                CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM timed""",
)
def metric_series_long(load):
    metrics = {
        "cpu_used": ("cpu", F.col("cents") / 100),
        "mem_used_gb": ("memory", F.get_json_object("props", "$.k").try_cast("double")),
    }
    return s.metric_series_long(_elapsed(load), ["user_id", "event_id"], metrics)


@query(
    "parse_counters",
    "WITH"
    + RUN_EVENTS_SQL
    + """SELECT event_id,
                CASE WHEN event_type = 'signup' THEN 0 ELSE cents * 1000 END AS usage_ns,
                CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN cents / 100000 WHEN 'error' THEN 0
                     WHEN 'purchase' THEN 0 ELSE cents / 2000 END AS cpus,
                CASE event_type WHEN 'view' THEN 34359738368 WHEN 'error' THEN 0 ELSE cents * 1048576 END AS memory
         FROM run_events""",
)
def parse_counters(load):
    kind, cents = F.col("event_type"), F.col("cents").cast("string")
    stat = F.when(kind == "signup", F.concat(F.lit("usage_usec "), cents, F.lit("\n"))).otherwise(
        F.concat(F.lit("usage_usec 7\nuser_usec "), cents, F.lit("\nsystem_usec 1\n"))
    )
    cpu_max = (
        F.when(kind == "view", "max 100000")
        .when(kind == "click", F.concat(cents, F.lit(" 100000\n")))
        .when(kind == "purchase", cents)
        .when(kind == "signup", F.concat(cents, F.lit(" 2000")))
    )
    high = F.when(kind == "view", "max\n").when(kind != "error", F.concat((F.col("cents") * 1048576).cast("string"), F.lit("\n")))
    raw = run_events(load).select("event_id", stat.alias("stat"), cpu_max.alias("cpu_max"), high.alias("high"))
    return raw.select(
        "event_id",
        counters.user_time_ns(F.col("stat")).alias("usage_ns"),
        counters.quota(F.col("cpu_max")).alias("cpus"),
        counters.memory_limit(F.col("high"), F.lit(32 * 1024**3)).alias("memory"),
    )


@query(
    "scale_units",
    "WITH"
    + RUN_EVENTS_SQL
    + """SELECT event_id, round_even(cents * 1048576 / 1073741824, 2) AS mem_used_gb,
                round_even(8 * (cents % 100) / 100, 2) AS cpu_used
         FROM run_events WHERE cents <> 0 AND event_type <> 'error'""",
)
def scale_units(load):
    used = F.col("cents") * 1048576
    rows = run_events(load).withColumn("cpu_limit", limits()).filter((used != 0) & (F.col("cpu_limit") != 0))
    return rows.select(
        "event_id",
        counters.gibibytes(used).alias("mem_used_gb"),
        counters.cpus_used(F.lit(8), F.col("cents") % 100).alias("cpu_used"),
    )


LOG_LINES_SQL = """SELECT event_id, strftime(ts, '%H:%M:%S') || ' user-' || user_id || ': ' || event_type AS line FROM events"""


def log_lines(events):
    asset = F.concat(F.lit("user-"), F.col("user_id"))
    return events.select("event_id", text.log_line(F.col("ts"), asset, F.col("event_type")).alias("line"))


@query("render_log_lines", LOG_LINES_SQL)
def render_log_lines(load):
    return log_lines(load("events"))

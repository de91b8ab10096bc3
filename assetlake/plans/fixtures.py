"""Run, metric and catalog tables derived from the standard tables, row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

# The same derivations as SQL text, for the SQL twins.
RUN_EVENTS_SQL = """
run_events AS (
  SELECT event_id, ts, user_id, event_type, props, round(value * 100)::BIGINT AS cents,
         epoch_us(ts) AS us, epoch_us(ts) // 3600000000 AS hour,
         user_id || '-' || strftime(ts, '%Y%m%d') AS run
  FROM events)
"""

READINGS_SQL = (
    RUN_EVENTS_SQL
    + """, readings AS (
  SELECT event_id, user_id, hour * 3600 AS t,
         sum(cents) OVER (PARTITION BY user_id ORDER BY event_id) * 9999991 AS counter,
         CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 1.5 ELSE 2 END AS cpu_limit
  FROM run_events)
"""
)


def run_events(load):
    """Events with exact cents, µs, hour number and a run name of user and day."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return load("events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "props",
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        us.alias("us"),
        F.floor(us / 3_600_000_000).alias("hour"),
        F.concat(F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("run"),
    )


def limits():
    kind = F.col("event_type")
    return F.when(kind == "error", 0.0).when(kind == "view", 1.5).otherwise(2.0)

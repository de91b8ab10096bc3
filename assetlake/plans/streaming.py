"""Streaming queries: each reads its table as a stream, to the end, and returns what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import quality as q
from assetlake.plans.catalog import FOLD_SQL, run_history
from assetlake.plans.fixtures import RUN_EVENTS_SQL, limits, run_events
from assetlake.plans.metadata import TYPED_SQL, logged
from assetlake.plans.registry import query
from assetlake.plans.series import LOG_LINES_SQL, log_lines
from assetlake.streaming import feeds


def _stream(load):
    """Like ``load``, but the events arrive as a stream."""

    def stream(name):
        return feeds.table_stream(load.spark, load.path(name))

    return stream


@query("stream_tail", LOG_LINES_SQL)
def stream_tail(load):
    lines = log_lines(_stream(load)("events"))
    root = feeds.run_to_end(load.spark, "tail", lambda at: feeds.tail(lines, f"{at}/lines", f"{at}/checkpoint"))
    return load.spark.read.parquet(f"{root}/lines")


@query("stream_log_sink", TYPED_SQL + "SELECT *, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status FROM typed")
def stream_log_sink(load):
    calls = logged(_stream(load))
    root = feeds.run_to_end(
        load.spark, "log-sink", lambda at: feeds.log_sink(calls, ["event_id"], f"{at}/logged", f"{at}/checkpoint")
    )
    return load.spark.read.parquet(f"{root}/logged").drop("batch")


STREAM_RATE_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, readings AS (
  SELECT event_id, user_id, us // 10000000 AS t, (us - 1704067200000000) * 700 + cents * 9999991 AS counter,
         CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 1.5 ELSE 2 END AS cpu_limit
  FROM run_events),
prior AS (
  SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM readings),
kept AS (
  SELECT *, lag(counter) OVER w AS last_counter, lag(t) OVER w AS last_t
  FROM prior WHERE seen IS NULL OR t > seen WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
rates AS (
  SELECT k.user_id, event_id, t, round_even(((counter - last_counter) / (t - last_t)) / 1000000000.0, 4) AS used,
         cpu_limit AS allocated, t - start AS x
  FROM kept k JOIN (SELECT user_id, min(t) AS start FROM readings GROUP BY 1) s ON s.user_id = k.user_id
  WHERE last_t IS NOT NULL AND counter <> 0 AND cpu_limit <> 0),
stepped AS (
  SELECT *, CASE WHEN x < 15 THEN x WHEN x < 60 THEN 15 + (x - 15) // 5 * 5 ELSE 60 + (x - 60) // 15 * 15 END AS step
  FROM rates)
SELECT user_id, step, max(event_id) AS event_id, arg_max(t, event_id) AS t, arg_max(used, event_id) AS used,
       arg_max(allocated, event_id) AS allocated, arg_max(x, event_id) AS x
FROM stepped GROUP BY 1, 2
"""
)


def raw_readings(load):
    counter = (F.col("us") - 1_704_067_200_000_000) * 700 + F.col("cents") * 9_999_991
    return run_events(load).select(
        "event_id", "user_id", F.floor(F.col("us") / 10_000_000).alias("t"), counter.alias("counter"), limits().alias("cpu_limit")
    )


READING_COLUMNS = {"seq": "event_id", "time": "t", "counter": "counter", "limit": "cpu_limit"}


@query("stream_counter_rate", STREAM_RATE_SQL)
def stream_counter_rate(load):
    readings = raw_readings(_stream(load))
    root = feeds.run_to_end(
        load.spark,
        "counter-rate",
        lambda at: feeds.counter_rates(readings, ["user_id"], READING_COLUMNS, f"{at}/rates", f"{at}/checkpoint"),
    )
    return feeds.sampled_rates(load.spark, f"{root}/rates", ["user_id"], "event_id")


@query("stream_fold_status", FOLD_SQL)
def stream_fold_status(load):
    history = run_history(run_events(_stream(load)))
    root = feeds.run_to_end(
        load.spark, "fold-status", lambda at: feeds.fold_statuses(history, ["run"], "event_id", f"{at}/outcomes", f"{at}/checkpoint")
    )
    return feeds.current_outcomes(load.spark, f"{root}/outcomes", ["run"])


@query(
    "stream_rate",
    "WITH"
    + RUN_EVENTS_SQL
    + """, buckets AS (SELECT user_id, hour, sum(cents)::BIGINT AS units FROM run_events GROUP BY 1, 2),
spread AS (SELECT user_id, hour + unnest(range(1, 21)) AS slot, units FROM buckets)
SELECT user_id, slot AS hour, round_even(sum(units) / count(*), 0)::BIGINT AS rate FROM spread GROUP BY ALL""",
)
def stream_rate(load):
    events = run_events(_stream(load)).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "cents")
    rates = feeds.live_rate(events, ["user_id"], "ts", "cents", "1 hour", bucket="1 hour")
    root = feeds.run_to_end(load.spark, "rate", lambda at: feeds.updated_rows(rates, f"{at}/rates", f"{at}/checkpoint"))
    hour = F.floor(F.unix_micros("at") / 3_600_000_000)
    return feeds.last_written(load.spark, f"{root}/rates", ["user_id", "at"]).select("user_id", hour.alias("hour"), "rate")


_EVENT_TYPES = ["signup", "purchase", "view", "click"]


@query(
    "stream_suite",
    """WITH bad AS (SELECT count(*) FILTER (WHERE event_type NOT IN ('signup', 'purchase', 'view', 'click')) AS n FROM events)
       SELECT 'strict' AS suite, 'assert_valid_values' AS rule, n = 0 AS passed, n AS violations,
              CASE WHEN n = 0 THEN (SELECT count(*) FROM events) ELSE 0 END AS saved FROM bad
       UNION ALL
       SELECT 'loose', 'assert_not_null', count(*) FILTER (WHERE ts IS NULL) = 0, count(*) FILTER (WHERE ts IS NULL),
              count(*) FROM events""",
)
def stream_suite(load):
    suites = {"strict": [q.ValidValues("event_type", _EVENT_TYPES)], "loose": [q.NotNull(["ts"])]}
    events, results = _stream(load)("events"), []
    for name, rules in suites.items():
        root = feeds.run_to_end(
            load.spark,
            f"suite-{name}",
            lambda at, rules=rules: feeds.checked_sink(
                events, rules, f"{at}/good", f"{at}/held", f"{at}/reports", f"{at}/checkpoint"
            ),
        )
        report = load.spark.read.parquet(f"{root}/reports")
        # A folder that no batch was published to does not exist; the pattern then has no files to read.
        kept = load.spark.read.schema("event_id long").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.parquet")
        both = kept.parquet(root).select(F.col("_metadata.file_path").alias("path"))
        saved = both.agg(F.count(F.when(F.col("path").contains("/good/batch="), 1)).alias("saved"))
        totals = report.groupBy("rule").agg(F.min("passed").alias("passed"), F.sum("violations").alias("violations"))
        results.append(totals.withColumn("saved", saved.scalar()).withColumn("suite", F.lit(name)))
    return results[0].unionByName(results[1])

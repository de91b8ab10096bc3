"""Queries over logged values, labels and parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import text
from assetlake.operators import metadata as m
from assetlake.plans.fixtures import RUN_EVENTS_SQL, run_events
from assetlake.plans.registry import query


def logged(load):
    """One log call per event, with values of every kind and some bad steps and values."""
    kind, cents = F.col("event_type"), F.col("cents")
    raw = (
        F.when(kind == "view", F.concat(F.lit('"page '), F.col("user_id"), F.lit('"')))
        .when(cents > 20000, F.lit("null"))
        .when(kind == "click", cents.cast("string"))
        .when(kind == "signup", F.when(cents > 5000, "true").otherwise("false"))
        .when(kind == "error", F.concat(F.lit('{"props": '), F.col("props"), F.lit(', "cents": '), cents, F.lit("}")))
        .otherwise(F.concat(F.lit("[1, "), F.col("user_id"), F.lit("]")))
    )
    x = F.when(cents % 10 == 0, -1).when(cents % 10 > 3, F.col("event_id"))
    source = F.lit("json")
    return run_events(load).select(
        "event_id", kind.alias("tag"), source.alias("kind"), raw.alias("raw"), x.alias("x"),
        F.lit("STEP").alias("x_type"), F.lit("demo").alias("category"), F.lit(None).cast("string").alias("group_tag"),
    )


TYPED_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, calls AS (
  SELECT *, CASE WHEN cents % 10 = 0 THEN -1 WHEN cents % 10 > 3 THEN event_id END AS x,
         cents % 10 = 0 AS bad, event_type <> 'view' AND cents > 20000 AS unknown FROM run_events),
plain AS (
  SELECT event_id, event_type AS tag,
         CASE event_type WHEN 'view' THEN 'TEXT' WHEN 'click' THEN 'NUMBER' WHEN 'signup' THEN 'BOOLEAN' ELSE 'TEXT' END AS type,
         CASE event_type WHEN 'view' THEN 'page ' || user_id WHEN 'click' THEN cents::VARCHAR
              WHEN 'signup' THEN CASE WHEN cents > 5000 THEN 'True' ELSE 'False' END
              ELSE '[1, ' || user_id || ']' END AS value,
         CASE WHEN event_type = 'click' THEN coalesce(x, -1) ELSE -1 END AS x, NULL AS group_tag, NULL AS error
  FROM calls WHERE NOT bad AND NOT unknown AND event_type <> 'error'),
failed AS (
  SELECT event_id, event_type AS tag, NULL AS type, NULL AS value, -1 AS x, NULL AS group_tag,
         CASE WHEN bad THEN 'step must be a non-negative integer' ELSE 'unsupported value type' END AS error
  FROM calls WHERE bad OR unknown),
items AS (
  SELECT event_id, 'k' AS tag, 'NUMBER' AS type, json_extract_string(props, '$.k') AS value, -1 AS x,
         'props' AS group_tag, NULL AS error FROM calls WHERE NOT bad AND NOT unknown AND event_type = 'error'
  UNION ALL
  SELECT event_id, 'cents', 'NUMBER', cents::VARCHAR, -1, 'error', NULL
  FROM calls WHERE NOT bad AND NOT unknown AND event_type = 'error'),
typed AS (
  SELECT *, CASE WHEN x >= 0 THEN 'STEP' END AS x_type, 'demo' AS category
  FROM (SELECT * FROM plain UNION ALL SELECT * FROM failed UNION ALL SELECT * FROM items))
"""
)


@query("typed_log_rows", TYPED_SQL + "SELECT * FROM typed")
def typed_log_rows(load):
    return m.type_log_rows(logged(load), ["event_id"])


@query(
    "decode_log_rows",
    TYPED_SQL
    + """SELECT event_id, tag, type, CASE WHEN type = 'NUMBER' THEN value::DOUBLE END AS number,
                CASE WHEN type = 'TEXT' THEN value END AS text, CASE WHEN type = 'BOOLEAN' THEN value = 'True' END AS flag,
                CASE WHEN type IS NULL THEN 'not a plain value' END AS decode_error FROM typed""",
)
def decode_log_rows(load):
    decoded = m.decode_log_rows(m.type_log_rows(logged(load), ["event_id"]))
    return decoded.select("event_id", "tag", "type", "number", "text", "flag", "decode_error")


@query(
    "expand_dict",
    """SELECT event_id, event_type AS group_tag, 'k' AS tag, json_extract_string(props, '$.k') AS value
       FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""",
)
def expand_dict(load):
    leaves = m.flatten_params(load("events"), ["event_id", "event_type"], "props")
    return leaves.select("event_id", F.col("event_type").alias("group_tag"), F.col("path").alias("tag"), "value")


_SERIES_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, points AS (SELECT user_id, event_type AS tag, hour % 24 AS x, arg_max(cents, event_id) AS value, max(event_id) AS seq
              FROM run_events GROUP BY ALL)
SELECT user_id, tag, x, value, arg_max(value, seq) OVER (PARTITION BY user_id, tag) AS latest FROM points
"""
)


@query("metric_series", _SERIES_SQL)
def metric_series(load):
    rows = run_events(load).select(
        "user_id", F.col("event_type").alias("tag"), (F.col("hour") % 24).alias("x"), F.col("cents").alias("value"), "event_id"
    )
    return m.metric_series(rows, ["user_id"], "event_id")


@query(
    "flatten_params",
    """SELECT event_id, 'user/id' AS path, user_id::VARCHAR AS value FROM events
       UNION ALL SELECT event_id, 'user/props/k', json_extract_string(props, '$.k') FROM events
                 WHERE json_extract_string(props, '$.k') IS NOT NULL
       UNION ALL SELECT event_id, 'user/none', 'None' FROM events
       UNION ALL SELECT event_id, 'type', event_type FROM events
       UNION ALL SELECT event_id, 'flag', 'True' FROM events
       UNION ALL SELECT event_id, 'tags', '[1.50,{"z":2}]' FROM events
       UNION ALL SELECT event_id, 'rates/one', (event_id % 7)::VARCHAR || '.0' FROM events
       UNION ALL SELECT event_id, 'rates/half', '2.50' FROM events
       UNION ALL SELECT event_id, 'rates/tiny', '-1e-' || event_id % 9 FROM events""",
)
def flatten_params(load):
    nested = F.concat(
        F.lit('{"user": {"id": '), F.col("user_id"), F.lit(', "props": '), F.col("props"), F.lit(', "none": null}, "type": "'),
        F.col("event_type"), F.lit('", "flag": true, "tags": [1.50, {"z": 2}], "rates": {"one": '), F.col("event_id") % 7,
        F.lit('.0, "half": 2.50, "tiny": -1e-'), F.col("event_id") % 9, F.lit('}, "empty": {}}'),
    )
    return m.flatten_params(load("events").select("event_id", nested.alias("params")), ["event_id"], "params")


@query(
    "prefix_keys",
    "SELECT event_id, 'train-' || event_type AS tag, event_type AS plain, value FROM events",
)
def prefix_keys(load):
    tag = F.col("event_type")
    return load("events").select(
        "event_id", text.with_prefix(tag, "train").alias("tag"), text.with_prefix(tag, "").alias("plain"), "value"
    )


@query(
    "entity_labels",
    """SELECT DISTINCT 'run' AS kind, user_id::VARCHAR AS entity, event_type AS label FROM events
       UNION SELECT DISTINCT 'build', o_custkey::VARCHAR, o_orderpriority FROM orders""",
)
def entity_labels(load):
    no_id = F.lit(None).cast("long")
    runs = load("events").select(F.col("user_id").alias("run"), no_id.alias("train"), no_id.alias("build"), F.col("event_type").alias("label"))
    builds = load("orders").select(no_id.alias("run"), no_id.alias("train"), F.col("o_custkey").alias("build"), F.col("o_orderpriority").alias("label"))
    return m.entity_labels(runs.unionByName(builds), "run", "train", "build", "label")


@query(
    "table_json_roundtrip",
    """SELECT user_id, event_type, hour, cents FROM (
         WITH"""
    + RUN_EVENTS_SQL
    + """SELECT user_id, event_type, hour, sum(cents)::BIGINT AS cents, count(*) OVER (PARTITION BY user_id) AS n
         FROM run_events GROUP BY 1, 2, 3) WHERE n <= 1000""",
)
def table_json_roundtrip(load):
    table = run_events(load).groupBy("user_id", "event_type", "hour").agg(F.sum("cents").alias("cents"))
    written = m.tables_to_json(table, ["user_id"], ["hour", "event_type"])
    return m.json_to_tables(written, ["user_id"], "hour:bigint,event_type:string,cents:bigint")

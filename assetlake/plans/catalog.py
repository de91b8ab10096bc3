"""Queries over builds, trains, runs and references."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import refs, status, text
from assetlake.operators import catalog as c
from assetlake.plans.fixtures import RUN_EVENTS_SQL, run_events
from assetlake.plans.registry import query


@query(
    "status_with_metadata",
    "WITH"
    + RUN_EVENTS_SQL
    + """, meta AS (
  SELECT run, CASE event_type WHEN 'view' THEN 'build-id' ELSE 'train-id' END AS key, arg_max(props, event_id) AS value
  FROM run_events WHERE event_type IN ('view', 'click') GROUP BY 1, 2),
task AS (
  SELECT event_id, run, event_type AS status, CASE event_type WHEN 'purchase' THEN 'build-id' ELSE 'train-id' END AS key
  FROM run_events WHERE event_type IN ('purchase', 'error'))
SELECT event_id, run, key, status, value FROM task LEFT JOIN meta USING (run, key)""",
)
def status_with_metadata(load):
    events = run_events(load)
    kind = F.col("event_type")
    metadata = events.filter(kind.isin("view", "click")).select(
        "run", F.when(kind == "view", "build-id").otherwise("train-id").alias("key"), F.col("props").alias("value"), "event_id"
    )
    tasks = events.filter(kind.isin("purchase", "error")).select(
        "event_id", "run", kind.alias("status"), F.when(kind == "purchase", "build-id").otherwise("train-id").alias("key")
    )
    return c.status_with_metadata(tasks, metadata, ["run", "key"], "event_id")


@query(
    "failure_reasons",
    "WITH"
    + RUN_EVENTS_SQL
    + """, infos AS (SELECT run, arg_max(event_type, event_id) AS kind, max(event_id) AS event_id FROM run_events
                     WHERE event_type IN ('view', 'click', 'signup') GROUP BY run)
SELECT e.event_id, e.run, 'FAILED' AS status, 'exit ' || e.user_id AS info,
       CASE i.kind WHEN 'view' THEN 'assertion' ELSE 'generic' END AS report_type,
       CASE i.kind WHEN 'view' THEN 'failed: rule(' || i.event_id || ')' WHEN 'click' THEN 'not JSON' ELSE 'exit ' || e.user_id END AS reason
FROM run_events e LEFT JOIN infos i USING (run) WHERE e.event_type = 'error'""",
)
def failure_reasons(load):
    events = run_events(load)
    kind = F.col("event_type")
    tasks = events.select(
        "event_id", "run", F.when(kind == "error", "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.concat(F.lit("exit "), F.col("user_id")).alias("info"),
    )
    assertion = text.status_report("Assertion", F.concat(F.lit("failed: rule("), F.col("event_id"), F.lit(")")))
    report = F.when(kind == "view", assertion).when(kind == "click", "not JSON")
    stored = events.filter(kind.isin("view", "click", "signup")).select("run", "event_id", report.alias("report"))
    return c.failure_reasons(tasks, c.last_by(stored, ["run"], ["event_id"], ["report"]), "run")


@query(
    "build_tags",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS "index",
              coalesce(o_orderpriority || '.' || l_linenumber, '') AS tag
       FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
)
def build_tags(load):
    builds = load("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("index"))
    versions = load("orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("version_name")
    )
    return c.build_tags(builds, versions, "l_orderkey")


@query(
    "train_tags",
    """SELECT l_orderkey, l_partkey, l_linenumber AS "index", p_brand || '.' || l_linenumber AS tag
       FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10""",
)
def train_tags(load):
    trains = load("lineitem").select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("index"))
    versions = load("part").filter("p_size > 10").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("version_name")
    )
    return c.train_tags(trains, versions, "l_partkey")


@query(
    "fabric_lookup",
    """WITH dim AS (SELECT * FROM (VALUES ('f-small', 2, 4, 0), ('f-medium', 3, 14, 0), ('f-gpu-small', 3, 48, 1),
                                         ('f-xsmall', 0.5, 4, 0)) t(fabric, cpu, mem, gpu)),
            wanted AS (SELECT c_custkey, coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 'f-medium' WHEN 'MACHINERY' THEN 'f-gpu-small'
                              WHEN 'HOUSEHOLD' THEN 'f-huge' WHEN 'FURNITURE' THEN 'f-small' END, 'f-xsmall') AS fabric FROM customer)
       SELECT c_custkey, fabric, cpu, mem::BIGINT * 1000 * 1024 * 1024 AS memory_bytes, gpu,
              CASE WHEN cpu IS NOT NULL THEN contains(fabric, 'gpu') END AS is_gpu,
              CASE WHEN cpu IS NULL THEN 'unknown fabric' ELSE 'ok' END AS status
       FROM wanted LEFT JOIN dim USING (fabric)""",
)
def fabric_lookup(load):
    segment = F.col("c_mktsegment")
    explicit = (
        F.when(segment == "BUILDING", "f-medium")
        .when(segment == "MACHINERY", "f-gpu-small")
        .when(segment == "HOUSEHOLD", "f-huge")
        .when(segment == "FURNITURE", "f-small")
    )
    wanted = load("customer").select("c_custkey", explicit.alias("fabric"))
    return status.fabric_lookup(wanted, "fabric", run_default="f-xsmall")


_BUILD_EVENTS_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, last AS (SELECT run, arg_max(event_type, event_id) AS kind, arg_max(props, event_id) AS props,
                          arg_max(event_id, event_id) AS event_id FROM run_events GROUP BY run)
"""
)


@query(
    "build_status",
    _BUILD_EVENTS_SQL
    + """SELECT run, CASE kind WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' WHEN 'view' THEN 'INVALID' ELSE 'STARTED' END AS status,
                CASE WHEN kind = 'purchase' THEN 'lake/' || event_id END AS location,
                CASE WHEN kind = 'error' THEN 'Dataset build failed with ' || props END AS info FROM last""",
)
def build_status(load):
    kind = F.col("event_type")
    code = F.when(kind == "error", 3).when(kind == "purchase", 2).when(kind == "view", 0).otherwise(1)
    events = run_events(load).select(
        "run", "event_id", code.alias("status"), F.concat(F.lit("lake/"), F.col("event_id")).alias("location"), F.col("props").alias("info")
    )
    return c.build_status(events, ["run"], "event_id")


@query(
    "train_status",
    _BUILD_EVENTS_SQL
    + """SELECT run, CASE kind WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESSFUL' WHEN 'view' THEN 'IN_PROGRESS'
                      WHEN 'click' THEN 'FETCHING_FEATURES' ELSE 'PENDING' END AS status,
                sha256(props) AS version,
                CASE WHEN kind = 'error' THEN '{"type":"Generic","message":"event ' || event_id || '"}' END AS report FROM last""",
)
def train_status(load):
    kind = F.col("event_type")
    code = F.when(kind == "error", 6).when(kind == "purchase", 5).when(kind == "view", 4).when(kind == "click", 3).otherwise(1)
    events = run_events(load).select(
        "run", "event_id", code.alias("status"), F.sha2(F.col("props").cast("binary"), 256).alias("version"),
        F.concat(F.lit("event "), F.col("event_id")).alias("message"),
    )
    return c.train_status(events, ["run"], "event_id")


@query(
    "run_outcome",
    "WITH"
    + RUN_EVENTS_SQL
    + """SELECT run, count(*) FILTER (WHERE event_type = 'error') AS errors,
                CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
         FROM run_events GROUP BY run""",
)
def run_outcome(load):
    return c.run_outcome(run_events(load), ["run"], F.col("event_type") == "error")


FOLD_SQL = (
    "WITH"
    + RUN_EVENTS_SQL
    + """, decided AS (
  SELECT run, arg_min(CASE WHEN event_type = 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END, event_id) AS outcome,
         arg_min(props, event_id) AS info
  FROM run_events WHERE event_type = 'purchase' OR (event_type = 'error' AND cents > 2000) GROUP BY run)
SELECT run, coalesce(outcome, 'RUNNING') AS outcome, CASE WHEN outcome = 'FAILED' THEN info END AS info,
       outcome IS NULL AS is_running, outcome IS NOT NULL AS is_finished
FROM (SELECT DISTINCT run FROM run_events) LEFT JOIN decided USING (run)
"""
)


def run_history(events):
    """History of runs: purchases end a run, expensive errors fail a task, the rest decides nothing."""
    kind = F.col("event_type")
    return events.select(
        "run",
        "event_id",
        F.when(kind.isin("purchase", "signup"), "run").otherwise("task").alias("source"),
        F.when(kind == "purchase", "SUCCEEDED")
        .when((kind == "error") & (F.col("cents") > 2000), "FAILED")
        .when(kind == "click", "SUCCEEDED")
        .when(kind == "signup", "INVALID")
        .otherwise("SCHEDULED")
        .alias("status"),
        F.col("props").alias("info"),
    )


@query("fold_status", FOLD_SQL)
def fold_status(load):
    return c.fold_status(run_history(run_events(load)), ["run"], "event_id")


@query(
    "registry_latest",
    """SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS description, max(o_orderkey) AS o_orderkey
       FROM orders GROUP BY 1""",
)
def registry_latest(load):
    entries = load("orders").select("o_custkey", F.col("o_orderpriority").alias("description"), "o_orderkey")
    return c.registry_latest(entries, ["o_custkey"], "o_orderkey")


def build_catalog(load):
    """Builds of one dataset per customer: version = order year, index = order number."""
    year = F.year("o_orderdate").cast("long")
    return load("orders").select(
        F.lit("acme").alias("account"),
        F.lit("shop").alias("project"),
        F.lit("datasets").alias("type"),
        F.concat(F.lit("ds"), F.col("o_custkey")).alias("name"),
        year.cast("string").alias("version"),
        year.alias("version_no"),
        F.col("o_orderkey").alias("index"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("COMPLETED").alias("status"),
        F.concat(F.lit("b"), F.col("o_orderkey")).alias("build_id"),
    )


_CATALOG_SQL = """
WITH builds AS (
  SELECT 'acme/shop/datasets/ds' || o_custkey AS name, year(o_orderdate) AS version_no, o_orderkey AS "index",
         'b' || o_orderkey AS build_id FROM orders WHERE o_orderstatus <> 'P')
"""


@query(
    "latest_build",
    _CATALOG_SQL
    + """SELECT name, arg_max(version_no, (version_no, "index")) AS version_no,
                arg_max("index", (version_no, "index")) AS "index" FROM builds GROUP BY name""",
)
def latest_build(load):
    builds = build_catalog(load).withColumn("name", F.concat_ws("/", "account", "project", "type", "name"))
    return c.latest_build(builds, ["name"])


def ref_column():
    """References of several forms, one per order priority; the last two are wrong."""
    customer, year = F.col("o_custkey"), F.year("o_orderdate").cast("string")
    urgent = F.concat(F.lit("ds"), customer)
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", urgent)
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("shop/datasets/ds"), customer, F.lit(":"), year))
        .when(
            F.col("o_orderpriority") == "3-MEDIUM",
            F.concat(F.lit("acme/shop/datasets/ds"), customer, F.lit(":"), year, F.lit("."), F.col("o_orderkey"), F.lit("#price")),
        )
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("acme/shop/models/m"), customer))
        .otherwise(F.concat(F.lit("no such/"), customer))
    )


_REFS_SQL = (
    _CATALOG_SQL
    + """, keyed AS (
  SELECT name AS path, version_no, "index", build_id FROM builds
  UNION ALL SELECT name || ':' || version_no, version_no, "index", build_id FROM builds
  UNION ALL SELECT name || ':' || version_no || '.' || "index", version_no, "index", build_id FROM builds),
target AS (SELECT path, arg_max(build_id, (version_no, "index")) AS build_id FROM keyed GROUP BY path),
refs AS (
  SELECT o_orderkey, o_custkey, year(o_orderdate)::VARCHAR AS y, o_orderpriority AS pr,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'ds' || o_custkey
              WHEN '2-HIGH' THEN 'shop/datasets/ds' || o_custkey || ':' || year(o_orderdate)
              WHEN '3-MEDIUM' THEN 'acme/shop/datasets/ds' || o_custkey || ':' || year(o_orderdate) || '.' || o_orderkey || '#price'
              WHEN '5-LOW' THEN 'acme/shop/models/m' || o_custkey ELSE 'no such/' || o_custkey END AS ref
  FROM orders),
parts AS (
  SELECT *, pr IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS good FROM refs),
parsed AS (
  SELECT o_orderkey, ref, good, pr,
         CASE WHEN good THEN 'acme' END AS account, CASE WHEN good THEN 'shop' END AS project,
         CASE WHEN good THEN 'datasets' END AS type, CASE WHEN good THEN 'ds' || o_custkey END AS name,
         CASE WHEN pr IN ('2-HIGH', '3-MEDIUM') THEN y END AS version,
         CASE WHEN pr = '3-MEDIUM' THEN o_orderkey END AS build, CASE WHEN pr = '3-MEDIUM' THEN 'price' END AS selector,
         CASE WHEN good THEN 'acme/shop/datasets/ds' || o_custkey || coalesce(CASE WHEN pr <> '1-URGENT' THEN ':' || y END, '')
              || coalesce(CASE WHEN pr = '3-MEDIUM' THEN '.' || o_orderkey END, '') END AS path
  FROM parts)
"""
)


@query(
    "resolve_refs",
    _REFS_SQL
    + """SELECT o_orderkey, ref, CASE WHEN pr = '5-LOW' THEN 'type mismatch' WHEN NOT good THEN 'pattern mismatch'
                WHEN build_id IS NULL THEN 'not found' ELSE 'ok' END AS status,
                account, project, type, name, version, build, selector, path, build_id
         FROM parsed LEFT JOIN target USING (path)""",
)
def resolve_refs(load):
    rows = load("orders").select("o_orderkey", ref_column().alias("ref"))
    return c.resolve_refs(rows, "ref", build_catalog(load), "acme", "shop", "datasets")


@query(
    "render_refs",
    _REFS_SQL
    + """SELECT o_orderkey, path || coalesce('#' || selector, '') AS path,
                'https://lake.example/acme/shop/datasets/' || name || coalesce('?v=' || version, '')
                || coalesce('.' || build, '') || coalesce('#' || selector, '') AS url,
                'acme/shop/datasets/' || name || ':gold' || coalesce('#' || selector, '') AS tagged
         FROM parsed""",
)
def render_refs(load):
    rows = refs.parse_refs(load("orders").select("o_orderkey", ref_column().alias("ref")), "ref", "r", "datasets", "acme", "shop")
    ref = F.col("r")
    return rows.select(
        "o_orderkey",
        refs.render_path(ref).alias("path"),
        refs.render_url(ref, "https://lake.example").alias("url"),
        refs.render_path(ref, tag=F.lit("gold")).alias("tagged"),
    )


@query(
    "valid_names",
    """SELECT c_custkey, name, regexp_matches(name, '^(([a-zA-Z0-9_-]+)/)?([a-zA-Z0-9_-]+)$') AS valid
       FROM (SELECT c_custkey, c_name AS name FROM customer
             UNION ALL SELECT c_custkey, c_mktsegment || '/' || replace(c_name, '#', '_') FROM customer)""",
)
def valid_names(load):
    plain = load("customer").select("c_custkey", F.col("c_name").alias("name"))
    fixed = load("customer").select(
        "c_custkey", F.concat("c_mktsegment", F.lit("/"), F.replace("c_name", F.lit("#"), F.lit("_"))).alias("name")
    )
    return plain.unionByName(fixed).withColumn("valid", text.is_valid_name(F.col("name")))

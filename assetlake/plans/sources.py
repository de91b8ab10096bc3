"""Queries over builds, manifests, files, chunks and records."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from assetlake.operators.quality import NotNull
from assetlake.plans.registry import query
from assetlake.session import shared_dir
from assetlake.sources import builds, files, records


@query(
    "scan_concat",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
       UNION ALL BY NAME SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def scan_concat(load):
    orders = load("orders")
    first = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    second = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority")
    return builds.concat([first, second])


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "partition_manifest",
    " UNION ALL ".join(f"SELECT '{n}' AS name, 'parquet' AS format, count(*) AS n_rows FROM {n}" for n in _TABLES),
)
def partition_manifest(load):
    """Rows of every table by its manifest, all checksums computed."""
    parts = [files.partition_manifest(load.spark, [load.path(n)]).withColumn("name", F.lit(n)) for n in _TABLES]
    whole = builds.concat(parts).filter(F.length("checksum") == 32)
    return whole.groupBy("name", "format").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "cache_plan",
    """WITH manifest AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN '' ELSE md5(text) END AS checksum FROM documents),
            cache AS (SELECT DISTINCT md5(text) AS checksum FROM documents WHERE lang = 'de'),
            first AS (SELECT checksum, min(doc_id) AS doc_id FROM manifest GROUP BY 1)
       SELECT m.doc_id, m.checksum, CASE WHEN m.checksum = '' THEN 'remote' WHEN c.checksum IS NOT NULL THEN 'cache'
              WHEN m.doc_id = f.doc_id THEN 'fetch' ELSE 'cache' END AS action
       FROM manifest m LEFT JOIN cache c USING (checksum) JOIN first f USING (checksum)""",
)
def cache_plan(load):
    docs = load("documents")
    content = F.md5(F.col("text").cast("binary"))
    manifest = docs.select(
        "doc_id", F.lit("parquet").alias("format"), F.when(F.col("lang") == "fr", "").otherwise(content).alias("checksum")
    )
    cache = docs.filter("lang = 'de'").select(content.alias("checksum"))
    return files.cache_plan(manifest, cache, "doc_id").drop("format")


@query("build_roundtrip", "SELECT * FROM orders")
def build_roundtrip(load):
    store = builds.BuildStore(load.spark, shared_dir(load.spark, "builds"))

    @builds.dataset("orders", description="all orders")
    def orders(spark):
        return load("orders")

    store.build(orders)
    return store.read("orders")


@query(
    "records_to_table",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              CASE WHEN event_type = 'view' THEN user_id END AS page FROM events""",
)
def records_to_table(load):
    page = F.concat(F.lit(', "page": '), F.col("user_id"), F.lit("}"))
    viewed = F.when(F.col("event_type") == "view", F.concat(F.rtrim(F.col("props"), F.lit("}")), page))
    rows = load("events").select("event_id", F.coalesce(viewed, F.col("props")).alias("record"))
    return records.json_records(rows, "record", ["event_id"])


_PATHS = [".mp4", ".PNG", ".tar.gz", "", ".jpeg", ".webm"]


@query(
    "file_admission",
    """WITH f AS (SELECT page_id, 'files/v1.0/' || page_id || ['.mp4','.PNG','.tar.gz','','.jpeg','.webm'][(page_id % 6) + 1] AS path,
                         octet_length(encode(html)) * 250 AS size FROM pages),
            t AS (SELECT *, CASE page_id % 6 WHEN 0 THEN 'VIDEO' WHEN 5 THEN 'VIDEO' WHEN 1 THEN 'IMAGE' WHEN 4 THEN 'IMAGE' ELSE 'FILE' END AS type FROM f)
       SELECT page_id, path, size, type, CASE type WHEN 'IMAGE' THEN 1000000 ELSE 100000000 END AS size_limit,
              size <= CASE type WHEN 'IMAGE' THEN 1000000 ELSE 100000000 END AS admitted FROM t""",
)
def file_admission(load):
    ending = F.get(F.array(*[F.lit(p) for p in _PATHS]), (F.col("page_id") % 6).cast("int"))
    path = F.concat(F.lit("files/v1.0/"), F.col("page_id"), ending)
    listed = load("pages").select("page_id", path.alias("path"), (F.octet_length("html") * 250).alias("size"))
    return listed.select("*", files.admit(F.col("path"), F.col("size")).alias("_a")).select("page_id", "path", "size", "_a.*")


@query(
    "build_set",
    """WITH sizes AS (
         SELECT count(*) AS n, count(DISTINCT o_orderstatus) AS states, count(DISTINCT o_custkey) AS customers,
                count(DISTINCT (o_orderstatus, o_custkey)) AS pairs FROM orders)
       SELECT 'base' AS name, 0 AS level, 'COMPLETED' AS status, '' AS info, '' AS uses, n AS n_rows FROM sizes
       UNION ALL SELECT 'by_status', 1, 'COMPLETED', '', 'base', states FROM sizes
       UNION ALL SELECT 'by_customer', 1, 'COMPLETED', '', 'base', customers FROM sizes
       UNION ALL SELECT 'joined', 2, 'COMPLETED', '', 'base,by_customer,by_status', pairs FROM sizes
       UNION ALL SELECT 'raising', 1, 'FAILED', 'no place for ' || n || ' rows', 'base', 0 FROM sizes
       UNION ALL SELECT 'waiting', 3, 'NOT BUILT', 'not built: raising', '', 0""",
)
def build_set(load):
    """A diamond of datasets made of ``orders``, with a raising member and one that depends on it."""
    store = builds.BuildStore(load.spark, shared_dir(load.spark, "set"))
    base = builds.dataset("base")(lambda spark: load("orders"))

    @builds.dataset("by_status", [base])
    def by_status(spark, orders):
        return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("status_rows"))

    @builds.dataset("by_customer", ["base"], rules=[NotNull(["o_custkey"])])
    def by_customer(spark, orders):
        return orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("customer_rows"))

    @builds.dataset("joined", [base, by_status, by_customer])
    def joined(spark, orders, states, customers):
        pairs = orders.select("o_orderstatus", "o_custkey").distinct()
        return pairs.join(states, "o_orderstatus").join(customers, "o_custkey")

    @builds.dataset("raising", [base])
    def raising(spark, orders):
        raise ValueError(f"no place for {orders.count()} rows")

    waiting = builds.dataset("waiting", [raising, joined])(lambda spark, *tables: tables[1])
    outcomes = store.build_all([waiting, joined, by_customer, raising, by_status, base])
    sizes = [store.read(f.name).agg(F.lit(f.name).alias("name"), F.count(F.lit(1)).alias("n_rows")) for f in (base, by_status, by_customer, joined)]
    told = outcomes.join(builds.concat(sizes), "name", "left")
    uses = F.concat_ws(",", F.array_sort(F.map_keys("uses")))
    return told.select(
        "name", "level", "status", F.coalesce("info", F.lit("")).alias("info"), uses.alias("uses"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query(
    "build_outcomes",
    """SELECT 'good' AS name, 'COMPLETED' AS status, CAST(NULL AS VARCHAR) AS info, count(*) AS n_rows FROM orders
       UNION ALL SELECT 'raising', 'FAILED', 'Dataset build failed with no table ' || count(*) || ' rows', 0 FROM orders
       UNION ALL SELECT 'listed', 'COMPLETED', NULL, count(DISTINCT o_orderstatus) FROM orders""",
)
def build_outcomes(load):
    """States and rows of a good, a raising and a list dataset built from ``orders``."""
    store = builds.BuildStore(load.spark, shared_dir(load.spark, "builds"))

    @builds.dataset("good", rules=[NotNull(["o_orderkey"])])
    def good(spark):
        return load("orders")

    @builds.dataset("raising")
    def raising(spark):
        raise ValueError(f"no table {load('orders').count()} rows")

    @builds.dataset("listed")
    def listed(spark):
        states = load("orders").groupBy("o_orderstatus").count().collect()  # a handful of states
        return [{"state": r["o_orderstatus"], "n": r["count"]} for r in states]

    for function in (good, raising, listed):
        with contextlib.suppress(ValueError):
            store.build(function)
    sizes = [
        store.read(f.name).agg(F.lit(f.name).alias("name"), F.count(F.lit(1)).alias("n_rows")) for f in (good, listed)
    ]
    states = store.builds().select("name", "status", "info").join(builds.concat(sizes), "name", "left")
    return states.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))

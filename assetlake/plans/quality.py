"""Queries for rules, suites and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import profile, quality as q
from assetlake.plans.registry import query

LINE_RULES = [
    q.Skewness("l_extendedprice", -1, 1),
    q.ValidValues("l_returnflag", ["A", "N", "R"]),
    q.NotNull(["l_shipdate", "l_quantity"]),
    q.Unique(["l_orderkey", "l_linenumber"]),
]
ORDER_RULES = [
    q.IsTrue("min(o_totalprice) > 0", label="positive_price"),
    q.ValidValues("o_orderstatus", ["F", "O"]),
    q.NotNull(["o_orderkey", "o_custkey"]),
    q.Unique(["o_orderkey"]),
]

_SUITE_SQL = """
WITH line AS (
  SELECT count(*) FILTER (WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A','N','R')) AS bad,
         count(*) FILTER (WHERE l_shipdate IS NULL) AS no_date,
         count(*) FILTER (WHERE l_quantity IS NULL) AS no_quantity,
         CASE WHEN count(l_extendedprice) < 3 THEN NULL
              WHEN var_pop(l_extendedprice) = 0 THEN 0 ELSE skewness(l_extendedprice) END AS skew
  FROM lineitem),
line_dup AS (
  SELECT count(*) AS keys, coalesce(sum(n - 1), 0)::BIGINT AS extra
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
ord AS (
  SELECT min(o_totalprice) > 0 AS positive,
         count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F','O')) AS bad,
         count(*) FILTER (WHERE o_orderkey IS NULL) AS no_key,
         count(*) FILTER (WHERE o_custkey IS NULL) AS no_customer
  FROM orders),
ord_dup AS (
  SELECT count(*) AS keys, coalesce(sum(n - 1), 0)::BIGINT AS extra
  FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)),
report AS (
  SELECT 'lineitem' AS dataset, 3 AS position, 'assert_skewness' AS rule, 'l_extendedprice, -1, 1' AS args,
         coalesce(skew > -1 AND skew < 1, false) AS passed,
         CASE WHEN skew > -1 AND skew < 1 THEN 0 ELSE 1 END::BIGINT AS violations,
         printf('%.4f', skew) AS detail FROM line
  UNION ALL
  SELECT 'lineitem', 2, 'assert_valid_values', 'l_returnflag, [''A'', ''N'', ''R'']', bad = 0, bad,
         CASE WHEN bad > 0 THEN bad || ' rows outside the list' END FROM line
  UNION ALL
  SELECT 'lineitem', 1, 'assert_not_null', '[''l_shipdate'', ''l_quantity'']', no_date + no_quantity = 0,
         no_date + no_quantity,
         CASE WHEN no_date + no_quantity > 0 THEN concat_ws(', ', CASE WHEN no_date > 0 THEN 'l_shipdate' END,
              CASE WHEN no_quantity > 0 THEN 'l_quantity' END) END FROM line
  UNION ALL
  SELECT 'lineitem', 0, 'assert_unique', '[''l_orderkey'', ''l_linenumber'']', extra = 0, extra,
         CASE WHEN extra > 0 THEN keys || ' duplicated keys' END FROM line_dup
  UNION ALL
  SELECT 'orders', 3, 'assert_true', 'positive_price', coalesce(positive, false),
         CASE WHEN positive THEN 0 ELSE 1 END::BIGINT, NULL FROM ord
  UNION ALL
  SELECT 'orders', 2, 'assert_valid_values', 'o_orderstatus, [''F'', ''O'']', bad = 0, bad,
         CASE WHEN bad > 0 THEN bad || ' rows outside the list' END FROM ord
  UNION ALL
  SELECT 'orders', 1, 'assert_not_null', '[''o_orderkey'', ''o_custkey'']', no_key + no_customer = 0,
         no_key + no_customer,
         CASE WHEN no_key + no_customer > 0 THEN concat_ws(', ', CASE WHEN no_key > 0 THEN 'o_orderkey' END,
              CASE WHEN no_customer > 0 THEN 'o_custkey' END) END FROM ord
  UNION ALL
  SELECT 'orders', 0, 'assert_unique', '[''o_orderkey'']', extra = 0, extra,
         CASE WHEN extra > 0 THEN keys || ' duplicated keys' END FROM ord_dup)
"""


def suite(load):
    lines = q.run_suite(load("lineitem"), LINE_RULES).withColumn("dataset", F.lit("lineitem"))
    orders = q.run_suite(load("orders"), ORDER_RULES).withColumn("dataset", F.lit("orders"))
    return lines.unionByName(orders)


@query("suite_report", _SUITE_SQL + "SELECT * FROM report")
def suite_report(load):
    return suite(load)


@query(
    "failure_report",
    _SUITE_SQL
    + """SELECT dataset, 'failed: ' || string_agg(rule || '(' || args || ')', ', ' ORDER BY position)
                FILTER (WHERE NOT passed) AS message FROM report GROUP BY dataset""",
)
def failure_report(load):
    return q.failure_message(suite(load), "dataset")


@query(
    "valid_values_report",
    """SELECT l_returnflag AS value, count(*) AS n_rows FROM lineitem
       WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A','N') GROUP BY 1""",
)
def valid_values_report(load):
    return q.invalid_values(load("lineitem"), "l_returnflag", ["A", "N"])


@query(
    "invalid_values",
    """SELECT o_orderpriority AS value FROM orders
       EXCEPT SELECT unnest(['1-URGENT','2-HIGH','3-MEDIUM'])""",
)
def invalid_values(load):
    valid = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    return q.invalid_values(load("orders"), "o_orderpriority", valid).select("value")


@query(
    "not_null_report",
    """WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
       SELECT 'text' AS "column", count(*) FILTER (WHERE text IS NULL) AS nulls,
              count(*) FILTER (WHERE text IS NULL) > 0 AS has_null FROM j
       UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL), count(*) FILTER (WHERE quality IS NULL) > 0 FROM j
       UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FILTER (WHERE toxic IS NULL) > 0 FROM j""",
)
def not_null_report(load):
    joined = load("documents").join(load("labels"), "doc_id", "left")
    return q.null_report(joined, ["text", "quality", "toxic"])


@query(
    "unique_report",
    """SELECT 'l_orderkey, l_linenumber' AS subset, count(*) AS duplicate_keys,
              coalesce(sum(n - 1), 0)::BIGINT AS repeated_rows
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL
       SELECT 'o_orderkey', count(*), coalesce(sum(n - 1), 0)::BIGINT
       FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
)
def unique_report(load):
    lines, orders = ["l_orderkey", "l_linenumber"], ["o_orderkey"]
    a = q.unique_report(load("lineitem"), lines).withColumn("subset", F.lit(", ".join(lines)))
    b = q.unique_report(load("orders"), orders).withColumn("subset", F.lit(", ".join(orders)))
    return a.unionByName(b)


_SKEWED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "skewness_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(CASE WHEN count({c}) < 3 THEN NULL
            WHEN var_pop({c}) = 0 THEN 0 ELSE skewness({c}) END, 4) AS skewness FROM lineitem"""
        for c in _SKEWED
    ),
)
def skewness_report(load):
    report = q.skewness_report(load("lineitem"), _SKEWED)
    return report.withColumn("skewness", F.round("skewness", 4))


@query(
    "predicate_report",
    """SELECT args, CASE args WHEN 'positive_price' THEN (SELECT min(o_totalprice) > 0 FROM orders)
              WHEN 'has_rows' THEN (SELECT count(*) > 0 FROM orders)
              ELSE (SELECT max(o_totalprice) < 1000 FROM orders) END AS passed
       FROM (SELECT unnest(['positive_price', 'has_rows', 'cheap']) AS args)""",
)
def predicate_report(load):
    def has_rows(df):
        return not df.isEmpty()

    rules = [
        q.IsTrue("min(o_totalprice) > 0", label="positive_price"),
        q.IsTrue(has_rows),
        q.IsTrue("max(o_totalprice) < 1000", label="cheap"),
    ]
    return q.run_suite(load("orders"), rules).select("args", "passed")


@query(
    "suite_errors",
    """SELECT * FROM (VALUES (0, 'assert_true', false, 1), (1, 'assert_valid_values', false, (SELECT count(*) FROM orders)::INTEGER),
                              (2, 'assert_not_null', true, 0), (3, 'assert_true', true, 0)) t(position, rule, passed, violations)""",
)
def suite_errors(load):
    """A rule that fails at run time and a date column with a text in its list; the other rules keep their results."""
    rules = [
        q.IsTrue("min(o_totalprice) > 0"),
        q.NotNull(["o_orderkey"]),
        q.ValidValues("o_orderdate", ["nope"]),
        q.IsTrue("max(1 / (o_orderkey - o_orderkey)) > 0"),
    ]
    return q.evaluated_report(load("orders"), rules).select("position", "rule", "passed", "violations")


@query(
    "describe_opaque",
    """WITH g AS (SELECT sha256(text) AS digest, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1)
       SELECT sum(n)::BIGINT AS "count", count(*) AS "unique", max(n) AS freq,
              (SELECT digest FROM g ORDER BY n DESC, digest LIMIT 1) AS top FROM g""",
)
def describe_opaque(load):
    return profile.describe_opaque(load("documents"), "text")


@query(
    "column_bytes",
    """SELECT 'html' AS "column", sum(octet_length(encode(html)))::BIGINT AS n_bytes FROM pages
       UNION ALL SELECT 'embedding', sum(len(embedding) * 4)::BIGINT FROM embeddings""",
)
def column_bytes(load):
    html = profile.column_bytes(load("pages"), "html")
    return html.unionByName(profile.column_bytes(load("embeddings"), "embedding"))


@query(
    "tensor_stats",
    """SELECT vec_id, [len(embedding)] AS shape, round(list_min(embedding)::DOUBLE, 6) AS low,
              round(list_max(embedding)::DOUBLE, 6) AS high,
              round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding), 6) AS mean
       FROM embeddings""",
)
def tensor_stats(load):
    tensors = profile.as_tensor(load("embeddings"), "embedding")
    return profile.tensor_stats(tensors, "embedding", "vec_id")


@query(
    "tensor_shapes",
    """SELECT [len(embedding)] AS shape, 'float32' AS dtype, count(*) AS n_rows FROM embeddings
       WHERE embedding IS NOT NULL GROUP BY 1""",
)
def tensor_shapes(load):
    return profile.tensor_shapes(profile.as_tensor(load("embeddings"), "embedding"), "embedding")


_FINGERPRINT_SQL = """
WITH item AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, sha256(text) AS h FROM documents),
     one AS (SELECT i // 256 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM item GROUP BY 1),
     two AS (SELECT i // 256 AS i, CASE WHEN (SELECT count(*) FROM one) = 1 THEN max(h)
                    ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM one GROUP BY 1)
SELECT (SELECT count(*) FROM documents) AS n_rows, h AS digest FROM two
"""


@query("dataset_fingerprint", _FINGERPRINT_SQL)
def dataset_fingerprint(load):
    return profile.fingerprint(load("documents"), ["doc_id"], "text")

"""Queries for projection, position, sorting, batching and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import text
from assetlake.operators import batches as b
from assetlake.operators import position as p
from assetlake.operators.predict import predict
from assetlake.plans.registry import query

TURN = ["conv_id", "turn"]


@query("project_columns", "SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem")
def project_columns(load):
    return b.project(load("lineitem"), ["l_shipdate", "l_orderkey", "l_quantity"])


@query(
    "row_at",
    """SELECT * FROM (SELECT 'first' AS which, * FROM conversations ORDER BY conv_id, turn LIMIT 1 OFFSET 7)
       UNION ALL
       SELECT * FROM (SELECT 'last' AS which, * FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1 OFFSET 4)""",
)
def row_at(load):
    turns = load("conversations")
    table = p.ordered(turns, TURN)
    front = table.at(7).withColumn("which", F.lit("first"))
    back = table.at(-5).withColumn("which", F.lit("last"))
    return front.unionByName(back)


@query(
    "row_slice",
    """WITH n AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, * FROM conversations),
            c AS (SELECT count(*) AS total FROM conversations)
       SELECT 'forward' AS kind, (i - 10) // 7 AS pos, conv_id, turn, text FROM n WHERE i >= 10 AND (i - 10) % 7 = 0
       UNION ALL
       SELECT 'backward', (total - 1 - i) // 3, conv_id, turn, text FROM n, c WHERE i > 20 AND (total - 1 - i) % 3 = 0
       UNION ALL
       SELECT 'head', i, conv_id, turn, text FROM n, c WHERE i < total - 5""",
)
def row_slice(load):
    turns = load("conversations").select(*TURN, "text")
    table = p.ordered(turns, TURN)
    forward = table.slice(10, None, 7).withColumn("kind", F.lit("forward"))
    backward = table.slice(None, 20, -3).withColumn("kind", F.lit("backward"))
    start = table.slice(None, -5).withColumn("kind", F.lit("head"))
    return forward.unionByName(backward).unionByName(start)


@query("mask_filter", "SELECT doc_id, text FROM documents WHERE lang = 'en' AND n_chars > 100")
def mask_filter(load):
    mask = (F.col("lang") == "en") & (F.col("n_chars") > 100)
    return load("documents").filter(mask).select("doc_id", "text")


@query(
    "positional_equals",
    """WITH l AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, text FROM documents),
            r AS (SELECT row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS idx, text FROM documents WHERE lang <> 'de')
       SELECT l.idx, r.idx IS NOT NULL AND l.text IS NOT DISTINCT FROM r.text AS equal
       FROM l LEFT JOIN r ON l.idx = r.idx""",
)
def positional_equals(load):
    docs = load("documents")
    right = docs.filter("lang <> 'de'")
    return p.positional_equals(docs, right, "text", ["doc_id"], ["n_chars", "doc_id"])


@query(
    "retention_select",
    """SELECT event_id, ts, event_type FROM events
       WHERE ts < TIMESTAMP '2024-01-16' AND regexp_matches(event_type, '^(view|cl)')""",
)
def retention_select(load):
    old = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    chosen = load("events").filter(old & F.col("event_type").rlike("^(view|cl)"))
    return chosen.select("event_id", "ts", "event_type")


@query(
    "retention_dry_run",
    """SELECT count(*) AS n FROM events
       WHERE ts < TIMESTAMP '2024-01-16' AND regexp_matches(event_type, '^(view|cl)')""",
)
def retention_dry_run(load):
    return retention_select(load).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sort_fields",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey",
)
def sort_fields(load):
    fields = [("o_orderstatus", False), ("o_totalprice", True), ("o_orderkey", False)]
    keys = [F.col(name).desc() if descending else F.col(name).asc() for name, descending in fields]
    return load("orders").select(*[name for name, _ in fields]).orderBy(*keys)


@query(
    "truncate_text",
    """SELECT doc_id, CASE WHEN length(text) > 99999 THEN substring(text, 1, 99996) || '...' ELSE text END AS info,
              substring(text, 1, 25000) AS readme FROM documents""",
)
def truncate_text(load):
    body = F.col("text")
    return load("documents").select(
        "doc_id", text.failure_info(body).alias("info"), text.readme(body).alias("readme")
    )


_SHUFFLED = """
WITH placed AS (SELECT row_number() OVER (ORDER BY md5(o_orderkey || '|42'), o_orderkey) - 1 AS idx,
                       o_orderkey, o_totalprice FROM orders),
     size AS (SELECT count(*) AS total FROM orders)
"""


@query(
    "training_batches",
    _SHUFFLED
    + """SELECT idx, idx // 32 AS batch_id, (idx % 32)::INTEGER AS slot, o_totalprice / 100 AS price, o_orderkey
         FROM placed, size WHERE idx < total - total % 32""",
)
def training_batches(load):
    picked = b.training_batches(
        load("orders"), ["o_orderkey"], 32, ["o_orderkey", "o_totalprice"], shuffle_seed=42, drop_last=True
    )
    return picked.withColumn("price", F.col("o_totalprice") / 100).drop("o_totalprice")


@query(
    "transformed_rows",
    "SELECT p_partkey, p_name || '!' AS label FROM part",
)
def transformed_rows(load):
    def label(frame):
        return frame.assign(label=frame["p_name"] + "!")[["p_partkey", "label"]]

    return b.transform_rows(load("part").select("p_partkey", "p_name"), label, "p_partkey long, label string")


@query(
    "sampled_batches",
    """WITH placed AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, p_partkey, p_brand FROM part),
            sampler AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos,
                               CASE WHEN o_custkey % 2 = 0 AND o_custkey > 0 THEN (SELECT count(*) FROM part) - o_custkey ELSE o_custkey END AS idx FROM orders)
       SELECT pos // 16 AS batch_id, (pos % 16)::INTEGER AS slot, idx, p_partkey, p_brand
       FROM sampler LEFT JOIN placed USING (idx)""",
)
def sampled_batches(load):
    """A sampler whose even customers count from the end of the parts."""
    customer = F.col("o_custkey")
    orders = load("orders").select("o_orderkey", F.when(customer % 2 == 0, -customer).otherwise(customer).alias("idx"))
    sampler = p.with_position(orders, ["o_orderkey"], "pos").select("pos", "idx")
    return b.sampled_batches(load("part").select("p_partkey", "p_brand"), ["p_partkey"], sampler, 16)


@query(
    "grouped_batches",
    """WITH placed AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, p_partkey, p_brand FROM part),
            groups AS (SELECT l_orderkey AS batch_id, l_linenumber AS slot, count(*) AS n, (l_orderkey + l_linenumber) % 100 AS idx
                       FROM lineitem GROUP BY l_orderkey, l_linenumber)
       SELECT batch_id, slot, idx, p_partkey, p_brand FROM groups LEFT JOIN placed USING (idx)""",
)
def grouped_batches(load):
    """Batches given as groups of positions: one per order, with a slot per line number."""
    lines = load("lineitem").select(F.col("l_orderkey").alias("batch_id"), F.col("l_linenumber").alias("slot")).distinct()
    groups = lines.withColumn("idx", (F.col("batch_id") + F.col("slot")) % 100)
    return b.grouped_batches(load("part").select("p_partkey", "p_brand"), ["p_partkey"], groups)


@query(
    "collated_batches",
    """WITH placed AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, * FROM orders)
       SELECT idx // 50 AS batch_id, count(*) AS n_rows, list(o_orderkey ORDER BY idx) AS o_orderkey,
              list(o_totalprice ORDER BY idx) AS o_totalprice FROM placed GROUP BY 1""",
)
def collated_batches(load):
    columns = ["o_orderkey", "o_totalprice"]
    return b.collate(b.training_batches(load("orders"), ["o_orderkey"], 50, columns), columns)


class LinearScorer:
    """A model with a ``predict`` function, as a user would bring it."""

    def __init__(self, weights):
        self.weights = weights

    def predict(self, frame):
        return sum(frame[c].to_numpy() * w for c, w in self.weights.items())


@query(
    "batch_predict",
    "SELECT p_partkey, p_size * 0.5 + p_retailprice * 0.25 AS score FROM part",
)
def batch_predict(load):
    model = LinearScorer({"p_size": 0.5, "p_retailprice": 0.25})
    return predict(load("part"), model, list(model.weights), "score double", keep=["p_partkey"])

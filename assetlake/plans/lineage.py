"""Queries over dependency graphs derived from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import lineage as g
from assetlake.plans.registry import query


def definitions(load):
    """Part k depends on parts k div 2 and k div 3, and on a source that is not defined; each is declared twice."""
    key = F.col("p_partkey")
    parts = load("part").select(key.alias("k"))
    node = F.concat(F.lit("part-"), F.col("k"))
    half = F.when(F.col("k") >= 2, F.concat(F.lit("part-"), F.expr("k div 2")))
    third = F.when(F.col("k") >= 3, F.concat(F.lit("part-"), F.expr("k div 3")))
    source = F.concat(F.lit("source-"), F.col("k") % 7)
    old = parts.select(F.col("k").alias("seq"), node.alias("node"), F.lit("shop").alias("project"), F.array(F.lit("old")).alias("depends_on"))
    new = parts.select(
        (F.col("k") + F.lit(10**9)).alias("seq"),
        node.alias("node"),
        F.lit("shop").alias("project"),
        F.array_compact(F.array(half, third, source)).alias("depends_on"),
    )
    return old.unionByName(new)


_EDGES_SQL = """
edges AS (SELECT DISTINCT * FROM (
  SELECT 'part-' || (p_partkey // 2) AS src, 'part-' || p_partkey AS dst FROM part WHERE p_partkey >= 2
  UNION ALL SELECT 'part-' || (p_partkey // 3), 'part-' || p_partkey FROM part WHERE p_partkey >= 3)),
nodes AS (SELECT 'part-' || p_partkey AS node FROM part)
"""
_LEVELS_SQL = (
    "WITH RECURSIVE "
    + _EDGES_SQL
    + """, walk AS (
  SELECT node, 0 AS level FROM nodes WHERE node NOT IN (SELECT dst FROM edges)
  UNION SELECT e.dst, w.level + 1 FROM walk w JOIN edges e ON e.src = w.node),
levels AS (SELECT node, max(level) AS level FROM walk GROUP BY node)
"""
)


@query("lineage_edges", "WITH " + _EDGES_SQL + "SELECT src, dst FROM edges")
def lineage_edges(load):
    return g.lineage_edges(definitions(load))


@query("internal_deps", "WITH " + _EDGES_SQL + "SELECT dst, count(*) AS n FROM edges GROUP BY dst")
def internal_deps(load):
    return g.dependencies(definitions(load)).filter("internal").groupBy("dst").agg(F.count(F.lit(1)).alias("n"))


@query("external_deps", "SELECT 'source-' || (p_partkey % 7) AS src, 'part-' || p_partkey AS dst FROM part")
def external_deps(load):
    return g.dependencies(definitions(load)).filter("NOT internal").select("src", "dst")


def _levels(load):
    nodes, depends = g.graph(definitions(load))
    return g.lineage_levels(nodes, depends.filter("internal").select("src", "dst")), depends


@query("lineage_levels", _LEVELS_SQL + "SELECT node, level FROM levels")
def lineage_levels(load):
    return _levels(load)[0]


@query(
    "level_groups",
    _LEVELS_SQL
    + """, depends AS (SELECT src, dst FROM edges
                       UNION ALL SELECT 'source-' || (p_partkey % 7), 'part-' || p_partkey FROM part)
         SELECT level, CASE WHEN n_assets > 1 THEN 'parallel' ELSE 'sequential' END AS mode, n_assets, node, src AS dependency
         FROM (SELECT *, count(*) OVER (PARTITION BY level) AS n_assets FROM levels) LEFT JOIN depends ON dst = node""",
)
def level_groups(load):
    return g.level_groups(*_levels(load))


def ring_edges(load):
    """Groups of four parts in a chain; by size, some chains close into one or more cycles, joined by bridge nodes."""
    parts = load("part").select(F.expr("p_partkey div 4").alias("b"), (F.col("p_partkey") % 4).alias("i"), "p_size")

    def name(i):
        return F.concat(F.lit("g"), F.col("b"), F.lit("."), F.lit(i) if isinstance(i, int) else i)

    chain = parts.filter("i < 3").select(name(F.col("i")).alias("src"), name(F.col("i") + 1).alias("dst"))
    close = parts.filter("i = 3 AND p_size > 25").select(name(3).alias("src"), name(0).alias("dst"))
    back = parts.filter("i = 2 AND p_size > 25").select(name(2).alias("src"), name(0).alias("dst"))
    loop = parts.filter("i = 1 AND p_size > 40").select(name(1).alias("src"), name(1).alias("dst"))
    # An even group leads to the next one by way of a node that is on no cycle itself.
    bridge = F.concat(F.lit("bridge"), F.col("b"))
    after = F.concat(F.lit("g"), F.col("b") + 1, F.lit(".0"))
    into = parts.filter("i = 3 AND b % 2 = 0").select(name(3).alias("src"), bridge.alias("dst"))
    out = parts.filter("i = 3 AND b % 2 = 0").select(bridge.alias("src"), after.alias("dst"))
    return chain.unionByName(close).unionByName(back).unionByName(loop).unionByName(into).unionByName(out)


_RINGS_SQL = """
parts AS (SELECT p_partkey // 4 AS b, p_partkey % 4 AS i, p_size FROM part),
e AS (
  SELECT 'g' || b || '.' || i AS src, 'g' || b || '.' || (i + 1) AS dst FROM parts WHERE i < 3
  UNION ALL SELECT 'g' || b || '.3', 'g' || b || '.0' FROM parts WHERE i = 3 AND p_size > 25
  UNION ALL SELECT 'g' || b || '.2', 'g' || b || '.0' FROM parts WHERE i = 2 AND p_size > 25
  UNION ALL SELECT 'g' || b || '.1', 'g' || b || '.1' FROM parts WHERE i = 1 AND p_size > 40
  UNION ALL SELECT 'g' || b || '.3', 'bridge' || b FROM parts WHERE i = 3 AND b % 2 = 0
  UNION ALL SELECT 'bridge' || b, 'g' || (b + 1) || '.0' FROM parts WHERE i = 3 AND b % 2 = 0),
walk AS (
  SELECT dst AS start, [dst] AS path, src AS next FROM e WHERE src >= dst AND src NOT LIKE 'bridge%' AND dst NOT LIKE 'bridge%'
  UNION ALL
  SELECT w.start, list_append(w.path, w.next), e.src FROM walk w JOIN e ON e.dst = w.next
  WHERE w.next > w.start AND NOT list_contains(w.path, w.next) AND e.src >= w.start AND e.src NOT LIKE 'bridge%'),
cycles AS (SELECT path, array_to_string(list_append(path, start), ' -> ') AS cycle FROM walk WHERE next = start)
"""


@query("cyclic_nodes", "WITH RECURSIVE " + _RINGS_SQL + "SELECT DISTINCT unnest(path) AS node FROM cycles")
def cyclic_nodes(load):
    return g.cyclic_nodes(ring_edges(load))


@query("cycle_paths", "WITH RECURSIVE " + _RINGS_SQL + "SELECT cycle FROM cycles")
def cycle_paths(load):
    return g.cycle_paths(ring_edges(load))

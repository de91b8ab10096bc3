import random

import pytest
from pyspark.sql import functions as F

from assetlake.operators import lineage as g


def graph(spark, depends):
    rows = [(seq, node, "p", deps) for seq, (node, deps) in enumerate(depends)]
    return spark.createDataFrame(rows, "seq long, node string, project string, depends_on array<string>")


def plan(spark, depends):
    definitions = graph(spark, depends)
    nodes = g.latest_definitions(definitions).select("node")
    levels = g.lineage_levels(nodes, g.lineage_edges(definitions))
    rows = g.level_groups(levels, g.dependencies(definitions)).collect()
    out = {}
    for r in rows:
        out.setdefault((r["level"], r["mode"]), set()).add((r["node"], r["dependency"]))
    return out


def test_linear(spark):
    got = plan(spark, [("ds1", []), ("ds2", ["ds1"]), ("ds3", ["ds2"]), ("m1", ["ds3"]), ("m2", ["m1"])])
    assert [k for k in sorted(got)] == [(i, "sequential") for i in range(5)]
    assert got[(4, "sequential")] == {("m2", "m1")}


def test_parallel(spark):
    got = plan(spark, [(n, []) for n in ("ds1", "ds2", "ds3", "m1", "m2")])
    assert list(got) == [(0, "parallel")] and len(got[(0, "parallel")]) == 5


def test_mixed_with_external_and_redefinition(spark):
    got = plan(spark, [("ds3", ["zzz"]), ("ds1", []), ("ds2", []), ("ds3", ["ds1", "ext"]), ("ds4", ["ds2"]), ("m1", ["ds3", "ds4", "ds1"])])
    assert got == {
        (0, "parallel"): {("ds1", None), ("ds2", None)},
        (1, "parallel"): {("ds3", "ds1"), ("ds3", "ext"), ("ds4", "ds2")},
        (2, "sequential"): {("m1", "ds3"), ("m1", "ds4"), ("m1", "ds1")},
    }


def test_node_without_project(spark):
    bad = graph(spark, [("a", [])]).withColumn("project", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="without a project"):
        g.latest_definitions(bad).collect()


def test_cycles(spark):
    definitions = graph(spark, [("m", ["a", "e"]), ("a", ["m", "e"]), ("e", ["s"]), ("s", ["a", "m"]), ("x", ["m"]), ("y", [])])
    edges = g.lineage_edges(definitions)
    got = sorted(r["cycle"] for r in g.cycle_paths(edges).collect())
    assert got == ["a -> e -> s -> a", "a -> e -> s -> m -> a", "a -> m -> a", "a -> m -> e -> s -> a", "e -> s -> m -> e"]
    assert {r["node"] for r in g.cyclic_nodes(edges).collect()} == {"m", "a", "e", "s"}
    with pytest.raises(g.CycleError, match="around 4 nodes, least a") as raised:
        g.require_acyclic(edges)
    assert {r["node"] for r in raised.value.nodes.collect()} == {"m", "a", "e", "s"}
    # A cycle that a start node leads into.
    with pytest.raises(g.CycleError):
        g.lineage_levels(g.latest_definitions(definitions).select("node"), edges.union(spark.createDataFrame([("y", "m")], "src string, dst string")))


def test_levels_need_an_acyclic_graph(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    for pairs in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a")]):
        with pytest.raises(g.CycleError):
            g.lineage_levels(nodes, spark.createDataFrame(pairs, "src string, dst string"))
    assert g.lineage_levels(nodes.limit(0), spark.createDataFrame([], "src string, dst string")).isEmpty()


def test_self_loop_and_acyclic(spark):
    loop = spark.createDataFrame([("a", "a"), ("a", "b")], "src string, dst string")
    assert [r["cycle"] for r in g.cycle_paths(loop).collect()] == ["a -> a"]
    line = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    assert g.cycle_paths(line).isEmpty()
    g.require_acyclic(line)


def test_bridge_between_cycles_is_on_none(spark):
    pairs = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "d"), ("e", "f"), ("c", "c2"), ("c2", "d")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    got = {(r["node"], r["component"]) for r in g.cycle_members(edges).collect()}
    assert got == {("a", "a"), ("b", "a"), ("d", "d"), ("e", "d")}


def plain_levels(nodes, pairs):
    """Longest paths by plain peeling; the nodes that cannot be placed are left out."""
    above = {n: {a for a, b in pairs if b == n} for n in nodes}
    levels = {}
    while ready := [n for n in nodes if n not in levels and all(a in levels for a in above[n])]:
        levels |= {n: max((levels[a] + 1 for a in above[n]), default=0) for n in ready}
    return levels


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_random_graphs(spark, seed):
    """Chains, trees, shared sources and repeated edges; with an edge back there is a cycle."""
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(60)]
    pairs = [(names[k - 1], names[k]) for k in range(1, 25)]
    pairs += [(names[rng.randrange(k)], names[k]) for k in range(25, 60) for _ in range(rng.randrange(3))]
    pairs += [(names[0], names[k]) for k in rng.sample(range(1, 25), 6)] + pairs[:5]
    nodes = spark.createDataFrame([(n,) for n in names], "node string")
    edges = spark.createDataFrame(pairs, "src string, dst string")
    got = {r["node"]: r["level"] for r in g.lineage_levels(nodes, edges).collect()}
    assert got == plain_levels(names, set(pairs))
    back = pairs + [(names[20], names[5]), (names[12], names[11])]
    closed = spark.createDataFrame(back, "src string, dst string")
    with pytest.raises(g.CycleError):
        g.lineage_levels(nodes, closed)
    behind = set(names) - set(plain_levels(names, set(back)))
    ahead = behind - set(plain_levels(sorted(behind), {(b, a) for a, b in back if a in behind and b in behind}))
    assert {tuple(r) for r in g.cyclic_edges(closed).collect()} == {(a, b) for a, b in back if a in ahead and b in ahead}


def test_rounds_of_long_chains(spark, monkeypatch):
    """4,096 nodes in a row, each of them also built from the first one: rounds follow the logarithm."""
    rounds, plain = [], g.Observation

    def counted():
        rounds.append(1)
        return plain()

    monkeypatch.setattr(g, "Observation", counted)
    ids = spark.range(4096).select("id")
    nodes = ids.select(F.col("id").alias("node"))
    chain = ids.where("id > 0").select((F.col("id") - 1).alias("src"), F.col("id").alias("dst"))
    for edges in (chain, chain.unionByName(ids.where("id > 1").select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst")))):
        rounds.clear()
        assert g.lineage_levels(nodes, edges).where("node <> level").isEmpty() and len(rounds) <= 15
    rounds.clear()
    assert g.cyclic_edges(chain).isEmpty() and len(rounds) <= 30

"""Lineage over dependency tables: levels, external dependencies and cycles.

``edges`` has ``src`` (the dependency) and ``dst`` (the asset built from it). Iterations write
each round as a table in the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from assetlake.operators.catalog import last_by
from assetlake.operators.skew import lookup
from assetlake.session import cut_lineage, shared_dir


class CycleError(ValueError):
    """The dependencies form a cycle; ``nodes``, where known, is the table of the nodes on cycles."""

    def __init__(self, message: str, nodes: DataFrame | None = None):
        super().__init__(message)
        self.nodes = nodes


def latest_definitions(definitions: DataFrame) -> DataFrame:
    """One definition per node: a later one replaces an earlier one. Nodes need a project."""
    named = F.when(F.col("project").isNull(), F.raise_error("an asset without a project")).otherwise(F.col("node"))
    checked = definitions.withColumn("node", named)
    return last_by(checked, ["node"], ["seq"], ["project", "depends_on"])


def dependencies(definitions: DataFrame) -> DataFrame:
    """``(src, dst, internal)`` per declared dependency of the latest definitions, stored once."""
    return graph(definitions)[1]


def graph(definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes and the :func:`dependencies` of the latest definitions, both stored."""
    current = cut_lineage(latest_definitions(definitions), "definitions")
    declared = current.select(F.explode("depends_on").alias("src"), F.col("node").alias("dst")).distinct()
    nodes = current.select("node")
    known = nodes.select(F.col("node").alias("src"), F.lit(True).alias("_known"))
    found = lookup(declared, known, ["src"]).select("src", "dst", F.col("_known").isNotNull().alias("internal"))
    return nodes, cut_lineage(found, "dependencies")


def lineage_edges(definitions: DataFrame) -> DataFrame:
    """Edges between assets that are both defined; other dependencies are external, not errors."""
    return dependencies(definitions).filter("internal").select("src", "dst")


def _numbered(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored ``(node, id)`` of all nodes and the edges between them as distinct ``(src, dst)`` ids."""
    ids = cut_lineage(nodes.select("node").distinct().withColumn("id", F.monotonically_increasing_id()), "node-ids")
    for end in ("src", "dst"):
        edges = edges.join(ids.select(F.col("node").alias(end), F.col("id").alias(f"_{end}")), end)
    return ids, cut_lineage(edges.select(F.col("_src").alias("src"), F.col("_dst").alias("dst")).distinct(), "edge-ids")


def _place(ids: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, level)`` of the nodes that are not on or behind a cycle, and the ``id`` of the others.

    A link says that a node's level is at least its source's plus ``weight``; ``least`` is what sources placed so far
    ask for. In a round, nodes without links are placed, and a link whose source has one link itself is moved on to the
    source of that one, by both weights. So a chain is halved in each round, also where its nodes have further sources
    that are placed already; links only become fewer.
    """
    spark = ids.sparkSession
    path, k = shared_dir(spark, "levels"), 0
    schema = "dst long, src long, weight long, least long"
    own = [F.lit(None).cast("long").alias("src"), F.lit(None).cast("long").alias("weight")]
    links = edges.select("dst", "src", F.lit(1).cast("long").alias("weight"), F.lit(0).cast("long").alias("least"))
    links = links.unionByName(ids.select(F.col("id").alias("dst"), *own, F.lit(0).cast("long").alias("least")))
    links = cut_lineage(links, "links")
    while True:
        # The source and weight are those of the only link where there is one.
        state = links.groupBy("dst").agg(
            F.max("least").alias("least"), F.count("src").alias("n"), F.max("src").alias("up"), F.max("weight").alias("by")
        )
        of_source = state.select(F.col("dst").alias("src"), F.col("least").alias("_least"), "n", "up", "by")
        met = links.where("src is not null").select("dst", "src", "weight").join(of_source, "src")
        moved = met.select(
            "dst",
            F.expr("CASE n WHEN 0 THEN null WHEN 1 THEN up ELSE src END").alias("src"),
            F.expr("CASE n WHEN 0 THEN null WHEN 1 THEN weight + by ELSE weight END").alias("weight"),
            F.expr("CASE WHEN n <= 1 THEN _least + weight ELSE 0 END").alias("least"),
        )
        # A source that a link was moved on to may be one that is placed in this round.
        levels = state.where("n = 0").select(F.col("dst").alias("src"), F.col("least").alias("level"))
        moved = moved.join(levels, "src", "left").select(
            "dst",
            F.expr("CASE WHEN level IS NULL THEN src END").alias("src"),
            F.expr("CASE WHEN level IS NULL THEN weight END").alias("weight"),
            F.expr("greatest(least, level + weight)").alias("least"),
        )
        rest = moved.unionByName(state.where("n > 0").select("dst", *own, "least"))
        rest = rest.groupBy("dst", "src").agg(F.max("weight").alias("weight"), F.max("least").alias("least"))
        placed = state.where("n = 0").select("dst", *own, "least")
        told = Observation()
        after = rest.withColumn("placed", F.lit(False)).unionByName(placed.withColumn("placed", F.lit(True)))
        counted = after.observe(told, F.count_if(F.col("placed")).alias("placed"), F.count_if(~F.col("placed")).alias("rest"))
        counted.write.partitionBy("placed").parquet(f"{path}/round={k}")
        links = spark.read.schema(f"{schema}, placed boolean").parquet(f"{path}/round={k}").where("not placed").drop("placed")
        k += 1
        if not told.get["placed"] or not told.get["rest"]:
            break
    every = spark.read.schema(f"{schema}, round int, placed boolean").parquet(path)
    done = every.where("placed").select(F.col("dst").alias("id"), F.col("least").cast("int").alias("level"))
    return done, links.select(F.col("dst").alias("id")).distinct()


def lineage_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, level)``: the length of the longest path from an asset without dependencies.

    Rounds follow the logarithm of a chain's length, see ``_place``. Nodes that are left when none can be placed are
    on cycles or hang on one.
    """
    ids, numbered = _numbered(nodes, edges)
    levels, others = _place(ids, numbered)
    if not others.isEmpty():
        raise CycleError("the dependencies form a cycle")
    return levels.join(ids, "id").select("node", "level")


def level_groups(levels: DataFrame, edges: DataFrame) -> DataFrame:
    """``(level, mode, n_assets, node, dependency)``: one row per asset and dependency.

    ``mode`` is ``parallel`` when a level has several assets. An asset without dependencies
    has one row with a null dependency. ``edges`` may include external dependencies.
    """
    sizes = levels.groupBy("level").agg(F.count(F.lit(1)).alias("n_assets"))
    placed = cut_lineage(lookup(levels, sizes, ["level"], weight="n_assets"), "level-sizes")
    depends = edges.select(F.col("dst").alias("node"), F.col("src").alias("dependency")).distinct()
    depends = cut_lineage(depends, "level-dependencies")
    with_any = lookup(depends, placed, ["node"], how="inner")
    without = placed.join(depends.select("node").distinct(), "node", "left_anti")
    mode = F.when(F.col("n_assets") > 1, "parallel").otherwise("sequential")
    every = with_any.unionByName(without, allowMissingColumns=True)
    return every.select("level", mode.alias("mode"), "n_assets", "node", "dependency")


def cyclic_edges(edges: DataFrame) -> DataFrame:
    """Edges between nodes that both lie behind a cycle and lead to one: those on cycles and on ways from cycle to cycle.

    The nodes that cannot be placed are those behind a cycle; of these, the ones that cannot be placed from the other
    end lead to one.
    """
    nodes = edges.select(F.col("src").alias("node")).union(edges.select(F.col("dst").alias("node")))
    ids, rest = _numbered(nodes, edges)
    left = ids.select("id")
    for _ in range(2):
        left = cut_lineage(_place(left, rest)[1], "unplaced")
        for end in ("src", "dst"):
            rest = rest.join(left.select(F.col("id").alias(end)), end, "left_semi")
        rest = cut_lineage(rest.select(F.col("dst").alias("src"), F.col("src").alias("dst")), "cycle-edges")
    for end in ("src", "dst"):
        rest = rest.join(ids.select(F.col("id").alias(end), F.col("node").alias(f"_{end}")), end)
    return cut_lineage(rest.select(F.col("_src").alias("src"), F.col("_dst").alias("dst")), "cycle-edges")


def _reach(edges: DataFrame) -> DataFrame:
    """``(node, way, mark)``: for way 0 the least node that reaches each node, for way 1 the least one it reaches."""
    both = edges.select("src", "dst", F.lit(0).alias("way")).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1).alias("way"))
    )
    both = cut_lineage(both, "ways")
    marks = both.select(F.col("src").alias("node"), "way").union(both.select("dst", "way")).distinct()
    marks = cut_lineage(marks.withColumn("mark", F.col("node")), "reach")
    while True:
        reached = both.join(marks.select(F.col("node").alias("src"), "way", "mark"), ["src", "way"])
        own = marks.withColumn("own", F.col("mark"))
        every = own.unionByName(reached.select(F.col("dst").alias("node"), "way", "mark"), allowMissingColumns=True)
        after = every.groupBy("node", "way").agg(F.min("mark").alias("mark"), F.min("own").alias("own"))
        after = cut_lineage(after, "reach")
        marks = after.drop("own")
        if after.filter("mark <> own").isEmpty():
            return marks


def cycle_members(edges: DataFrame) -> DataFrame:
    """``(node, component)``: every node on a cycle, with the least node of its strongly connected component.

    Each round takes off what is on no cycle and marks every node with the least node that reaches it and the least one it
    reaches. Where the two agree, the node and its mark reach each other; these components leave the graph.
    """
    spark = edges.sparkSession
    rest = cyclic_edges(edges)
    path, k = shared_dir(spark, "components"), 0
    kind = rest.schema["src"].dataType.simpleString()
    while True:
        marks = _reach(rest)
        agreed = marks.groupBy("node", "mark").agg(F.count(F.lit(1)).alias("ways")).filter("ways = 2")
        members = cut_lineage(agreed.drop("ways"), "members")
        sizes = members.groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
        loops = rest.filter("src = dst").select(F.col("src").alias("mark")).distinct().withColumn("loop", F.lit(True))
        real = sizes.join(loops, "mark", "left").filter("n > 1 OR loop").select("mark")
        members.join(real, "mark", "left_semi").select("node", F.col("mark").alias("component")).write.parquet(f"{path}/round={k}")
        rest = rest.join(members.select(F.col("node").alias("src")), "src", "left_anti").join(
            members.select(F.col("node").alias("dst")), "dst", "left_anti"
        )
        rest, k = cyclic_edges(rest), k + 1
        if rest.isEmpty():
            return spark.read.schema(f"node {kind}, component {kind}, round int").parquet(path).drop("round")


def cyclic_nodes(edges: DataFrame) -> DataFrame:
    """Nodes on a cycle; empty means the graph can be ordered."""
    return cycle_members(edges).select("node")


def require_acyclic(edges: DataFrame) -> None:
    """Raise ``CycleError`` if there is a cycle; its ``nodes`` is the table of all nodes on cycles."""
    # What peeling leaves is empty exactly if there is no cycle.
    if not cyclic_edges(edges).isEmpty():
        nodes = cut_lineage(cyclic_nodes(edges), "cyclic")
        raise CycleError(f"cyclic dependencies around {nodes.count()} nodes, least {nodes.agg(F.min('node')).first()[0]}", nodes)


def cycle_paths(edges: DataFrame) -> DataFrame:
    """All simple cycles as ``a -> b -> a``, from each asset to what it depends on.

    Each cycle is found once, from its smallest node: paths grow along edges to larger nodes
    until they return to their start or cannot grow.
    """
    spark = edges.sparkSession
    steps = cut_lineage(
        cyclic_edges(edges).select(F.col("dst").cast("string").alias("last"), F.col("src").cast("string").alias("next")),
        "cycle-steps",
    )
    root = shared_dir(spark, "cycles")
    grown = steps.select(F.col("last").alias("start"), F.array("last").alias("path"), "last").distinct()
    length = 0
    while True:
        moves = cut_lineage(
            grown.join(steps, "last").filter(
                (F.col("next") == F.col("start"))
                | ((F.col("next") > F.col("start")) & ~F.array_contains("path", F.col("next")))
            ),
            "cycle-moves",
        )
        closed = moves.filter(F.col("next") == F.col("start"))
        text = F.array_join(F.concat("path", F.array("start")), " -> ")
        closed.select(text.alias("cycle")).write.parquet(f"{root}/length={length}")
        opened = moves.filter(F.col("next") != F.col("start")).select(
            "start", F.concat("path", F.array("next")).alias("path"), F.col("next").alias("last")
        )
        grown = opened
        if grown.isEmpty():
            break
        length += 1
    return spark.read.schema("cycle string, length int").parquet(root).select("cycle")

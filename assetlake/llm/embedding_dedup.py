"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside them, one vector per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import attach, keep_first, ordered_id, row_key
from assetlake.llm.components import component_roots
from assetlake.session import cut_lineage

THRESHOLD = 0.95
#: A vector also visits the cells whose centroid is at most this much less similar to it than its own.
MARGIN = 0.15
CELL_ROWS, MAX_CELLS = 1_000, 2_048
SAMPLE_ROWS = 40_000
BLOCK = 4_096
ITERATIONS = 8


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Unit centroids of unit vectors; a centroid without members keeps its place."""
    rng = np.random.default_rng(11)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(iterations):
        home = np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centroids[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return centroids


def usable(vector: str):
    """Not null, not all zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def deal(distinct: DataFrame, centroids: dict[int, np.ndarray], margin: float) -> DataFrame:
    """(node, n, x, width, cells): the vector's own cell first, then those it visits.

    Vectors of a width that the sample lacked share one cell.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(3).to_numpy()
            cells: list = [None] * len(widths)
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                if (c := shared.value.get(int(w))) is None:
                    for i in at:
                        cells[i] = [0]
                    continue
                likeness = unit(matrix(batch.column(2).take(pa.array(at)), int(w))) @ c.T
                home = likeness.argmax(axis=1)
                near = likeness >= likeness[np.arange(len(at)), home][:, None] - margin
                near[np.arange(len(at)), home] = False
                for i, h, row in zip(at, home, near):
                    cells[i] = [int(h), *np.flatnonzero(row).tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    rows = distinct.select("node", "n", "x", F.size("x").alias("width"))
    kind = distinct.schema["x"].dataType.simpleString()
    return rows.mapInArrow(run, f"node long, n long, x {kind}, width int, cells array<int>")


def cell_links(dealt: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Rows (u, v, links): links of ``u`` counted with multiplicity, and links (u, v) that span the components.

    A cell's own vectors are cut into blocks by hash; each block meets every vector of the cell, own or visiting, in
    batches of a matrix product. A pair found in both vectors' cells counts where the cell number is less. What a
    task gives is in proportion to the vectors it read, however many pairs there are.
    """
    own = dealt.select("width", F.element_at("cells", 1).alias("cell")).groupBy("width", "cell").agg(F.count(F.lit(1)).alias("own"))
    blocks = cut_lineage(own.withColumn("blocks", F.ceil(F.col("own") / block).cast("int")).drop("own"), "cells")
    rows = dealt.select("node", "n", "x", "width", "cells", F.posexplode("cells").alias("nth", "cell"))
    # One row per cell, and at most MAX_CELLS cells of each width.
    sized = rows.join(F.broadcast(blocks), ["width", "cell"])
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.expr("transform(sequence(0, blocks - 1), b -> struct(b as block, 1 as role))")
    here = F.when(F.col("nth") == 0, F.array(F.struct(mine.alias("block"), F.lit(0).alias("role")))).otherwise(F.expr("array()"))
    turns = sized.withColumn("turn", F.explode(F.concat(here.cast("array<struct<block:int,role:int>>"), every)))
    cols = ["width", "cell", "block", "role"]
    sent = turns.select("width", "cell", "turn.block", "turn.role", "node", "n", "x", "cells")
    sent = sent.repartition("width", "cell", "block").sortWithinPartitions(*cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for a, b in zip(starts, np.append(starts[1:], len(keys))):
                key = tuple(int(k) for k in keys[a, :3])
                if meeting is None or meeting.key != key:
                    if meeting is not None:
                        yield from meeting.spanning()
                    meeting = Meeting(key, threshold)
                yield from meeting.take(batch.slice(a, b - a), keys[a, 3] == 0)
        if meeting is not None:
            yield from meeting.spanning()

    return sent.mapInArrow(run, "u long, v long, links long")


class Meeting:
    """One block of a cell's own vectors, and the vectors that come to meet it."""

    def __init__(self, key: tuple[int, int, int], threshold: float):
        self.key, self.threshold, self.parts, self.ready = key, threshold, [], False

    def take(self, batch: pa.RecordBatch, own: bool) -> Iterator[pa.RecordBatch]:
        cells = batch.column(7)
        read = [batch.column(4).to_numpy(), batch.column(5).to_numpy(), unit(matrix(batch.column(6), self.key[0]))]
        lists = cells.to_pylist()
        if own:
            self.parts.append((*read, lists))
            return
        if not self.ready:
            self.node, self.n, self.x = (np.concatenate([p[i] for p in self.parts]) for i in range(3)) if self.parts else ([], [], [])
            self.cells = [set(c) for p in self.parts for c in p[3]]
            self.root = np.arange(len(self.node))
            self.ready = True
        if not len(self.node):
            return
        node, n, x = read
        links, back = np.zeros(len(node), np.int64), np.zeros(len(self.node), np.int64)
        us, vs = [], []
        for at in range(0, len(node), 1024):
            i, j = np.nonzero(x[at : at + 1024] @ self.x.T >= self.threshold)
            i = i + at
            keep = node[i] != self.node[j]
            i, j = i[keep], j[keep]
            home = np.array([c[0] for c in lists])
            if (visits := home[i] != self.key[1]).any():
                # A visitor's pair is left to the visitor's own cell if that has the lesser number and sees it too.
                once = np.ones(len(i), bool)
                once[visits] = [home[p] > self.key[1] or int(home[p]) not in self.cells[q] for p, q in zip(i[visits], j[visits])]
                i, j, visits = i[once], j[once], visits[once]
                np.add.at(back, j[visits], n[i[visits]])
            np.add.at(links, i, self.n[j])
            if len(i):
                first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                us.append(node[i[first]])
                vs.append(self.node[j[first]])
                self.union(j, np.repeat(j[first], np.diff(np.append(first, len(i)))))
        some, met = np.flatnonzero(links), np.flatnonzero(back)
        counted = [(node[some], node[some], links[some]), (self.node[met], self.node[met], back[met])]
        spans = [(u, v, np.zeros(len(u), np.int64)) for u, v in zip(us, vs)]
        yield self.batch(*(np.concatenate(c) for c in zip(*counted, *spans)))

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, low = a[apart], b[apart], np.minimum(x, y)[apart]
            np.minimum.at(root, x[apart], low)
            np.minimum.at(root, y[apart], low)
            while (root[root] != root).any():
                root[:] = root[root]

    def spanning(self) -> Iterator[pa.RecordBatch]:
        if self.ready and len(self.node):
            at = np.flatnonzero(self.root != np.arange(len(self.root)))
            yield self.batch(self.node[at], self.node[self.root[at]], np.zeros(len(at), np.int64))

    @staticmethod
    def batch(u, v, links) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v, links)], ["u", "v", "links"])


def fit_cells(distinct: DataFrame, total: int, sample_rows: int, cell_rows: int, max_cells: int) -> dict[int, np.ndarray]:
    """Centroids by width, from a sample of ``sample_rows`` expected distinct vectors."""
    even = F.shiftrightunsigned(F.xxhash64("x"), 11) / F.lit(float(1 << 53))
    sample = distinct.where(even * F.lit(float(total)) < sample_rows).select("x").collect()
    by_width: dict[int, list] = {}
    for r in sample:
        by_width.setdefault(len(r["x"]), []).append(r["x"])
    out = {}
    for width, xs in by_width.items():
        x = np.array(xs, np.float64)
        x = x[np.lexsort(x.T)]
        out[width] = spherical_kmeans(unit(x), max(1, min(max_cells, total * len(x) // (len(sample) * cell_rows))))
    return out


def embedding_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    margin: float = MARGIN,
    sample_rows: int = SAMPLE_ROWS,
    cell_rows: int = CELL_ROWS,
    max_cells: int = MAX_CELLS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors link at a cosine of ``threshold`` or more, in double precision. Every vector lies in the cell of its
    most similar centroid and visits those at most ``margin`` less similar; pairs that share no such cell are missed
    (the tests hold the recall against brute force). Only the centroids come from a bounded sample. Equal vectors are
    compared once and counted in full. Vectors that are null, all zero or hold null or non-finite components link with
    nothing, and neither do vectors of different width. A component's id is its least vector id; a row with a null id
    is kept only if it is alone. An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"))
    good = rows.where(usable("x"))
    grouped = good.groupBy("x").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    distinct = cut_lineage(grouped.withColumn("node", F.monotonically_increasing_id()), "vec-distinct")
    centroids = fit_cells(distinct, distinct.count(), sample_rows, cell_rows, max_cells)
    dealt = cut_lineage(deal(distinct, centroids, margin), "vec-dealt")
    found = cut_lineage(cell_links(dealt, threshold, block), "vec-links")
    counts = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    roots = component_roots(found.where("u <> v").select("u", "v"))
    known = distinct.join(counts, "node", "left").join(roots, "node", "left")
    known = cut_lineage(known.withColumn("root", F.coalesce("root", "node")), "vec-roots")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    named = attach(known, cut_lineage(least, "vec-least"), ["root"], "size", "inner")
    named = named.select("x", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = attach(good, cut_lineage(named, "vec-named"), ["x"], "n", "inner").select("id", "n_links", "component_id")
    alone = rows.where(~usable("x")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """The vectors that stay, one of each component, with all their columns; see :func:`embedding_components`.

    It is the one with the least id, a null id being larger than every id; rows that repeat an id are told apart by
    their vectors.
    """
    key = row_key(id_col, F.to_json(F.struct(F.col(vector_col).alias("x"))))
    rows = vectors.where(usable(vector_col)).select(ordered_id(id_col, key).alias("id"), F.col(vector_col).alias("x"))
    parts = embedding_components(rows, "id", "x", **options)
    parts = parts.select(F.col("id.key").alias("key"), F.col("component_id.key").alias("first"))
    return keep_first(vectors, key, parts, "vec")

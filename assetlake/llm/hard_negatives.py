"""Hard negatives: exact banded retrieval by inner product with LEMP-style coordinate pruning.

Rows are stored once in parts of similar length. A task holds one part as length buckets with sorted coordinate lists
and streams the anchors past it: the score an anchor still needs gives, for each of its focus coordinates, the range of
values a row can have; rows inside all ranges are the candidates, and their scores are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.session import cut_lineage

#: Bytes of vectors that a task holds, and of the sample that gives the first thresholds.
PART_BYTES = 32 << 20
SEED_BYTES = 2 << 20
#: Most rows of a bucket, and the least length in it relative to its greatest.
BUCKET = 4_096
SIMILAR = 0.9
#: Coordinates of an anchor (its largest) whose feasible ranges are intersected.
FOCUS = 4
#: Widening of a feasible range against rounding.
SLACK = 1e-9
EXACT = 2.0**53

HITS = "anchor long, want int, score long, id long, row long"


def floor_scaled(x: Column, by: int) -> Column:
    """The floor of ``by`` times ``x`` in double precision; null where ``x`` is null or not finite."""
    wide = x.cast("double") * by
    near = F.when(F.abs(wide) < EXACT, F.floor(wide).cast("double"))
    return near.when(F.abs(wide) < float("inf"), wide)  # beyond 2 ** 53 every double is whole


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors as rows of a matrix, short ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widen(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact also where double precision is not."""
    reach = np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query))
    if reach < EXACT:
        return vectors @ query
    whole = [int(x) for x in query]
    return np.array([sum(int(a) * b for a, b in zip(v, whole)) for v in vectors], object)


@dataclass
class Bucket:
    """Rows of similar length; ``lists`` keeps the sorted list of each coordinate that was asked for."""

    vectors: np.ndarray
    norms: np.ndarray
    start: int

    def __post_init__(self):
        self.units = self.vectors / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.lists: dict = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.units[:, f], kind="stable")
            self.lists[f] = (order, self.units[order, f])
        return self.lists[f]

    def search(self, query: np.ndarray, norm: float, focus: np.ndarray, needed: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the rows that may score ``needed`` or more."""
        length = norm * (self.norms[0] if needed >= 0 else self.norms[-1])
        cosine = needed / length if length > 0 else (np.inf if needed > 0 else -np.inf)
        if cosine > 1 + SLACK:
            return np.empty(0, np.int64), np.empty(0)
        found = None
        if cosine > -1:
            apart = np.arccos(min(1.0, cosine))
            ranges = []
            for f in focus:
                angle = np.arccos(np.clip(query[f] / norm, -1, 1))
                low = np.cos(min(np.pi, angle + apart)) - SLACK
                high = np.cos(max(0.0, angle - apart)) + SLACK
                order, values = self.coordinate(f)
                a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
                ranges.append((b - a, a, b, f, low, high))
            ranges.sort()
            if ranges and ranges[0][0] < len(self.norms):
                _, a, b, f, _, _ = ranges[0]
                found = self.lists[f][0][a:b]
                for _, _, _, f, low, high in ranges[1:]:
                    value = self.units[found, f]
                    found = found[(value >= low) & (value <= high)]
        if found is None:
            return np.arange(len(self.norms)), products(self.vectors, query)
        if len(found) * 4 > len(self.norms):
            return found, products(self.vectors, query)[found]
        return found, products(self.vectors[found], query)


class Part:
    """The rows of one part by falling length, in buckets."""

    def __init__(self, batches: list[pa.RecordBatch], width: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = widen(matrix(table["vec"].combine_chunks()), width)
        norms = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-norms, kind="stable")
        self.vectors, norms = vectors[order], norms[order]
        labels = table["label"].to_pylist()
        self.codes = {value: i for i, value in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.codes[value] for value in labels], np.int64)[order]
        ids = table["id"]
        self.none = ids.is_null().to_numpy()[order]
        self.ids = ids.fill_null(0).to_numpy()[order]
        self.rows = table["row"].to_numpy()[order]
        self.buckets, start = [], 0
        while start < len(norms):
            near = norms[start : start + BUCKET]
            size = int(np.searchsorted(-near, -near[0] * SIMILAR, "right"))
            self.buckets.append(Bucket(self.vectors[start : start + size], near[:size], start))
            start += size

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Positions within ``at`` of the first ``k`` by (score falling, id, row)."""
        return np.lexsort((self.rows[at], self.ids[at], self.none[at], -scores))[:k]

    def answer(self, row, label, query, same: bool, k: int, lows, highs, needs) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each band (low, high) the first ``k`` rows of the same, or of another, label with a score in it.

        ``needs`` are scores that the k-th of a band is known to reach; rows below them are left out.
        """
        query = np.pad(query, (0, max(0, self.vectors.shape[1] - len(query))))[: self.vectors.shape[1]]
        norm = float(np.sqrt((query**2).sum()))
        focus = np.argsort(-np.abs(query), kind="stable")[:FOCUS]
        needs = [max(low, need) for low, need in zip(lows, needs)]
        kept = [(np.empty(0, np.int64), np.empty(0)) for _ in lows]
        code = self.codes.get(label, -1)
        for bucket in self.buckets:
            if not needs:
                break
            at, scores = bucket.search(query, norm, focus, min(needs))
            at = at + bucket.start
            right = (self.labels[at] == code) & (self.rows[at] != row) if same else self.labels[at] != code
            at, scores = at[right], scores[right]
            for j, (high, need) in enumerate(zip(highs, needs)):
                inside = (scores >= need) & (scores <= high)
                if not inside.any():
                    continue
                places = np.concatenate([kept[j][0], at[inside]])
                values = np.concatenate([kept[j][1], scores[inside]])
                first = self.best(places, values, k)
                kept[j] = (places[first], values[first])
                if len(first) == k:
                    needs[j] = max(needs[j], values[first[-1]])
        return kept


def _anchors(batch: pa.RecordBatch) -> Iterator[tuple]:
    vectors = matrix(batch.column("vec"))
    bands = (batch.column(c).to_pylist() for c in ("row", "label", "lows", "highs", "needs"))
    for (row, label, lows, highs, needs), query in zip(zip(*bands), vectors):
        yield row, label, query, lows, highs, needs


def seeded(anchors: DataFrame, sample: pa.Table, same: bool, k: int) -> DataFrame:
    """Anchors whose ``needs`` are the k-th best scores of each band within the sample, where it has as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            part = part or Part(sample.to_batches(), 0)
            needs = []
            for row, label, query, lows, highs, before in _anchors(batch):
                if len(query) > part.vectors.shape[1]:
                    part = Part(sample.to_batches(), len(query))
                found = part.answer(row, label, query, same, k, lows, highs, before)
                needs.append([float(s[-1]) if len(s) == k else b for (_, s), b in zip(found, before)])
            at = batch.schema.get_field_index("needs")
            column = pa.array(needs, pa.list_(pa.float64()))
            yield batch.set_column(at, pa.field("needs", column.type), column)

    return anchors.mapInArrow(run, anchors.schema) if sample.num_rows else anchors


def hits(rows: DataFrame, anchors: DataFrame, parts: int, same: bool, k: int) -> DataFrame:
    """(anchor, want, score, id, row): of each part the first ``k`` rows of every band of every anchor.

    An anchor goes only to parts whose greatest length lets a row reach the least score it needs (there is one part per
    ``PART_BYTES`` of vectors); a part's rows are read before the anchors, which stream past them batch by batch.
    """
    longest = dict(rows.groupBy("part").agg(F.max("norm")).collect())  # one number per part
    reach = F.lit([longest.get(part, -1.0) for part in range(parts)])
    sent = anchors.where(F.size("lows") > 0).select("*", F.posexplode(reach).alias("part", "reach"))
    sent = sent.where(F.array_min("needs") <= F.col("reach") * F.col("norm") * (1 + SLACK))
    columns = ["part", "kind", "row", "id", "label", "vec", "lows", "highs", "needs"]
    nothing = F.lit(None).cast("array<double>")
    held = rows.select("part", F.lit(0).alias("kind"), "row", "id", "label", "vec", *[nothing.alias(c) for c in columns[-3:]])
    sent = sent.select("part", F.lit(1).alias("kind"), "row", "id", "label", "vec", *columns[-3:])
    met = held.unionByName(sent).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, part = None, [], None
        for whole in batches:
            marks = whole.column("part").to_numpy() * 2 + whole.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(marks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(marks)]):
                batch = whole.slice(a, b - a)
                if marks[a] // 2 != number:
                    number, waiting, part = marks[a] // 2, [], None
                if marks[a] % 2 == 0:
                    waiting.append(batch)
                    continue
                out = []
                for row, label, query, lows, highs, needs in _anchors(batch):
                    if part is None or len(query) > part.vectors.shape[1]:
                        part = Part(waiting, len(query))
                    for want, (at, scores) in enumerate(part.answer(row, label, query, same, k, lows, highs, needs)):
                        ids = [None if none else i for none, i in zip(part.none[at], part.ids[at].tolist())]
                        out += [(row, want, int(s), i, r) for s, i, r in zip(scores, ids, part.rows[at].tolist())]
                names = [f.split()[0] for f in HITS.split(", ")]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)

    return met.mapInArrow(run, HITS)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors and their positives.

    Vectors hold integers (of any numeric type); scores are their exact inner products, which must fit a long. Rows
    with a null label, a null vector or a null or non-finite component take no part. Anchors are the rows whose id is
    divisible by ``every``; an anchor's positives are its ``positives`` best other rows of the same label, a positive's
    negatives the ``negatives`` best rows of other labels with a score of ``low`` to ``high`` percent of the
    positive's. Better is a higher score, then a smaller id; a null id, which is never an anchor, comes after all others.

    A repeated row is a row of its own: it can be its copy's positive, fills a place of its own, and anchors that
    repeat each get their answers. Short vectors count as filled up with zeros, an empty or zero vector scores 0 with
    all. Positives with a negative score have no negatives. No row is left out: the thresholds that prune come from
    scores of real rows. Other columns of ``rows``, whatever their names, are not read.
    """
    spark = rows.sparkSession
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    plain = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vec")
    )
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = plain.where("label is not null and vec is not null").where(~odd)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    stored = cut_lineage(
        plain.select("*", norm.alias("norm"), F.rand(7).alias("spread"), F.monotonically_increasing_id().alias("row")),
        "negatives-rows",
    )
    count, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec") * 8 + 64), F.lit(0))).first()
    parts = max(1, -(-size // PART_BYTES), min(spark.sparkContext.defaultParallelism, -(-count // BUCKET)))
    placed = stored.repartitionByRange(parts, F.desc("norm"), "spread").withColumn("part", F.spark_partition_id())
    placed = cut_lineage(placed, "negatives-parts")
    # A uniform sample of bounded size, for the first thresholds only.
    sample = stored.where(F.col("spread") < SEED_BYTES / max(size, 1)).select("row", "id", "label", "vec").toArrow()

    ends = [F.array(F.lit(float(x))) for x in ("-inf", "inf", "-inf")]
    anchors = stored.where(F.col("id") % every == 0).drop("spread")
    anchors = anchors.select("*", *[e.alias(c) for e, c in zip(ends, ("lows", "highs", "needs"))])
    found = hits(placed, seeded(anchors, sample, True, positives), parts, True, positives)
    best = _first(found, ["anchor"], positives)
    pairs = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("pairs"))
    known = anchors.drop("lows", "highs", "needs").join(pairs.withColumnRenamed("anchor", "row"), "row")
    bounds = {
        "lows": F.transform("pairs", lambda p: F.ceil(p["score"] * F.lit(low).cast("decimal(10,0)") / 100).cast("double")),
        "highs": F.transform("pairs", lambda p: F.floor(p["score"] * F.lit(high).cast("decimal(10,0)") / 100).cast("double")),
    }
    known = known.select("*", *[c.alias(name) for name, c in bounds.items()]).withColumn("needs", F.col("lows"))
    known = cut_lineage(known, "negatives-positives")
    found = hits(placed, seeded(known, sample, False, negatives), parts, False, negatives)
    last = _first(found, ["anchor", "want"], negatives)
    told = known.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "pairs")
    pair = F.element_at("pairs", F.col("want") + 1)
    return last.join(told, "anchor").select(
        "anchor_id",
        pair["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        pair["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )

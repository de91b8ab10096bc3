"""Lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from assetlake.session import cut_lineage

#: A key is hot if it has more than this share of the rows, so fewer than ``1 / HOT_SHARE`` keys are.
HOT_SHARE = 1 / 1000
#: Keys that the sketch tracks for each one that may be hot; its error is then far below ``HOT_SHARE``.
TRACKED = 10
#: Pieces that a hot key's rows are cut into for each mean partition of rows that they would fill.
PIECES = 16


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str]) -> dict[int, float]:
    """Hash and share of the keys with more than ``HOT_SHARE`` of the rows, from one pass with a bounded sketch.

    The sketch holds ``TRACKED / HOT_SHARE`` hashes whatever the number of keys. It may overstate a count, never miss a
    hot key; two keys with one hash count as one.
    """
    most = math.ceil(1 / HOT_SHARE)
    top = F.call_function("approx_top_k", F.col("h"), F.lit(most), F.lit(TRACKED * most))
    rows, found = df.select(_hash(keys).alias("h")).agg(F.count(F.lit(1)), top).first()
    return {item["item"]: item["count"] / rows for item in found or [] if item["count"] > rows * HOT_SHARE}


def _weighted(dim: DataFrame, keys: Sequence[str], weight: str) -> dict[int, float]:
    """As :func:`hot_keys`, from the number of rows that ``dim`` holds for each key."""
    total = dim.agg(F.sum(weight)).first()[0] or 0
    heavy = dim.filter(F.col(weight) > total * HOT_SHARE).select(_hash(keys), weight)
    return {h: n / total for h, n in heavy.collect()}  # fewer than 1 / HOT_SHARE rows


def _pieces(shares: dict[int, float], keys: Sequence[str], partitions: int) -> Column:
    """Into how many pieces the rows of a key are cut: a power of two, 1 for all that are not hot."""
    classes: dict[int, list[int]] = {}
    for h, share in shares.items():
        pieces = 1 << max(0, math.ceil(math.log2(PIECES * share * partitions)))
        classes.setdefault(pieces, []).append(h)
    # At most one class per power of two; membership is a test of a hash set.
    return reduce(lambda rest, c: F.when(_hash(keys).isin(classes[c]), F.lit(c)).otherwise(rest), sorted(classes), F.lit(1))


def _hashable(kind: DataType) -> bool:
    return not any(word in kind.simpleString() for word in ("map<", "variant", "geo"))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    weight: str | None = None,
) -> DataFrame:
    """Join ``df`` to ``dim``, which holds one row per key; null keys match null keys.

    One pass over the keys finds those with more than ``HOT_SHARE`` of the rows; the join that follows reads both sides
    once. It is on the key and a piece: the rows of a hot key are cut into as many pieces as its share asks for, and
    ``dim`` repeats that key's row for each (in all ``PIECES`` rows a shuffle partition and two a hot key, at most), so
    no partition gets a hot key whole. A row's piece follows from its contents and its input partition, so a task that
    runs again deals its rows alike; rows equal in all columns go to as many pieces as there are input partitions. ``weight`` names a column of ``dim`` that holds the number of ``df`` rows per key:
    ``dim`` is then stored, as it is mostly an aggregate of ``df``, and ``df`` is read by the join only.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported lookup type: {how}")
    keys, spark = list(keys), df.sparkSession
    values = [c for c in dim.columns if c not in keys]
    if weight is not None:
        dim = cut_lineage(dim, "lookup")
    shares = hot_keys(df, keys) if weight is None else _weighted(dim, keys, weight)
    known = dim.select(*[F.col(f"`{k}`").alias(f"_k_{i}") for i, k in enumerate(keys)], *[F.col(f"`{v}`") for v in values])
    match = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k_{i}")) for i, k in enumerate(keys)]
    columns = df.columns
    if shares:
        pieces = _pieces(shares, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
        contents = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
        df = df.withColumn("_piece", F.when(pieces > 1, F.pmod(contents, pieces)).otherwise(0).cast("int"))
        held = [f"_k_{i}" for i in range(len(keys))]
        repeated = F.sequence(F.lit(0), _pieces(shares, held, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1)
        known = known.withColumn("_k_piece", F.explode(repeated))
        match.append(F.col("_piece") == F.col("_k_piece"))
    found = df.join(known, reduce(lambda a, b: a & b, match), how)
    return found.select(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{v}`") for v in values])

"""Running aggregates per key that split a hot key over many tasks.

A window partitioned by key alone sorts and walks each key in one task. Here the rows are cut
into blocks by range of (key, order); a window runs inside each block, and the part of a key that
lies in earlier blocks arrives as a carry, one row per key and block. Both joins are on the
window's own partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.operators.position import ROWS_PER_BLOCK, in_blocks

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def _merge(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a + b, a, b)
    return F.greatest(a, b) if kind == "max" else F.least(a, b)


@dataclass(frozen=True)
class Running:
    """``kind`` of ``value`` over the preceding rows of the key, with or without the row itself."""

    name: str
    kind: str
    value: Column
    inclusive: bool = True


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Sequence[Running],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add one column per running aggregate; ``keys`` + ``order`` must be a total order."""
    keys, order = list(keys), list(order)
    inputs = df.select("*", *[a.value.alias(f"_v_{a.name}") for a in aggregates])
    _, blocked = in_blocks(inputs, keys + order, rows_per_block)
    window = Window.partitionBy(*keys, "_block").orderBy(*order)

    def local(a: Running) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, 0 if a.inclusive else -1)
        return _AGGREGATES[a.kind](f"_v_{a.name}").over(frame).alias(a.name)

    scanned = blocked.select("*", *[local(a) for a in aggregates])
    partial = blocked.groupBy(*keys, "_block").agg(
        *[_AGGREGATES[a.kind](f"_v_{a.name}").alias(f"_p_{a.name}") for a in aggregates]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = partial.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_b"),
        F.row_number().over(Window.partitionBy(*keys).orderBy("_block")).alias("_nth"),
        *[_AGGREGATES[a.kind](f"_p_{a.name}").over(before).alias(f"_c_{a.name}") for a in aggregates],
    ).filter("_nth > 1")
    on = [scanned[k].eqNullSafe(carry[f"_k_{k}"]) for k in keys]
    joined = scanned.join(carry, [*on, scanned["_block"] == carry["_b"]], "left")
    merged = [_merge(a.kind, F.col(f"_c_{a.name}"), F.col(a.name)).alias(a.name) for a in aggregates]
    return joined.select(*df.columns, *merged)

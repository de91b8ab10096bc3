"""Reproducible training batches over a table with a total order key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.operators.position import ROWS_PER_BLOCK, positioned, take_positions


def project(df: DataFrame, tensors: Sequence[str] | None) -> DataFrame:
    """The named columns in the given order, or all of them."""
    return df.select(*tensors) if tensors else df


def shuffle_key(order: Sequence[str], seed: int) -> Column:
    """A pseudo-random sort key that depends only on the row's key and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order], F.lit(str(seed))))


def training_batches(
    df: DataFrame,
    order: Sequence[str],
    batch_size: int = 1,
    tensors: Sequence[str] | None = None,
    shuffle_seed: int | None = None,
    drop_last: bool = False,
    shards: int | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add ``idx``, ``batch_id`` and ``slot``; a seed shuffles, the same way every time."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    sort = list(order)
    if shuffle_seed is not None:
        df = df.withColumn("_shuffle", shuffle_key(order, shuffle_seed))
        sort = ["_shuffle", *sort]
    keep = list(dict.fromkeys([*(tensors or df.columns), *sort]))
    total, placed = positioned(df.select(*keep), sort, "idx", rows_per_block)
    if drop_last:
        placed = placed.filter(F.col("idx") < total - total % batch_size)
    out = placed.select(
        F.col("idx"),
        F.expr(f"idx div {batch_size}").alias("batch_id"),
        (F.col("idx") % batch_size).cast("int").alias("slot"),
        *[c for c in (tensors or df.columns) if c != "_shuffle"],
    )
    return out.repartition(shards, "batch_id") if shards else out


def sampled_batches(
    df: DataFrame,
    order: Sequence[str],
    sampler: DataFrame,
    batch_size: int = 1,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Batches of the rows a sampler names: ``sampler(pos, idx)``, where ``idx`` may repeat or count from the end."""
    picked = take_positions(df, order, sampler, "idx", rows_per_block)
    return picked.select(
        F.expr(f"pos div {batch_size}").alias("batch_id"),
        (F.col("pos") % batch_size).cast("int").alias("slot"),
        *[c for c in picked.columns if c != "pos"],
    )


def grouped_batches(
    df: DataFrame, order: Sequence[str], groups: DataFrame, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Batches given as index groups: ``groups(batch_id, slot, idx)``."""
    return take_positions(df, order, groups, "idx", rows_per_block)


def collate(batches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fold each batch into one row of arrays in slot order; a batch has ``batch_size`` rows."""
    items = F.array_sort(F.collect_list(F.struct("slot", *columns)))
    folded = batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), items.alias("_items"))
    return folded.select("batch_id", "n_rows", *[F.col("_items")[c].alias(c) for c in columns])


def collate_with(
    batches: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Fold each batch with a Python function over its rows in slot order."""

    def ordered(batch: pd.DataFrame) -> pd.DataFrame:
        return fold(batch.sort_values("slot"))

    return batches.groupBy("batch_id").applyInPandas(ordered, schema)


def transform_rows(
    df: DataFrame, transformer: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply a Python transformer to Arrow batches of rows."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield transformer(frame)

    return df.mapInPandas(apply, schema)

"""Time series of recorded counters: rates, trailing throughput, estimates, downsampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.operators.position import ROWS_PER_BLOCK
from assetlake.operators.scan import Running, running
from assetlake.operators.skew import lookup

# Seconds looked back on for a transfer rate (fixed value).
RATE_WINDOW = 20
# Buckets per chunk when a long key is split for the trailing window.
CHUNK = 4_096


def counter_rate(
    readings: DataFrame,
    keys: Sequence[str],
    seq: str,
    time: str,
    counter: str,
    limit: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rate of a nanosecond counter between consecutive readings, in ``seq`` order per key.

    A reading whose time did not advance is ignored and leaves the baseline where it is. A
    reading with counter or limit 0 gives no row but becomes the baseline. The baseline of a
    row is thus the first earlier reading with the largest time so far: a running maximum.
    """
    mark = F.struct(
        F.col(time).alias("t"), (-F.col(seq)).alias("first"), F.col(counter).alias("c")
    )
    base = running(
        readings, keys, [seq], [Running("_base", "max", mark, inclusive=False)], rows_per_block
    )
    span = F.col(time) - F.col("_base.t")
    used = (F.col(counter) - F.col("_base.c")) / span / F.lit(1_000_000_000.0)
    return base.filter(
        (span > 0) & (F.col(counter) != 0) & (F.col(limit) != 0)
    ).select(
        *keys,
        seq,
        time,
        F.bround(used, 4).alias("used"),
        F.bround(F.col(limit).cast("double"), 2).alias("allocated"),
    )


def per_bucket(df: DataFrame, keys: Sequence[str], bucket: str, units: str) -> DataFrame:
    return df.groupBy(*keys, bucket).agg(F.sum(units).alias("units"))


def trailing_rate(
    buckets: DataFrame, keys: Sequence[str], bucket: str, window: int = RATE_WINDOW
) -> DataFrame:
    """Mean ``units`` of the buckets with data among the ``window`` before each bucket.

    The bucket itself is excluded and the rate is 0 without data. The time line of a key is
    cut into chunks; the last ``window`` buckets of a chunk are copied into the next one.
    """
    span = max(CHUNK, window)
    own = F.floor(F.col(bucket) / span)
    reach = F.floor((F.col(bucket) + window) / span)
    spread = buckets.withColumn("_chunk", F.explode(F.array_distinct(F.array(own, reach))))
    frame = Window.partitionBy(*keys, "_chunk").orderBy(bucket).rangeBetween(-window, -1)
    n = F.count("units").over(frame)
    mean = F.sum("units").over(frame) / n
    rate = F.when(n > 0, F.bround(mean, 0)).otherwise(0).cast("long")
    return spread.withColumn("rate", rate).filter(F.col("_chunk") == own).drop("_chunk")


def transfer_eta(
    rates: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    bucket: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Remaining units divided by the rate; 0 where the rate is 0. ``totals`` holds ``total`` per key."""
    done = running(rates, keys, [bucket], [Running("done", "sum", F.col("units"))], rows_per_block)
    left = F.bround((F.col("total") - F.col("done")) / F.col("rate"), 0).cast("long")
    return lookup(done, totals, keys).withColumn("eta", F.when(F.col("rate") == 0, 0).otherwise(left))


def with_elapsed(df: DataFrame, keys: Sequence[str], time: Column, unit: float = 1.0) -> DataFrame:
    """Add ``elapsed``: time since the key's first row, in ``unit`` seconds; ``time`` in µs."""
    timed = df.withColumn("_us", time)
    starts = timed.groupBy(*keys).agg(
        F.min("_us").alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    elapsed = (F.col("_us") - F.col("_start")) / F.lit(unit * 1_000_000.0)
    joined = lookup(timed, starts, keys, weight="_rows")
    return joined.withColumn("elapsed", elapsed).drop("_us", "_start", "_rows")


def sampling_grid(elapsed: Column) -> Column:
    """Start of the sampling step: 1 below 15, 5 below 60, then 15."""
    coarse = F.lit(60) + F.floor((elapsed - 60) / 15) * 15
    middle = F.lit(15) + F.floor((elapsed - 15) / 5) * 5
    return F.when(elapsed < 15, F.floor(elapsed)).when(elapsed < 60, middle).otherwise(coarse).cast("long")


def adaptive_downsample(
    df: DataFrame, keys: Sequence[str], seq: str, values: Sequence[str]
) -> DataFrame:
    """The last row of every sampling step; ``df`` has ``elapsed``. The final row is always kept."""
    last = F.max_by(F.struct(seq, *values), F.col(seq))
    return (
        df.groupBy(*keys, sampling_grid(F.col("elapsed")).alias("step"))
        .agg(last.alias("_last"))
        .select(*keys, "step", "_last.*")
    )


def metric_series_long(df: DataFrame, keys: Sequence[str], metrics: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row per metric: ``metrics`` maps tag to (group tag, value); ``df`` has ``elapsed``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(group).alias("group_tag"), F.lit(tag).alias("tag"), value.cast("double").alias("value")
            )
            for tag, (group, value) in metrics.items()
        ]
    )
    return df.select(
        *keys,
        F.bround("elapsed", 0).cast("long").alias("x"),
        F.lit("TIME").alias("x_type"),
        F.lit("System").alias("category"),
        F.inline(entries),
    ).filter(F.col("value").isNotNull())

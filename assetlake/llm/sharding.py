"""Sharding by a two-pass external shuffle: scatter into memory-sized buckets, Fisher-Yates inside each, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import crc32_utf8, free_name, whole
from assetlake.session import cut_lineage

LAW = "rows"
BUCKET_ROWS = 20_000
BUCKET_BYTES = 32 << 20
SEED = 20_240_601


def shuffled(df: DataFrame, id_col: str, text_col: str, seed: int, rows: int, size: int) -> DataFrame:
    """Pass one and two: every row with its ``bucket`` and its ``place`` inside the bucket.

    A seeded hash of the id and the text scatters the rows uniformly, so a bucket holds about ``rows`` rows and
    ``size`` bytes at most, however skewed sources or copies are. ``shuffle`` is Spark's Fisher-Yates shuffle of an
    array; the array is sorted first and the buckets of a partition come in order, so that a repeated task gives
    the same permutation.
    """
    total = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(whole(text_col))).alias("bytes")
    ).first()
    buckets = max(1, -(-total["n"] // rows), -(-(total["bytes"] or 0) // size))
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    scattered = df.select(
        F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), crc32_utf8(text_col)).alias("_sh_key"),
        record.alias("_sh_row"),
    )
    bucket = F.pmod("_sh_key", F.lit(buckets)).alias("bucket")
    arrays = (
        scattered.select(bucket, F.struct(F.col("_sh_key").alias("key"), F.col("_sh_row").alias("row")).alias("item"))
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("item.key").alias("key"), F.col("item.row").alias("row")))).alias("items"))
        .sortWithinPartitions("bucket")
    )
    mixed = arrays.select("bucket", F.shuffle("items", seed).alias("items"))
    return mixed.select("bucket", F.posexplode("items").alias("place", "item")).select("bucket", "place", "item.row.*")


def shard(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows of ``df`` in random order, cut into ``shards`` shards whose row counts differ by one at most.

    Adds ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 within the shard). The order is bucket after
    bucket; a shard is a run of that order, so it is made of whole buckets but for its two ends and pass two can
    write it as it comes. Null ids and texts are ordinary values (null text: empty), equal rows are all placed,
    empty tables give no rows, and columns called ``shard`` or ``slot`` are replaced. All columns must be of
    orderable types.
    """
    clean = df.drop("shard", "slot")
    bucket, place = free_name(clean, "bucket"), free_name(clean, "place")
    renamed = clean.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(clean.columns)])
    index = {c: f"c{i}" for i, c in enumerate(clean.columns)}
    stored = cut_lineage(
        shuffled(renamed, index[id_col], index[text_col], seed, bucket_rows, bucket_bytes), "shard-buckets"
    )
    sizes = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    running = "sum(n) over (order by bucket rows between unbounded preceding and 1 preceding)"
    starts = sizes.select("bucket", F.coalesce(F.expr(running), F.lit(0)).alias("start"), F.expr("sum(n) over ()").alias("total"))
    placed = stored.join(starts, "bucket").withColumn("position", F.col("start") + F.col("place"))
    number = F.expr(f"(position * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    out = placed.withColumn("shard", number).withColumn("slot", (F.col("position") - first).cast("long"))
    return out.select(
        *[F.col(index[c]).alias(c) for c in clean.columns], F.col("shard").cast("int").alias("shard"), "slot"
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

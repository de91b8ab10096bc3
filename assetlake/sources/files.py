"""File listings, partition manifests, cache plans and admission checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.operators.metadata import path_type, suffix
from assetlake.operators.skew import lookup

# Size limits in bytes per type of file, in decimal megabytes (fixed values).
SIZE_LIMITS = {"IMAGE": 1_000_000, "VIDEO": 100_000_000, "FILE": 100_000_000, "DIRECTORY": 100_000_000}


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, length, modified)`` of a file, or of all files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def partition_manifest(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``(location, format, n_rows, length, checksum)`` per file; any file that is not Parquet is an error.

    The files are listed and their formats checked before one is opened. The checksum covers the schema and the rows
    of a file in any order: row hashes, which include which values are null, are summed and xor-ed, so large files are
    read split by split and none is held in memory whole.
    """
    listed = reduce(DataFrame.unionAll, [list_files(spark, p) for p in paths])
    formats = listed.select(F.ltrim(suffix(F.col("path")), F.lit(".")).alias("format"))
    require_parquet(formats.distinct()).count()
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    names = list(columns or df.columns)
    row = F.xxhash64(*[part for n in names for part in (F.col(f"`{n}`").isNull(), F.col(f"`{n}`"))])
    digest = F.concat(
        F.lit(df.select(*[f"`{n}`" for n in names]).schema.simpleString()),
        F.lpad(F.hex(F.bit_xor(row)), 16, "0"),
        F.hex(F.sum(F.pmod(row, F.lit(2**31)))),
        F.hex(F.count(F.lit(1))),
    )
    location = F.col("_metadata.file_path")
    return df.groupBy(location.alias("location"), F.col("_metadata.file_size").alias("length")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.md5(digest).alias("checksum")
    ).select(
        "location", F.ltrim(suffix(F.col("location")), F.lit(".")).alias("format"), "n_rows", "length", "checksum"
    )


def require_parquet(manifest: DataFrame) -> DataFrame:
    """The manifest itself; whatever reads it fails at the first partition of another format."""
    message = F.concat(F.lit("Unsupported partition format: "), F.coalesce(F.col("format"), F.lit("none")))
    refused = F.raise_error(message).cast("boolean")
    # A filter, unlike a column, is evaluated whichever columns are used later.
    return manifest.filter(F.when(F.col("format").eqNullSafe("parquet"), F.lit(True)).otherwise(refused))


def cache_plan(
    manifest: DataFrame, cache: DataFrame, order: str, no_cache: bool = False
) -> DataFrame:
    """Where each partition comes from: ``cache``, ``fetch`` (and keep) or ``remote``.

    Partitions without a checksum are always remote. Of several with the same unknown
    checksum, the first in ``order`` is fetched and the others then come from the cache.
    """
    manifest = require_parquet(manifest)
    if no_cache:
        return manifest.withColumn("action", F.lit("remote"))
    known = F.coalesce(F.col("checksum"), F.lit("")) != ""
    stored = cache.select("checksum").distinct().withColumn("_cached", F.lit(True))
    # Rows without a checksum are groups like others here, so the lookup knows how many there are.
    decided = (
        manifest.groupBy("checksum")
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .join(stored, "checksum", "left")
    )
    hit = F.col("_cached").isNotNull() | (F.col(order) != F.col("_first"))
    planned = lookup(manifest, decided, ["checksum"], weight="_n")
    action = F.when(~known, "remote").when(hit, "cache").otherwise("fetch")
    return planned.withColumn("action", action).drop("_first", "_n", "_cached")


def admit(path: Column, size: Column) -> Column:
    """Struct of the file's type, its size limit and whether its size is allowed."""
    kind = path_type(path)
    limits = F.create_map(*[F.lit(v) for pair in SIZE_LIMITS.items() for v in pair])
    limit = limits[kind]
    return F.struct(kind.alias("type"), limit.alias("size_limit"), (size <= limit).alias("admitted"))

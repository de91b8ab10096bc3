"""Profiles of opaque and tensor columns, byte sizes and content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.operators.position import ROWS_PER_BLOCK, positioned

#: Children of a node of a fingerprint's hash tree; part of its definition.
ARITY = 256

# Bytes per element of a fixed-width type (fixed values).
ELEMENT_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}
DTYPES = {
    "boolean": "bool",
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
}


def digest(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def describe_opaque(df: DataFrame, column: str) -> DataFrame:
    """Count, distinct contents, most frequent content hash and its frequency; nulls skipped."""
    groups = (
        df.filter(F.col(column).isNotNull())
        .groupBy(digest(column).alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col("digest")))
    return groups.agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"),
        best["digest"].alias("top"),
    )


def _leaf(data_type: T.DataType) -> T.DataType:
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    return data_type


def _elements(column: Column, data_type: T.DataType) -> Column:
    """Number of leaf elements of an array of any nesting."""
    inner = data_type.elementType
    if not isinstance(inner, T.ArrayType):
        return F.size(column).cast("long")
    return F.aggregate(
        column, F.lit(0).cast("long"), lambda total, part: total + _elements(part, inner)
    )


def column_bytes(df: DataFrame, column: str) -> DataFrame:
    """Encoded bytes of a string or binary column, raw element bytes of an array column."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.ArrayType):
        width = ELEMENT_BYTES[_leaf(data_type).simpleString()]
        size = F.when(F.col(column).isNotNull(), _elements(F.col(column), data_type) * width)
    else:
        size = F.octet_length(column)
    total = F.coalesce(F.sum(size), F.lit(0)).cast("long")
    return df.agg(total.alias("n_bytes")).select(F.lit(column).alias("column"), "n_bytes")


def _shape(column: Column, data_type: T.DataType) -> list[Column]:
    if not isinstance(data_type, T.ArrayType):
        return []
    return [F.size(column)] + _shape(F.get(column, F.lit(0)), data_type.elementType)


def _flat(column: Column, data_type: T.DataType) -> Column:
    while isinstance(data_type.elementType, T.ArrayType):
        column, data_type = F.flatten(column), data_type.elementType
    return column


def as_tensor(df: DataFrame, column: str) -> DataFrame:
    """Turn a (nested) array column into ``struct<shape, dtype, data>``; data is row-major."""
    data_type = df.schema[column].dataType
    leaf = _leaf(data_type).simpleString()
    value = F.col(column)
    tensor = F.struct(
        F.array(*_shape(value, data_type)).alias("shape"),
        F.lit(DTYPES[leaf]).alias("dtype"),
        _flat(value, data_type).cast("array<double>").alias("data"),
    )
    return df.withColumn(column, F.when(value.isNotNull(), tensor))


def tensor_shapes(df: DataFrame, column: str) -> DataFrame:
    """Row count per shape and dtype; one row means the column is uniform."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(f"{column}.shape").alias("shape"), F.col(f"{column}.dtype").alias("dtype"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def tensor_stats(df: DataFrame, column: str, key: str) -> DataFrame:
    """Shape, smallest, largest and mean element of every tensor."""
    data = F.col(f"{column}.data")
    total = F.aggregate(data, F.lit(0.0), lambda a, x: a + x)
    return df.select(
        key,
        F.col(f"{column}.shape").alias("shape"),
        F.round(F.array_min(data), 6).alias("low"),
        F.round(F.array_max(data), 6).alias("high"),
        F.round(total / F.size(data), 6).alias("mean"),
    )


def fingerprint(
    df: DataFrame, order: Sequence[str], column: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """One sha256 for the whole column in ``order``: the root of a hash tree of arity ``ARITY``.

    The leaves are the row digests (empty for null) in order. A node is the sha256 of its children joined in order;
    there is at least one level of nodes, and levels until one node is left. The digest depends on the values and
    their order only, and no group holds more than ``ARITY`` digests.
    """
    keyed = df.select(*order, F.coalesce(digest(column), F.lit("")).alias("_h"))
    total, items = positioned(keyed, order, "_i", rows_per_block)
    if total == 0:
        empty = F.sha2(F.lit("").cast("binary"), 256)
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_rows"), empty.alias("digest"))
    items, remaining, first = items.select("_i", "_h"), total, True
    while remaining > 1 or first:
        run = F.array_sort(F.collect_list(F.struct("_i", "_h")))
        text = F.array_join(F.transform(run, lambda r: r["_h"]), "")
        items = (
            items.withColumn("_g", F.expr(f"_i div {ARITY}"))
            .groupBy("_g")
            .agg(F.sha2(text.cast("binary"), 256).alias("_h"))
            .select(F.col("_g").alias("_i"), "_h")
        )
        remaining, first = -(-remaining // ARITY), False
    return items.select(F.lit(total).cast("long").alias("n_rows"), F.col("_h").alias("digest"))

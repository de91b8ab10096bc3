"""Global row order without a global sort in one task.

Rows have no order of their own, so every operator here takes a total order key. A table is stored once in the order of
its key, as range-partitioned and sorted files, with an index of the first position and the number of rows of every
file. A row's position is then its file's first position plus the row's place in the file, which the scan tells: no
window and no shuffle, and a slice opens only the files it touches. A build that was written in order answers any number
of slices without another write. The index has one row per file and is joined, never collected whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetlake.operators.skew import lookup
from assetlake.session import cut_lineage, shared_dir

ROWS_PER_BLOCK = 100_000


def in_blocks(
    df: DataFrame, order: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK
) -> tuple[int, DataFrame]:
    """Row count of ``df``, and its stored rows with ``_block``, which ascends with the order key."""
    total = df.count()
    ranged = df.repartitionByRange(max(1, -(-total // rows_per_block)), *order)
    return total, cut_lineage(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


#: Below the folder of an ordered table; scans of the folder pass it over.
INDEX = "_index"


def write_ordered(df: DataFrame, order: Sequence[str], path: str, rows_per_block: int = ROWS_PER_BLOCK) -> None:
    """Write ``df`` to the new folder ``path`` in ascending order of ``order``, with the index of its files.

    Files hold about ``rows_per_block`` rows. The index numbers the files in one task, a row each: a million rows for
    10^11 rows of data.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(max(1, -(-df.count() // rows_per_block)), *order)
    ranged.sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
    index = files.agg(F.count(F.lit(1)).alias("n"))  # reads the footers only; file names ascend with the partitions
    index = index.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n")
    index.write.parquet(f"{path}/{INDEX}")


class OrderedTable:
    """A table that :func:`write_ordered` has stored; every answer is a scan of the files that hold it."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.index = spark.read.schema("file string, first long, n long").parquet(f"{path}/{INDEX}")
        self.total: int = self.index.agg(F.max(F.col("first") + F.col("n"))).first()[0] or 0

    def rows(self, name: str = "idx", files: Sequence[str] | None = None) -> DataFrame:
        """All rows, or those of the given files, with their 0-based position in a column ``name``."""
        paths = [self.path] if files is None else [f"{self.path}/{f}" for f in files]
        read = self.spark.read.schema(self.schema).parquet(*paths)
        place = F.struct("_metadata.file_name", "_metadata.row_index")
        held = read.select("*", place.alias("_place"))
        placed = held.join(self.index, F.col("_place.file_name") == F.col("file"))
        columns = [F.col(f"`{c}`") for c in self.schema.names]
        return placed.select(*columns, (F.col("first") + F.col("_place.row_index")).alias(name))

    def _within(self, wanted: range) -> DataFrame:
        if len(wanted) == 0:
            return self.spark.createDataFrame([], self.schema).withColumn("pos", F.lit(0).cast("long"))
        low, high = min(wanted[0], wanted[-1]), max(wanted[0], wanted[-1])
        touched = self.index.filter((F.col("first") <= high) & (F.col("first") + F.col("n") > low))
        whole = low == 0 and high == self.total - 1
        files = None if whole else [r["file"] for r in touched.select("file").collect()]
        idx = F.col("_idx")
        return (
            self.rows("_idx", files)
            .filter(idx.between(low, high) & ((idx - low) % abs(wanted.step) == 0))
            .withColumn("pos", ((idx - wanted[0]) / F.lit(wanted.step)).cast("long"))
            .drop("_idx")
        )

    def slice(self, start: int | None = None, stop: int | None = None, step: int | None = None) -> DataFrame:
        """Rows ``start:stop:step`` with Python's clamping rules; ``pos`` numbers the output."""
        return self._within(range(*slice(start, stop, step).indices(self.total)))

    def at(self, index: int) -> DataFrame:
        """The row at ``index``; a negative index counts from the end."""
        if isinstance(index, bool) or not isinstance(index, int):
            raise TypeError("row position must be an integer")
        at = index + self.total if index < 0 else index
        if not 0 <= at < self.total:
            raise IndexError(f"row position {index} is out of range for {self.total} rows")
        return self._within(range(at, at + 1)).drop("pos")

    def head(self, n: int = 5) -> DataFrame:
        """First ``n`` rows; a negative ``n`` gives all but the last ``|n|``."""
        return self.slice(None, n).drop("pos")


def ordered(df: DataFrame, order: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> OrderedTable:
    """``df`` stored in order in the shared folder."""
    path = shared_dir(df.sparkSession, "ordered")
    write_ordered(df, order, path, rows_per_block)
    return OrderedTable(df.sparkSession, path, df.schema)


def with_position(
    df: DataFrame,
    order: Sequence[str],
    name: str = "idx",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add the 0-based position of every row under the total order ``order``."""
    return positioned(df, order, name, rows_per_block)[1]


def positioned(
    df: DataFrame, order: Sequence[str], name: str = "idx", rows_per_block: int = ROWS_PER_BLOCK
) -> tuple[int, DataFrame]:
    """Row count of ``df``, and its rows with their positions."""
    table = ordered(df, order, rows_per_block)
    return table.total, table.rows(name)


def row_slice(
    df: DataFrame,
    order: Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """:meth:`OrderedTable.slice` of a table that is not stored in order yet."""
    return ordered(df, order, rows_per_block).slice(start, stop, step)


def row_at(
    df: DataFrame, order: Sequence[str], index: int, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """:meth:`OrderedTable.at` of a table that is not stored in order yet."""
    if isinstance(index, bool) or not isinstance(index, int):
        raise TypeError("row position must be an integer")
    return ordered(df, order, rows_per_block).at(index)


def head(df: DataFrame, order: Sequence[str], n: int = 5, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """:meth:`OrderedTable.head` of a table that is not stored in order yet."""
    return ordered(df, order, rows_per_block).head(n)


def positional_equals(
    left: DataFrame,
    right: DataFrame,
    column: str,
    left_order: Sequence[str],
    right_order: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``(idx, equal)`` for every row of ``left``; false beyond the end of ``right``."""
    if left.schema[column].dataType != right.schema[column].dataType:
        return with_position(left, left_order, rows_per_block=rows_per_block).select(
            "idx", F.lit(False).alias("equal")
        )

    def digests(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
        digest = F.struct(F.sha2(F.col(column).cast("binary"), 256).alias("sha")).alias(name)
        keyed = df.select(*order, digest)
        return with_position(keyed, order, rows_per_block=rows_per_block).select("idx", name)

    pair = digests(left, left_order, "_l").join(digests(right, right_order, "_r"), "idx", "left")
    same = F.col("_r").isNotNull() & F.col("_l.sha").eqNullSafe(F.col("_r.sha"))
    return pair.select("idx", same.alias("equal"))


def resolved_position(index: Column, total: int) -> Column:
    """A position within ``total`` rows; a negative one counts from the end, any other outside is an error."""
    at = F.when(index < 0, index + total).otherwise(index)
    message = F.concat(F.lit("row position "), F.coalesce(index.cast("string"), F.lit("null")), F.lit(f" is out of range for {total} rows"))
    return F.when((at >= 0) & (at < total), at).otherwise(F.raise_error(message).cast("long"))


def take_positions(
    df: DataFrame,
    order: Sequence[str],
    positions: DataFrame,
    index: str = "idx",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rows of ``df`` for a table of positions, in which positions may repeat and count from the end."""
    total, placed = positioned(df, order, index, rows_per_block)
    at = resolved_position(F.col(index).cast("long"), total)
    # A left join: were a position without a row, the row would still be there, without values.
    return lookup(positions.withColumn(index, at), placed, [index], how="left")

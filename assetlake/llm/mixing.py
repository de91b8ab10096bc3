"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.common import attach, crc32_utf8, free_name, word_count
from assetlake.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
ROWS_PER_BLOCK = 4_000
SEED = "mix-1/"
#: Relative weight of a source over the run, as (time, weight) knots joined by straight lines; sources take the
#: schedules in turn, as they take the weights. The integral of a schedule is scaled to the source's taken words.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)), ((0.0, 0.25), (1.0, 1.75)))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``turn`` and ``target`` to a table of one row per source (``source``, ``source_size``).

    A target is the source's share of the total by weight, ``most`` times its size at most; what capped sources
    leave is shared again by weight. With the sources in the order of cap over weight, the common level of the open
    ones rises while the next source is capped and falls after, so it is the largest of the levels at all cuts.
    The windows run over one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)
    order = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    used = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        sizes.withColumn("turn", turn)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("left", (F.sum("source_size").over(every) - used).cast("double"))
        .withColumn("level", F.col("left") / open_weight)
        .withColumn("target", F.least(F.col("cap").cast("double"), F.max("level").over(every) * F.col("weight")))
        .drop("weight", "cap", "left", "level")
    )


def inverse_demand(u: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the schedule's integral reaches the share ``u`` of its whole."""
    whole_area = sum((t1 - t0) * (m0 + m1) / 2 for (t0, m0), (t1, m1) in zip(knots, knots[1:]))
    area, out = 0.0, F.lit(float(knots[-1][0]))
    steps = []
    for (t0, m0), (t1, m1) in zip(knots, knots[1:]):
        start, m0, m1 = area, m0 / whole_area, m1 / whole_area
        area += (t1 - t0) * (m0 + m1) / 2
        rest = F.greatest(u - start, F.lit(0.0))
        slope = (m1 - m0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(m0 * m0) + rest * (2 * slope), F.lit(0.0)))
        steps.append((area, F.lit(t0) + rest * 2 / F.greatest(root + m0, F.lit(1e-12))))
    for end, value in reversed(steps):
        out = F.when(u <= end, value).otherwise(out)
    return out


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] | None = None,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_REPEATS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``), ``source_size``, ``target``, ``size``, ``copies``,
    ``taken``, ``before``, ``source_taken`` and ``turn``.

    A document's size is its number of words (null text: 0). Each source reads all its documents
    ``floor(target / source_size)`` times, and once more those at the front of a seeded order whose middle lies
    within the rest, so the words taken miss the target by half a document at most. The order is cut into blocks by
    its hash, as many as the source's rows ask for; running sums are taken per block and over the block totals, so a
    source of any size is spread over many tasks. A null source is a source, the last one by name. Null and repeated
    ids are ordinary rows, ordered by size and checksum after the id's hash; documents without words are never
    taken. An empty table gives no rows.
    """
    carry = list(docs.columns if carry is None else carry)
    order = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(source_col).alias("source"),
        F.concat(F.when(F.col(source_col).isNull(), "n").otherwise("s"), F.coalesce(source_col, F.lit(""))).alias("key"),
        word_count(text_col).alias("size"),
        order.alias("order"),
        crc32_utf8(text_col).alias("crc"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
    )
    sizes = cut_lineage(
        rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "mix-sizes"
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per_source = cut_lineage(
        targets(sizes, weights, most)
        .withColumn("full", full.cast("long"))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
        .withColumn("blocks", F.ceil(F.col("n") / F.lit(rows_per_block)))
        .drop("source"),
        "mix-targets",
    )
    known = attach(rows.drop("source"), per_source, ["key"], "n", "inner")
    first_bits = F.conv(F.substring("order", 1, 7), 16, 10).cast("long")
    blocked = known.withColumn("block", F.shiftright(first_bits * F.col("blocks"), 28))
    totals = blocked.groupBy("key", "block").agg(F.sum("size").alias("block_size"))
    onward = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("key", "block", F.coalesce(F.sum("block_size").over(onward), F.lit(0)).alias("start"))
    inside = Window.partitionBy("key", "block").orderBy("order", "size", "crc")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = blocked.withColumn("within", before).join(cut_lineage(starts, "mix-blocks"), ["key", "block"])
    extra = (F.col("size") > 0) & (F.col("before") * 2 + F.col("size") <= F.col("rest") * 2)
    return (
        summed.withColumn("before", F.col("start") + F.col("within"))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("full")).otherwise(0) + F.when(extra, 1).otherwise(0))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("row", "size", "source_size", "target", "copies", "taken", "before", "turn")
    )


def positions(planned: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """One row per copy of each taken document, with ``copy`` and the training ``position`` from 0 to 1.

    Words of a source that come before a copy, over the source's target, are its demand; the position is where the
    integral of the source's schedule reaches that demand.
    """
    copies = planned.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    demand = (F.col("copy") * F.col("source_size") + F.col("before")) / F.col("target")
    time = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        time = F.when(F.pmod("turn", F.lit(len(schedules))) == k, inverse_demand(demand, knots)).otherwise(time)
    return copies.withColumn("position", F.least(time, F.lit(1.0)))


def mix_plan(planned: DataFrame) -> DataFrame:
    """The documents of :func:`plan_mix` in training order, with ``copies`` and ``taken`` counted from the copies
    placed by :func:`positions` and ``places``, the sorted positions of a document's copies (null if it has none).

    Documents are range-sorted by the position of their first copy; those that are never taken come last.
    """
    stored = cut_lineage(planned.withColumn("_mp_row", F.monotonically_increasing_id()), "mix-plan")
    placed = positions(stored).groupBy("_mp_row").agg(F.sort_array(F.collect_list("position")).alias("places"))
    joined = stored.drop("copies", "taken").join(placed, "_mp_row", "left")
    counted = joined.withColumn("copies", F.coalesce(F.array_size("places"), F.lit(0)).cast("long"))
    taken = counted.withColumn("taken", F.col("copies") * F.col("size"))
    # The row's number spreads the documents without a place over the ranges.
    return taken.orderBy(F.col("places").getItem(0).asc_nulls_last(), "_mp_row").drop("_mp_row")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: every taken copy of a document with all its columns, range-sorted by training position.

    See :func:`plan_mix` for the rules. The column added is ``position`` (underscores in front if taken).
    """
    name = free_name(docs, "position")
    placed = positions(plan_mix(docs, id_col, text_col, source_col))
    return placed.orderBy("position").select("row.*", F.col("position").alias(name))

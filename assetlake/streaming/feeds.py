"""Structured Streaming jobs: log tail, metric sink, live rates, status folding, streaming suites.

Sinks that run per micro-batch write to a folder named after the batch and replace it, so a
batch that is retried after a failure leaves the same result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetlake.operators import catalog, metadata, quality, series
from assetlake.operators.series import RATE_WINDOW
from assetlake.session import shared_dir
from assetlake.streaming import keyed

# Poll and waiting times in seconds (fixed values).
POLL_SECONDS = 3
GRACE_SECONDS = 20
DRAIN_SECONDS = 300


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the Parquet files at ``path``, in order of their modification.

    A stream takes a folder or a pattern; the last letter in brackets makes a pattern that
    matches exactly ``path``, whether that is a folder or one file.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _writer(stream: DataFrame, checkpoint: str, follow: bool):
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if follow:
        return writer.trigger(processingTime=f"{POLL_SECONDS} seconds")
    return writer.trigger(availableNow=True)


def drain(query: StreamingQuery, timeout: float | None = None) -> str | None:
    """Wait for a bounded query to end; with a ``timeout`` (``DRAIN_SECONDS``, say) it is stopped after that
    and the warning text tells so."""
    if timeout is None:
        query.awaitTermination()
        return None
    if query.awaitTermination(timeout):
        return None
    query.stop()
    return f"not everything was written within {timeout:.0f} seconds"


def tail(lines: DataFrame, sink: str, checkpoint: str, follow: bool = False) -> StreamingQuery:
    """Append rendered log lines to ``sink``; the checkpoint remembers how far it has read."""
    return _writer(lines, checkpoint, follow).format("parquet").option("path", sink).start()


def follow_until(query: StreamingQuery, done: Callable[[], bool], grace: float = GRACE_SECONDS) -> None:
    """Let a following query run until ``done()``, then read on for the grace period and stop."""
    while query.isActive and not done():
        time.sleep(POLL_SECONDS)
    time.sleep(grace)
    query.processAllAvailable()
    query.stop()


def log_sink(calls: DataFrame, keep: Sequence[str], sink: str, checkpoint: str, follow: bool = False) -> StreamingQuery:
    """Type logged values and append them; bad rows land in ``status=error``, never raise."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the typing reads it once per level of nesting
        typed = metadata.type_log_rows(batch, keep)
        status = F.when(F.col("error").isNull(), "ok").otherwise("error")
        typed.withColumn("status", status).write.mode("overwrite").partitionBy("status").parquet(f"{sink}/batch={batch_id}")
        batch.unpersist()

    return _writer(calls, checkpoint, follow).foreachBatch(write).start()


def _types(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def counter_rates(
    readings: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    sink: str,
    checkpoint: str,
    follow: bool = False,
    ttl: float | None = None,
) -> StreamingQuery:
    """Counter rates per micro-batch, with each key's baseline and first time kept as keyed state.

    A batch reads and writes the state of its own keys only. A key without a reading for ``ttl`` seconds leaves the state:
    its next reading is a new baseline. The new readings of one key are ordered in memory, so bound a batch by
    ``files_per_batch`` where one key may have very many. ``x`` (elapsed seconds) and ``step`` (the sampling step) follow
    from the first time. ``columns`` names ``seq``, ``time``, ``counter`` and ``limit``.
    """
    seq, time_, counter, limit = (columns[c] for c in ("seq", "time", "counter", "limit"))
    rows = readings.filter(F.col(time_).isNotNull()).select(
        *keys,
        F.col(seq).alias("seq"),
        F.col(time_).alias("t"),
        F.coalesce(F.col(counter), F.lit(0)).alias("c"),
        F.col(counter).isNull().alias("unknown"),
        F.col(limit).cast("double").alias("lim"),
    )
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("seq", "t", "c")}
    given = f"{_types(rows, keys)}, seq {kinds['seq']}, t {kinds['t']}, change {kinds['c']}, span {kinds['t']}, lim double, start {kinds['t']}"
    changes = keyed.with_state(rows, keys, keyed.Baselines(keys, kinds, ttl), given)
    used = F.col("change") / F.col("span") / F.lit(1_000_000_000.0)
    elapsed = F.col("t") - F.col("start")
    rates = changes.select(
        *keys,
        F.col("seq").alias(seq),
        F.col("t").alias(time_),
        F.bround(used, 4).alias("used"),
        F.bround("lim", 2).alias("allocated"),
        F.bround(elapsed, 0).cast("long").alias("x"),
        series.sampling_grid(elapsed).alias("step"),
    )
    return _start_per_batch(rates, sink, checkpoint, follow, state=True)


def _start_per_batch(stream: DataFrame, sink: str, checkpoint: str, follow: bool, state: bool = False) -> StreamingQuery:
    """Start a query in update mode that writes each batch to its own folder of ``sink``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = _writer(stream, checkpoint, follow).outputMode("update").foreachBatch(write)
    return keyed.start_with_state(stream, writer.start) if state else writer.start()


def sampled_rates(spark: SparkSession, sink: str, keys: Sequence[str], seq: str) -> DataFrame:
    """The last written rate per key and sampling step."""
    written = spark.read.parquet(sink).drop("batch")
    values = [c for c in written.columns if c not in (*keys, "step")]
    return catalog.last_by(written, [*keys, "step"], [seq], values)


def fold_statuses(
    history: DataFrame,
    keys: Sequence[str],
    seq: str,
    sink: str,
    checkpoint: str,
    follow: bool = False,
    ttl: float | None = None,
) -> StreamingQuery:
    """Outcome per run as its history arrives: the first decision of a run is keyed state, updated rows per batch.

    Without a time to live the state is that of an aggregate. With one, a run that had no decision event for ``ttl``
    seconds leaves the state. :func:`current_outcomes` takes the first decision ever written, so events that arrive after
    that change nothing.
    """
    rows = history.select(*keys, F.col(seq).alias("seq"), catalog.decision().alias("outcome"), "info")
    if ttl is None:
        decided = F.struct(F.col("seq").isNull(), "seq", "outcome", "info")
        folded = rows.groupBy(*keys).agg(F.min(F.when(F.col("outcome").isNotNull(), decided)).alias("_first"))
        first = folded.select(*keys, "_first.seq", "_first.outcome", "_first.info")
    else:
        kind = rows.schema["seq"].dataType.simpleString()
        given = f"{_types(rows, keys)}, seq {kind}, outcome string, info string"
        first = keyed.with_state(rows, keys, keyed.FirstDecision(keys, kind, ttl), given)
    return _start_per_batch(first, sink, checkpoint, follow, state=True)


def current_outcomes(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """The outcome per run of all that was written: its first decision by ``seq``."""
    written = spark.read.parquet(sink)
    first = F.min(F.when(F.col("outcome").isNotNull(), F.struct("seq", "outcome", "info")))
    return catalog.folded(written.groupBy(*keys).agg(first.alias("_first")), keys)


def live_rate(
    events: DataFrame,
    keys: Sequence[str],
    time_: str,
    units: str,
    lateness: str,
    bucket: str = "1 second",
    window: int = RATE_WINDOW,
) -> DataFrame:
    """Trailing rate per bucket as a stream: the mean over the buckets of each sliding window that have units.

    A window that ends where a bucket starts holds exactly the ``window`` buckets before it, so the current bucket is
    left out. One aggregate keeps, per key and stretch of twice ``window`` buckets, each bucket's sum and a bit for it;
    stretches start ``window`` buckets apart, so an event is in two of them, and each gives the windows that end in its
    second half. Written in update mode (:func:`updated_rows`) a window's rate is there from its first event on, also where
    the input ends before the window does; stretches older than the watermark leave the state.
    """
    if not 0 < window < 64:
        raise ValueError("a window has 1 to 63 buckets")
    size, unit = bucket.split()
    stretch = F.window(time_, f"{int(size) * window * 2} {unit}", f"{int(size) * window} {unit}").alias("_w")
    start, end = (F.unix_micros(F.col(f"_w.{c}")) for c in ("start", "end"))
    place = F.floor((F.unix_micros(F.col(time_)) - start) * (2 * window) / (end - start)).cast("int")
    spread = events.withWatermark(time_, lateness).select(*keys, F.col(units).alias("_units"), time_, stretch)
    seen = spread.select(*keys, "_units", "_w", place.alias("_place"))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def bits(first: int) -> Column:
        inside = F.col("_place").between(first, first + window - 1)
        return F.bit_or(F.when(inside, F.call_function("shiftleft", one, F.col("_place") - first)).otherwise(zero))

    sums = [F.sum(F.when(F.col("_place") == i, F.col("_units"))).alias(f"_s{i}") for i in range(2 * window)]
    summed = seen.groupBy("_w", *keys).agg(bits(0).alias("_early"), bits(window).alias("_late"), *sums)

    kind = summed.schema["_s0"].dataType

    def rate(k: Column) -> Column:
        """The rate of the window that ends ``k`` buckets after the middle of the stretch."""
        total = F.aggregate(F.slice("_sums", k + 1, window), F.lit(None).cast(kind), lambda a, x: F.coalesce(a + x, a, x))
        early = F.call_function("shiftrightunsigned", F.col("_early"), k)
        late = F.col("_late").bitwiseAND(F.call_function("shiftleft", one, k) - 1)
        n = F.bit_count(early) + F.bit_count(late)
        at = F.timestamp_micros((start + F.floor((end - start) * (k + window) / (2 * window))).cast("long"))
        return F.struct(n.alias("n"), at.alias("at"), F.bround(total / n, 0).cast("long").alias("rate"))

    rates = F.filter(F.transform(F.sequence(F.lit(0), F.lit(window - 1)), rate), lambda r: r["n"] > 0)
    held = summed.select(*keys, "_w", "_early", "_late", F.array(*[F.col(f"_s{i}") for i in range(2 * window)]).alias("_sums"))
    return held.select(*keys, F.inline(rates)).drop("n")


def updated_rows(stream: DataFrame, sink: str, checkpoint: str, follow: bool = False) -> StreamingQuery:
    """Write the rows that a running aggregate changes, batch by batch; :func:`last_written` reads the result."""
    return _start_per_batch(stream, sink, checkpoint, follow, state=True)


def last_written(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Of each key the row of the last batch that wrote it."""
    written = spark.read.parquet(sink)
    values = [c for c in written.columns if c not in (*keys, "batch")]
    return written.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in values])


def checked_sink(
    stream: DataFrame,
    rules: Sequence[quality.Rule],
    good: str,
    quarantine: str,
    reports: str,
    checkpoint: str,
    follow: bool = False,
) -> StreamingQuery:
    """Run a suite on every micro-batch; a passing one is published to ``good``, a failing one to ``quarantine``.

    The batch is written once to a staging folder, which the next batch replaces, and checked there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{checkpoint}-staging"
        batch.write.mode("overwrite").parquet(staged)
        stored = spark.read.schema(batch.schema).parquet(staged)
        report = quality.evaluated_report(stored, rules)
        report.coalesce(1).write.mode("overwrite").parquet(f"{reports}/batch={batch_id}")
        target = good if report.filter(~F.col("passed")).isEmpty() else quarantine
        stored.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return _writer(stream, checkpoint, follow).foreachBatch(write).start()


def run_to_end(spark: SparkSession, purpose: str, start: Callable[[str], StreamingQuery]) -> str:
    """Start a bounded query below a new shared folder, wait for it and return the folder."""
    root = shared_dir(spark, purpose)
    query = start(root)
    query.awaitTermination()
    return root

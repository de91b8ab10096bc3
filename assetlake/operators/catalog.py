"""Build, train and run catalogs: append-only event tables and what is current in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions import refs, status, text
from assetlake.operators.skew import lookup


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of the last row per key in ``order``; combined before the shuffle."""
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last = F.max_by(F.struct(*values), rank)
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def registry_latest(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Current registration per key: later registrations replace earlier ones."""
    values = [c for c in df.columns if c not in keys]
    return last_by(df, keys, [seq], values)


def build_status(events: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Current state of each build; failure text is cut to the stored limit.

    ``events`` has ``status`` (code), ``location`` and ``info``.
    """
    state = last_by(events, keys, [seq], ["status", "location", "info"])
    name = status.status_name(F.col("status"), status.BUILD_STATUSES)
    failed, done = name == "FAILED", name == "COMPLETED"
    info = F.concat(F.lit("Dataset build failed with "), F.col("info"))
    return state.select(
        *keys,
        name.alias("status"),
        F.when(done, F.col("location")).alias("location"),
        F.when(failed, text.failure_info(info)).alias("info"),
    )


def train_status(events: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Current state of each train, with its version and JSON failure report."""
    state = last_by(events, keys, [seq], ["status", "version", "message"])
    name = status.status_name(F.col("status"), status.TRAIN_STATUSES)
    report = text.status_report("Generic", F.col("message"))
    return state.select(
        *keys,
        name.alias("status"),
        "version",
        F.when(name == "FAILED", report).alias("report"),
    )


def run_outcome(df: DataFrame, keys: Sequence[str], error: Column) -> DataFrame:
    """FAILED if any error was recorded for the run, else SUCCEEDED."""
    errors = F.count(F.when(error, 1))
    return df.groupBy(*keys).agg(
        errors.alias("errors"), F.when(errors > 0, "FAILED").otherwise("SUCCEEDED").alias("status")
    )


def decision() -> Column:
    """What an event of a run's history decides; null for the others."""
    run, task, state = F.col("source") == "run", F.col("source") == "task", F.col("status")
    return (
        F.when(run & state.isin("TERMINATED", "FAILED", "SUCCEEDED"), state)
        .when(task & (state == "FAILED"), "FAILED")
    )


def fold_columns(seq: str) -> list[Column]:
    """Aggregates that give the first deciding event of a run; the others are left out."""
    first = F.min(F.when(decision().isNotNull(), F.struct(F.col(seq).alias("seq"), decision().alias("outcome"), "info")))
    return [first.alias("_first")]


def folded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    outcome = F.coalesce(F.col("_first.outcome"), F.lit("RUNNING"))
    tracked = F.when(outcome == "SUCCEEDED", "done").when(outcome == "RUNNING", "building").otherwise("error")
    return df.select(
        *keys,
        outcome.alias("outcome"),
        F.when(outcome != "SUCCEEDED", F.col("_first.info")).alias("info"),
        status.is_running(tracked).alias("is_running"),
        status.is_finished(tracked).alias("is_finished"),
    )


def fold_status(history: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Outcome of each run from its history: the first deciding event counts.

    ``history`` has ``source`` (``run`` or ``task``), ``status`` and ``info``.
    """
    return folded(history.groupBy(*keys).agg(*fold_columns(seq)), keys)


def status_with_metadata(
    tasks: DataFrame, metadata: DataFrame, keys: Sequence[str], seq: str
) -> DataFrame:
    """Task rows with the last metadata value of their key, null where there is none."""
    current = last_by(metadata, keys, [seq], ["value"])
    return lookup(tasks, current, keys)


def failure_reasons(tasks: DataFrame, infos: DataFrame, key: str) -> DataFrame:
    """Reason of each failed task: the report stored for its build or train, else its own text.

    ``tasks`` has ``status`` and ``info``; ``infos`` has one ``report`` per ``key``.
    """
    failed = tasks.filter(F.col("status") == "FAILED")
    found = lookup(failed, infos.select(key, "report"), [key])
    chosen = F.when(F.coalesce("report", F.lit("")) != "", text.parse_report(F.col("report")))
    own = F.struct(F.lit("generic").alias("type"), F.col("info").alias("message"))
    return found.select(*tasks.columns, F.coalesce(chosen, own).alias("_r")).select(
        *tasks.columns, F.col("_r.type").alias("report_type"), F.col("_r.message").alias("reason")
    )


def build_tags(builds: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """``tag`` is ``<version name>.<index>``, empty for a build without a version."""
    joined = lookup(builds, versions, [key])
    tag = F.concat_ws(".", "version_name", F.col("index").cast("string"))
    return joined.withColumn("tag", F.when(F.col("version_name").isNull(), "").otherwise(tag)).drop("version_name")


def train_tags(trains: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """Like ``build_tags``, but a train without a version is left out."""
    joined = lookup(trains, versions, [key], how="inner")
    return joined.withColumn("tag", F.concat_ws(".", "version_name", F.col("index").cast("string"))).drop("version_name")


def latest_build(builds: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """Completed build with the largest (version, index) per key."""
    done = builds.filter(F.col("status") == "COMPLETED")
    rest = [v for v in values if v not in ("version_no", "index")]
    best = F.max(F.struct("version_no", "index", *rest)).alias("_best")
    return done.groupBy(*keys).agg(best).select(*keys, "_best.*")


def resolve_refs(
    df: DataFrame,
    column: str,
    builds: DataFrame,
    account: str | None = None,
    project: str | None = None,
    expected_type: str | None = None,
) -> DataFrame:
    """Parse a column of references, fill defaults and find the build each one means.

    A bare name means its latest completed build, a version its latest build, and
    ``version.build`` that build. ``builds`` has the reference parts, ``version_no``,
    ``index``, ``status`` and ``build_id``.
    """
    rows = refs.parse_refs(df, column, "_ref", expected_type, account, project)
    path = refs.render_path(F.col("_ref"), selector=False)
    base = F.concat_ws("/", "account", "project", "type", "name")
    versioned = F.concat(base, F.lit(":"), F.col("version"))
    exact = F.concat(versioned, F.lit("."), F.col("index").cast("string"))
    named = builds.withColumn("_path", F.explode(F.array(base, versioned, exact)))
    target = latest_build(named, ["_path"], ["build_id"]).select("_path", "build_id")
    found = lookup(rows.withColumn("_path", path), target, ["_path"])
    state = F.when((F.col("_ref.status") == "ok") & F.col("build_id").isNull(), "not found").otherwise(F.col("_ref.status"))
    return found.select(
        *df.columns,
        state.alias("status"),
        *[F.col(f"_ref.{p}").alias(p) for p in refs.PARTS],
        F.col("_path").alias("path"),
        "build_id",
    )

"""Status names and predicates, machine profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Status codes and names (fixed values).
BUILD_STATUSES = {0: "INVALID", 1: "STARTED", 2: "COMPLETED", 3: "FAILED"}
TRAIN_STATUSES = {
    0: "INVALID",
    1: "PENDING",
    2: "INITIALIZING",
    3: "FETCHING_FEATURES",
    4: "IN_PROGRESS",
    5: "SUCCESSFUL",
    6: "FAILED",
    7: "CANCEL_REQUESTED",
    8: "CANCELED",
}
RUNNING_STATUSES = ["building", "training", "asserting", "uploading", "downloading asset"]
FINISHED_STATUSES = ["done", "error", "asset from cache", "asset loaded"]

# Machine profiles: name, cpus, memory, gpus (fixed values).
FABRICS = [
    ("f-local", 0.0, 0.0, 0),
    ("f-xxsmall", 0.5, 2.0, 0),
    ("f-xsmall", 0.5, 4.0, 0),
    ("f-small", 2.0, 4.0, 0),
    ("f-medium", 3.0, 14.0, 0),
    ("f-gpu-small", 3.0, 48.0, 1),
    ("f-gpu-large", 3.0, 48.0, 2),
]
DEFAULT_FABRIC = "f-small"


def status_name(code: Column, names: dict[int, str]) -> Column:
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return F.coalesce(table[code], F.lit(names[0]))


def is_running(status: Column) -> Column:
    return status.isin(RUNNING_STATUSES)


def is_finished(status: Column) -> Column:
    return status.isin(FINISHED_STATUSES)


def fabric_table(spark: SparkSession) -> DataFrame:
    """The fixed table of machine profiles; memory in bytes is thousands of binary MB."""
    rows = spark.createDataFrame(FABRICS, "fabric string, cpu double, memory double, gpu int")
    return rows.select(
        "fabric",
        "cpu",
        (F.col("memory") * 1000 * 1024 * 1024).cast("long").alias("memory_bytes"),
        "gpu",
        F.contains("fabric", F.lit("gpu")).alias("is_gpu"),
    )


def fabric_lookup(df: DataFrame, fabric: str, run_default: str | None = None) -> DataFrame:
    """Add the profile of the row's fabric, else the run's default, else the overall default.

    The profile table has a handful of fixed rows, so it is broadcast. An unknown name gives
    ``status`` ``unknown fabric``.
    """
    chosen = F.coalesce(F.col(fabric), F.lit(run_default), F.lit(DEFAULT_FABRIC))
    profiles = F.broadcast(fabric_table(df.sparkSession))
    joined = df.withColumn("fabric", chosen)
    status = F.when(F.col("cpu").isNull(), "unknown fabric").otherwise("ok")
    return joined.join(profiles, "fabric", "left").withColumn("status", status)

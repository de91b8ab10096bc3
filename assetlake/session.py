"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that every operator here relies on."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="assetlake-")
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the cluster's shared checkpoint folder."""
    return f"{_checkpoint_root(spark)}/assetlake/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Unlike an in-memory copy, the result survives the loss of any executor, and its file
    sizes give the optimizer true statistics for the next join.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Tables from records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def check_table(result) -> DataFrame:
    """The result of a dataset function: a DataFrame with columns, or a list of dicts."""
    if isinstance(result, DataFrame):
        if not result.columns:
            raise ValueError("a table needs at least one column")
        return result
    if isinstance(result, list):
        if not all(isinstance(item, dict) for item in result):
            raise TypeError("a list result must hold dicts only")
        spark = SparkSession.active()
        if not result:
            return spark.createDataFrame([], "struct<>")
        names = list(dict.fromkeys(name for item in result for name in item))
        return spark.createDataFrame([tuple(item.get(n) for n in names) for item in result], names)
    raise TypeError(f"unsupported result type: {type(result).__name__}")


def json_records(df: DataFrame, column: str, keep: Sequence[str], schema: str | None = None) -> DataFrame:
    """Columns from JSON records; a key that a record lacks is null.

    Without a schema, one aggregate over the column finds the union of all keys.
    """
    if schema is None:
        found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
        if not found.startswith("OBJECT<"):
            raise ValueError(f"records must be JSON objects, found {found}")
        schema = found.replace("OBJECT<", "STRUCT<")
        record = F.try_variant_get(F.try_parse_json(column), "$", schema)
    else:
        record = F.from_json(column, schema)
    return df.select(*keep, record.alias("_record")).select(*keep, "_record.*")

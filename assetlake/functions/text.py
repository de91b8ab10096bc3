"""Text expressions: truncation, name checks, key prefixes, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits on stored text, in characters (fixed values).
FAILURE_INFO_LIMIT = 99_999
README_LIMIT = 25_000

# Names of projects, with an optional account in front (fixed pattern).
NAME_PATTERN = r"^(([a-zA-Z0-9_-]+)\/)?([a-zA-Z0-9_-]+)$"


def truncate(text: Column, limit: int, suffix: str = "") -> Column:
    """Text of at most ``limit`` characters; a cut text ends in ``suffix``."""
    cut = F.concat(F.substring(text, 1, limit - len(suffix)), F.lit(suffix))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def failure_info(text: Column) -> Column:
    return truncate(text, FAILURE_INFO_LIMIT, "...")


def readme(text: Column) -> Column:
    return truncate(text, README_LIMIT)


def is_valid_name(name: Column) -> Column:
    return F.coalesce(name.rlike(NAME_PATTERN), F.lit(False))


def with_prefix(key: Column, prefix: str, separator: str = "-") -> Column:
    """``<prefix><separator><key>``, or the key alone if the prefix is empty."""
    return F.concat(F.lit(prefix + separator), key) if prefix else key


def log_line(time: Column, asset: Column, text: Column) -> Column:
    """``HH:MM:SS asset: text``."""
    return F.concat(F.date_format(time, "HH:mm:ss"), F.lit(" "), asset, F.lit(": "), text)


def status_report(kind: str, message: Column) -> Column:
    """JSON text of a status report of type ``Generic`` or ``Assertion``."""
    return F.to_json(F.struct(F.lit(kind).alias("type"), message.alias("message")))


def parse_report(text: Column) -> Column:
    """Struct of ``type`` and ``message``; a text that is not a report is a generic message.

    A report of an unknown type has type null.
    """
    report = F.try_parse_json(text)
    kind = F.lower(F.try_variant_get(report, "$.type", "string"))
    message = F.try_variant_get(report, "$.message", "string")
    known = kind.isin("python", "generic", "assertion")
    return F.struct(
        F.when(report.isNull(), "generic").when(known, kind).alias("type"),
        F.when(report.isNull(), text).when(known, message).alias("message"),
    )

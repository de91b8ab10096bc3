"""Expressions over raw counter text and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def user_time_ns(cpu_stat: Column) -> Column:
    """CPU time from a ``user_usec N`` line, in nanoseconds; 0 when there is none."""
    digits = F.regexp_extract(cpu_stat, r"user_usec (\d*)\n", 1)
    return F.coalesce(digits.try_cast("long") * 1000, F.lit(0))


def quota(cpu_max: Column) -> Column:
    """``quota period`` as CPUs: ``max`` is 1, a missing or single-word text is 0."""
    words = F.regexp_extract_all(cpu_max, F.lit(r"(\S+)"), 1)
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    ratio = first.try_cast("double") / F.nullif(second.try_cast("double"), F.lit(0.0))
    return F.when(second.isNull(), 0.0).when(first == "max", 1.0).otherwise(ratio)


def memory_limit(memory_high: Column, host_total: Column) -> Column:
    """Byte limit; ``max`` is the host's memory, missing is 0."""
    text = F.trim(F.regexp_replace(memory_high, r"\s+", " "))
    return F.when(text.isNull(), F.lit(0)).when(text == "max", host_total).otherwise(text.try_cast("long"))


def gibibytes(size: Column) -> Column:
    return F.bround(size.cast("double") / F.lit(float(1024**3)), 2)


def cpus_used(cpu_count: Column, percent: Column) -> Column:
    return F.bround(cpu_count * percent / 100, 2)

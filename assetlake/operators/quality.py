"""Data-quality rules, evaluated together in as few passes as possible.

All rules except uniqueness become columns of one aggregate, so a suite scans its table once.
Uniqueness needs one shuffle per distinct column set, pre-aggregated before the shuffle.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = "position int, rule string, args string, passed boolean, violations bigint, detail string"


class RuleError(ValueError):
    """A rule was declared with arguments of the wrong type."""


class SuiteFailed(Exception):
    """At least one rule of a suite failed; ``report`` holds all results."""

    def __init__(self, message: str, report: list):
        super().__init__(message)
        self.report = report


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def adjusted_skewness(column: str) -> Column:
    """Sample skewness G1: null below three values, 0 for a constant column."""
    value = F.col(f"`{column}`").cast("double")
    value = F.when(~F.isnan(value), value)
    n = F.count(value).cast("double")
    adjusted = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, F.lit(None)).when(F.var_pop(value) == 0, 0.0).otherwise(adjusted)


def _same_kind(value: Any, data_type: T.DataType) -> bool:
    """Whether a listed value can equal a value of the column at all."""
    if isinstance(data_type, T.StringType):
        return isinstance(value, str)
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return isinstance(value, (bool, int, float, decimal.Decimal))
    return True


def _invalid(df: DataFrame, column: str, valid: Sequence[Any]) -> Column:
    data_type = df.schema[column].dataType
    listed = [v for v in valid if v is not None and _same_kind(v, data_type)]
    if isinstance(data_type, T.BooleanType):
        listed = [bool(v) for v in listed if v in (0, 1)]
    value = F.col(f"`{column}`")
    missing = is_missing(df, column)
    if isinstance(data_type, (T.StringType, T.NumericType, T.BooleanType)):
        within = value.isin(listed) if listed else F.lit(False)
    else:  # a listed value that the column's type cannot hold equals nothing
        within = value.isin([F.lit(v).try_cast(data_type) for v in listed]) if listed else F.lit(False)
    outside = ~F.coalesce(within, F.lit(False))
    return F.when(missing, F.lit(None not in valid)).otherwise(outside)


def _strings(value: Any) -> bool:
    return isinstance(value, list) and all(isinstance(v, str) for v in value)


def _failed(detail: str) -> tuple[Column, Column, Column]:
    return F.lit(False), F.lit(1).cast("long"), F.lit(detail)


class Rule:
    """Base of all rules. ``verdict`` gives (passed, violations, detail) aggregate columns."""

    name = ""
    values: tuple = ()

    def columns(self) -> list[str]:
        return []

    def args(self) -> str:
        return ", ".join(getattr(v, "__name__", str(v)) if callable(v) else str(v) for v in self.values)

    def verdict(self, df: DataFrame) -> tuple[Column, Column, Column]:
        raise NotImplementedError

    def __str__(self) -> str:
        return f"{self.name}({self.args()})"


@dataclass(frozen=True)
class ValidValues(Rule):
    """Only listed values occur; null counts as a value. ``invalid_values`` lists the others."""

    column: str
    valid: list
    name = "assert_valid_values"

    def __post_init__(self):
        if not isinstance(self.valid, list):
            raise RuleError("valid values must be given as a list")

    @property
    def values(self):
        return (self.column, self.valid)

    def columns(self):
        return [self.column]

    def verdict(self, df):
        bad = _invalid(df, self.column, self.valid)
        violations = F.count(F.when(bad, 1))
        # A smallest text among the aggregates would keep the whole suite out of compiled code.
        text = F.concat(violations.cast("string"), F.lit(" rows outside the list"))
        return violations == 0, violations, F.when(violations > 0, text)


@dataclass(frozen=True)
class NotNull(Rule):
    """None of the columns has a null (or NaN)."""

    names: list
    name = "assert_not_null"

    def __post_init__(self):
        if not _strings(self.names):
            raise RuleError("column names must be given as a list of strings")

    @property
    def values(self):
        return (self.names,)

    def columns(self):
        return self.names

    def verdict(self, df):
        nulls = [F.count(F.when(is_missing(df, c), 1)) for c in self.names]
        violations = sum(nulls, F.lit(0).cast("long"))
        listed = F.concat_ws(", ", *[F.when(n > 0, F.lit(c)) for c, n in zip(self.names, nulls)])
        return violations == 0, violations, F.when(violations > 0, listed)


@dataclass(frozen=True)
class Unique(Rule):
    """No two rows agree on all the columns; nulls equal each other."""

    subset: list
    name = "assert_unique"

    def __post_init__(self):
        if not _strings(self.subset):
            raise RuleError("column names must be given as a list of strings")

    @property
    def values(self):
        return (self.subset,)

    def columns(self):
        return self.subset


@dataclass(frozen=True)
class Skewness(Rule):
    """Adjusted sample skewness strictly between ``low`` and ``high``."""

    column: str
    low: float
    high: float
    name = "assert_skewness"

    def __post_init__(self):
        numbers = all(isinstance(v, (int, float)) for v in (self.low, self.high))
        if not isinstance(self.column, str) or not numbers:
            raise RuleError("a column name and two numbers are needed")

    @property
    def values(self):
        return (self.column, self.low, self.high)

    def columns(self):
        return [self.column]

    def verdict(self, df):
        if not isinstance(df.schema[self.column].dataType, (T.NumericType, T.BooleanType)):
            return _failed("not a numeric column")
        value = adjusted_skewness(self.column)
        inside = F.coalesce((value > self.low) & (value < self.high), F.lit(False))
        text = F.coalesce(F.format_string("%.4f", value), F.lit("nan"))
        return inside, F.when(inside, 0).otherwise(1).cast("long"), text


@dataclass(frozen=True)
class IsTrue(Rule):
    """A predicate over the whole table: a boolean aggregate (SQL text or column) or ``DataFrame -> bool``."""

    predicate: str | Column | Callable[[DataFrame], bool]
    label: str | None = None
    name = "assert_true"

    @property
    def values(self):
        return (self.label or getattr(self.predicate, "__name__", str(self.predicate)),)

    def verdict(self, df):
        if isinstance(self.predicate, (str, Column)):
            try:
                test = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
                kind = df.agg(test.alias("t")).schema["t"].dataType
            except Exception as error:  # a predicate that cannot be resolved is a failed rule
                return _failed(type(error).__name__)
            if not isinstance(kind, T.BooleanType):
                return _failed("predicate must return a boolean")
            holds = F.coalesce(test, F.lit(False))
            return holds, F.when(holds, 0).otherwise(1).cast("long"), F.lit(None).cast("string")
        problem = None
        try:
            outcome = self.predicate(df)
            if not isinstance(outcome, bool) and type(outcome).__name__ != "bool_":
                outcome, problem = False, "predicate must return a boolean"
        except Exception as error:  # any error of a user predicate is a failed rule
            outcome, problem = False, f"{type(error).__name__}"
        holds = bool(outcome)
        return F.lit(holds), F.lit(0 if holds else 1).cast("long"), F.lit(problem).cast("string")


def duplicates(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its number of rows."""
    return df.groupBy(*[F.col(f"`{c}`") for c in subset]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def invalid_values(df: DataFrame, column: str, valid: Sequence[Any]) -> DataFrame:
    """Every distinct value of ``column`` outside ``valid``, with its number of rows."""
    return (
        df.filter(_invalid(df, column, valid))
        .groupBy(F.col(f"`{column}`").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, nulls, has_null)`` for every column, in one pass."""
    counts = [F.count(F.when(is_missing(df, c), 1)).alias(f"_{i}") for i, c in enumerate(columns)]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls"), (F.col(f"_{i}") > 0).alias("has_null"))
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*counts).select(F.inline(rows))


def skewness_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, skewness)`` for every column, in one pass."""
    parts = []
    for i, c in enumerate(columns):
        numbers = F.count(F.when(~is_missing(df, c), 1))
        parts += [numbers.alias(f"_n{i}"), adjusted_skewness(c).alias(f"_s{i}")]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("skewness"))
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*parts).select(F.inline(rows))


def unique_report(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """One row: number of duplicated keys and of rows that repeat an earlier one."""
    return duplicates(df, subset).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("repeated_rows"),
    )


def _result(position: int, rule: Rule, passed, violations, detail) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.args()).alias("args"),
        passed.alias("passed"),
        violations.cast("long").alias("violations"),
        detail.cast("string").alias("detail"),
    )


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate all rules, the last one added first, and return one row per rule.

    A rule that names an unknown column fails; it does not stop the others.
    """
    fused, results, tables = [], [], []
    for position, rule in enumerate(reversed(list(rules))):
        unknown = [c for c in rule.columns() if c not in df.columns]
        if unknown:
            text = "unknown column: " + ", ".join(unknown)
            results.append(_result(position, rule, F.lit(False), F.lit(1), F.lit(text)))
        elif isinstance(rule, Unique):
            verdict = unique_report(df, rule.subset)
            repeated = F.col("repeated_rows")
            detail = F.when(repeated > 0, F.concat("duplicate_keys", F.lit(" duplicated keys")))
            tables.append(
                verdict.select(_result(position, rule, repeated == 0, repeated, detail).alias("r")).select("r.*")
            )
        else:
            columns = rule.verdict(df)
            names = [f"_{position}_{part}" for part in range(3)]
            fused += [c.alias(n) for c, n in zip(columns, names)]
            results.append(_result(position, rule, *[F.col(n) for n in names]))
    if results:
        probe = df.agg(*fused) if fused else df.agg(F.count(F.lit(1)))
        tables.append(probe.select(F.inline(F.array(*results))))
    if not tables:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    report = tables[0]
    for more in tables[1:]:
        report = report.unionByName(more)
    return report


def evaluated(df: DataFrame, rules: Sequence[Rule]) -> list[Row]:
    """The rows of :func:`run_suite`, evaluated now; a rule that cannot be evaluated fails on its own.

    The fused aggregate is tried first. Only if it fails are the rules evaluated one by one, so that the guilty ones
    fail with their error and the others keep their results.
    """
    try:
        return run_suite(df, rules).orderBy("position").collect()  # one row per rule
    except PySparkException:
        rows = []
    for position, rule in enumerate(reversed(list(rules))):
        try:
            row = run_suite(df, [rule]).first().asDict()
        except PySparkException as error:
            name = error.getCondition() or type(error).__name__
            row = {"rule": rule.name, "args": rule.args(), "passed": False, "violations": 1, "detail": name}
        rows.append(Row(**(row | {"position": position})))
    return rows


def evaluated_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """:func:`evaluated` as a table."""
    names = [part.split()[0] for part in REPORT_SCHEMA.split(", ")]
    rows = [tuple(r[n] for n in names) for r in evaluated(df, rules)]
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def failure_message(report: DataFrame, *by: str) -> DataFrame:
    """``failed: rule(args), …`` over the failed rules, or null where all passed.

    A report has one row per declared rule, so the collected list is as short as the suite.
    """
    failed = F.when(
        ~F.col("passed"),
        F.struct("position", F.concat("rule", F.lit("("), "args", F.lit(")")).alias("text")),
    )
    listed = F.array_sort(F.collect_list(failed))
    text = F.array_join(F.transform(listed, lambda r: r["text"]), ", ")
    return report.groupBy(*by).agg(
        F.when(F.size(listed) > 0, F.concat(F.lit("failed: "), text)).alias("message")
    )


def check(df: DataFrame, rules: Sequence[Rule]) -> list:
    """Run the suite and raise ``SuiteFailed`` after all rules if any failed."""
    rows = evaluated(df, rules)
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise SuiteFailed(
            "failed: " + ", ".join(f"{r['rule']}({r['args']})" for r in failed), rows
        )
    return rows

import pytest
from pyspark.sql import functions as F

from assetlake.operators import quality as q


@pytest.fixture()
def users(spark):
    rows = [("user1", "linux"), ("user2", "linux"), ("user3", "other")]
    return spark.createDataFrame(rows, "UserName string, OperatingSystem string")


def prices(spark, *values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "Id long, Price double")


def outcome(df, *rules):
    return {r["rule"]: r for r in q.run_suite(df, rules).collect()}


def test_valid_values(users):
    assert outcome(users, q.ValidValues("OperatingSystem", ["linux", "other"]))["assert_valid_values"]["passed"]
    row = outcome(users, q.ValidValues("OperatingSystem", ["linux"]))["assert_valid_values"]
    assert (row["passed"], row["violations"], row["detail"]) == (False, 1, "1 rows outside the list")
    assert [r["value"] for r in q.invalid_values(users, "OperatingSystem", ["linux"]).collect()] == ["other"]


def test_null_is_a_value(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert not outcome(df, q.ValidValues("c", ["a"]))["assert_valid_values"]["passed"]
    assert outcome(df, q.ValidValues("c", ["a", None]))["assert_valid_values"]["passed"]
    assert outcome(df.limit(0), q.ValidValues("c", []))["assert_valid_values"]["passed"]


@pytest.mark.parametrize(
    "declare",
    [
        lambda: q.ValidValues("c", "linux"),
        lambda: q.NotNull("c"),
        lambda: q.NotNull([1]),
        lambda: q.Unique("c"),
        lambda: q.Skewness("c", "0", 1),
    ],
)
def test_wrong_arguments_are_rejected_when_declared(declare):
    with pytest.raises(q.RuleError):
        declare()


def test_not_null_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None)], "f double, s string")
    row = outcome(df, q.NotNull(["f", "s"]))["assert_not_null"]
    assert (row["passed"], row["violations"], row["detail"]) == (False, 2, "f, s")
    assert outcome(df.limit(1), q.NotNull(["f", "s"]))["assert_not_null"]["passed"]


def test_unique(spark):
    rows = [(1, "u1", "linux"), (1, "u1", "other"), (2, "u2", "linux")]
    df = spark.createDataFrame(rows, "Id long, UserName string, OperatingSystem string")
    assert not outcome(df, q.Unique(["Id", "UserName"]))["assert_unique"]["passed"]
    assert outcome(df, q.Unique(["Id", "UserName", "OperatingSystem"]))["assert_unique"]["passed"]
    row = outcome(df, q.Unique(["Id", "Missing"]))["assert_unique"]
    assert (row["passed"], row["detail"]) == (False, "unknown column: Missing")
    nulls = spark.createDataFrame([(None,), (None,)], "c string")
    assert not outcome(nulls, q.Unique(["c"]))["assert_unique"]["passed"]


def test_skewness(spark):
    value = prices(spark, 15, 20, 50).agg(q.adjusted_skewness("Price")).first()[0]
    assert value == pytest.approx(1.5970969928697372)
    assert not outcome(prices(spark, 15, 20, 50), q.Skewness("Price", 0.5, 1))["assert_skewness"]["passed"]
    assert outcome(prices(spark, 15, 20, 10), q.Skewness("Price", -0.5, 0.5))["assert_skewness"]["passed"]
    assert outcome(prices(spark, 7, 7, 7), q.Skewness("Price", -0.5, 0.5))["assert_skewness"]["passed"]
    assert not outcome(prices(spark, 7, 8), q.Skewness("Price", -5, 5))["assert_skewness"]["passed"]


def test_predicates(users):
    def crash(df):
        raise RuntimeError("no")

    def text(df):
        return "yes"

    def three(df):
        return df.count() == 3

    rules = [q.IsTrue(crash), q.IsTrue(text), q.IsTrue(three), q.IsTrue("count(*) = 3", "sql"), q.IsTrue(F.lit(None).cast("boolean"), "null")]
    rows = {r["args"]: r["passed"] for r in q.run_suite(users, rules).collect()}
    assert rows == {"crash": False, "text": False, "three": True, "sql": True, "null": False}


def test_rules_that_cannot_be_evaluated_fail_alone(users):
    rules = [
        q.IsTrue("max(missing) > 0", "unresolved"),
        q.IsTrue("count(*)", "number"),
        q.Skewness("UserName", -1, 1),
        q.ValidValues("OperatingSystem", [1, 2, "linux", "other"]),
    ]
    rows = [(r["rule"], r["passed"], r["detail"]) for r in q.run_suite(users, rules).orderBy("position").collect()]
    assert rows == [
        ("assert_valid_values", True, None),
        ("assert_skewness", False, "not a numeric column"),
        ("assert_true", False, "predicate must return a boolean"),
        ("assert_true", False, "AnalysisException"),
    ]


def test_valid_values_of_other_types(spark):
    df = spark.createDataFrame([(1, True), (2, False), (2, None)], "n long, b boolean")
    assert outcome(df, q.ValidValues("n", [1, 2.0, "x"]))["assert_valid_values"]["passed"]
    assert outcome(df, q.ValidValues("n", [1]))["assert_valid_values"]["violations"] == 2
    assert outcome(df, q.ValidValues("b", [True, None]))["assert_valid_values"]["violations"] == 1


def test_suite_runs_all_rules_last_one_first(users):
    rules = [q.NotNull(["UserName"]), q.ValidValues("OperatingSystem", ["linux"]), q.Unique(["OperatingSystem"])]
    report = q.run_suite(users, rules).orderBy("position").collect()
    assert [r["rule"] for r in report] == ["assert_unique", "assert_valid_values", "assert_not_null"]
    expected = "failed: assert_unique(['OperatingSystem']), assert_valid_values(OperatingSystem, ['linux'])"
    assert q.failure_message(q.run_suite(users, rules)).first()["message"] == expected
    with pytest.raises(q.SuiteFailed, match="assert_unique"):
        q.check(users, rules)
    assert len(q.check(users, rules[:1])) == 1


def test_suite_scans_its_table_once(users):
    rules = [q.NotNull(["UserName"]), q.ValidValues("OperatingSystem", ["linux"]), q.IsTrue("count(*) > 0", "any")]
    plan = q.run_suite(users, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert "SortAggregate" not in plan

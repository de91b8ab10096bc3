import pytest
from pyspark.sql import functions as F

from assetlake.functions import refs, status, text
from assetlake.operators import catalog as c

PATHS = {"": (None, None), "prj/": (None, "prj"), "acc/prj/": ("acc", "prj")}
VERSIONS = {"": (None, None), ":": ("", None), ":v_7": ("v_7", None), ":7.": ("7", None), ":7.40": ("7", 40), ":.3": ("", 3)}
SELECTORS = {"": None, "#Col-1": "Col-1"}


def parsed(spark, ref, *args, **kwargs):
    return refs.parse_refs(spark.createDataFrame([(ref,)], "ref string"), "ref", "r", *args, **kwargs)


@pytest.mark.parametrize("kind", ["datasets", "models"])
def test_parse_with_each_optional_part_present_and_absent(spark, kind):
    want = {
        f"{path}{kind}/N_1-x{version}{selector}": (*owner, kind, "N_1-x", *build, chosen)
        for path, owner in PATHS.items()
        for version, build in VERSIONS.items()
        for selector, chosen in SELECTORS.items()
    }
    df = spark.createDataFrame([(r,) for r in want], "ref string")
    for expected_type in (None, kind):
        got = refs.parse_refs(df, "ref", "r", expected_type).collect()
        assert {r["ref"]: (r["r"]["status"], tuple(r["r"])[1:]) for r in got} == {k: ("ok", v) for k, v in want.items()}
    bare = refs.parse_refs(spark.createDataFrame([("N:2.5#s",)], "ref string"), "ref", "r", kind).first()["r"]
    assert tuple(bare) == ("ok", None, None, kind, "N", "2", 5, "s")


@pytest.mark.parametrize(
    "ref, expected_type, problem",
    [
        ("N:2.5", None, "full path or type needed"),
        ("", None, "full path or type needed"),
        ("files/N", None, "pattern mismatch"),
        ("x/acc/prj/models/N", None, "pattern mismatch"),
        ("datasets/", None, "pattern mismatch"),
        ("datasets/N:V", None, "pattern mismatch"),
        ("datasets/N:1.x", None, "pattern mismatch"),
        ("datasets/N#", None, "pattern mismatch"),
        ("datasets/N .1", "datasets", "pattern mismatch"),
        ("acc/prj/datasets/N", "models", "type mismatch"),
        (None, "models", "missing reference"),
    ],
)
def test_parse_errors(spark, ref, expected_type, problem):
    got = parsed(spark, ref, expected_type).first()["r"]
    assert got["status"] == problem and set(tuple(got)[1:]) == {None}


@pytest.mark.parametrize("owner", PATHS)
def test_render_gives_back_the_parts_there_are(spark, owner):
    cases = [(f"{owner}models/N_1-x", build, chosen) for build in ("", "v_7", "7.40", "0.3") for chosen in ("", "Col-1")]
    want = {
        base + (build and ":" + build) + (chosen and "#" + chosen): base + (build and "?v=" + build) + (chosen and "#" + chosen)
        for base, build, chosen in cases
    }
    df = refs.parse_refs(spark.createDataFrame([(r,) for r in want], "ref string"), "ref", "r")
    rendered = df.select("ref", refs.render_path(F.col("r")).alias("path"), refs.render_url(F.col("r"), "https://h").alias("url"))
    complete = owner.count("/") == 2
    for r in rendered.collect():
        assert r["path"] == r["ref"] and r["url"] == (f"https://h/{want[r['ref']]}" if complete else None)


def test_defaults(spark):
    assert parsed(spark, "datasets/a", project="p").first()["r"]["status"] == "relative reference"
    got = parsed(spark, "q/datasets/a", account="o", project="p").first()["r"]
    assert (got["account"], got["project"]) == ("o", "q")


def test_build_states(spark):
    rows = [("a", 1, 1, None, None), ("a", 2, 3, None, "x" * 100_001), ("b", 1, 1, None, None), ("b", 2, 2, "lake/b", None)]
    df = spark.createDataFrame(rows, "build string, seq long, status int, location string, info string")
    got = {r["build"]: r for r in c.build_status(df, ["build"], "seq").collect()}
    assert (got["b"]["status"], got["b"]["location"]) == ("COMPLETED", "lake/b")
    assert got["a"]["status"] == "FAILED" and len(got["a"]["info"]) == 99_999 and got["a"]["info"].endswith("x...")


def test_history_is_decided_by_its_first_final_event(spark):
    rows = [
        ("ok", 1, "task", "SUCCEEDED", "t"), ("ok", 2, "run", "SUCCEEDED", None), ("ok", 3, "task", "FAILED", "late"),
        ("bad", 1, "task", "SCHEDULED", None), ("bad", 2, "task", "FAILED", "boom"), ("bad", 3, "run", "SUCCEEDED", None),
        ("open", 1, "run", "INVALID", None), ("open", 2, "task", "SUCCEEDED", None), ("gone", 1, "run", "TERMINATED", "x"),
    ]
    df = spark.createDataFrame(rows, "run string, seq long, source string, status string, info string")
    got = {r["run"]: (r["outcome"], r["info"], r["is_running"], r["is_finished"]) for r in c.fold_status(df, ["run"], "seq").collect()}
    assert got == {
        "ok": ("SUCCEEDED", None, False, True), "bad": ("FAILED", "boom", False, True),
        "open": ("RUNNING", None, True, False), "gone": ("TERMINATED", "x", False, True),
    }


def test_fabrics(spark):
    df = spark.createDataFrame([(1, "f-gpu-large"), (2, None), (3, "f-none")], "id long, fabric string")
    got = {r["id"]: r for r in status.fabric_lookup(df, "fabric").collect()}
    assert (got[1]["gpu"], got[1]["is_gpu"], got[1]["memory_bytes"]) == (2, True, 48 * 1000 * 1024 * 1024)
    assert (got[2]["fabric"], got[2]["cpu"], got[3]["status"]) == ("f-small", 2.0, "unknown fabric")


def test_names_and_truncation(spark):
    names = ["a", "acc/p-1", "a b", "a/b/c", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(text.is_valid_name(F.col("n"))).collect()] == [True, True, False, False, False, False]
    row = spark.range(1).select(text.truncate(F.lit("abcdef"), 5, "..."), text.truncate(F.lit("abcde"), 5, "..."), text.readme(F.repeat(F.lit("é"), 25_001)))
    assert [len(v) for v in row.first()] == [5, 5, 25_000]

import datetime
import decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assetlake.operators import quality as q
from assetlake.operators.lineage import CycleError
from assetlake.sources import builds, files, records


def test_concat_of_partitions(spark, lake):
    spark.createDataFrame([(1,), (2,)], "x long").write.parquet(f"{lake}/a")
    spark.createDataFrame([(v, "y") for v in (3, 4, 6, 6, 7)], "x long, y string").write.parquet(f"{lake}/b")
    got = builds.scan_partitions(spark, [f"{lake}/a", f"{lake}/b"])
    assert sorted(r["x"] for r in got.collect()) == [1, 2, 3, 4, 6, 6, 7]
    assert got.filter("y IS NULL").count() == 2
    assert builds.scan_partitions(spark, []).isEmpty()


def test_builds(spark, lake):
    store = builds.BuildStore(spark, lake)
    one = spark.createDataFrame([(1, 10.0)], "id long, price double")
    two = spark.createDataFrame([(1, 20.0), (2, 30.0)], "id long, price double")
    store.write(one, "prices", "1")
    store.write(two, "prices", "1")
    store.write(one, "prices", "2")
    assert store.read("prices").count() == 1
    assert store.read("prices", "1").count() == 2
    assert store.read("prices", "1", 1).count() == 1
    with pytest.raises(q.SuiteFailed):
        store.write(two, "prices", "3", rules=[q.Skewness("price", 0, 1), q.NotNull(["id"])])
    assert store.read("prices").count() == 1
    states = {(r["version"], r["index"]): (r["status"], r["info"]) for r in store.builds().collect()}
    assert states[("1", 2)] == ("COMPLETED", None)
    assert states[("3", 1)] == ("FAILED", "Dataset build failed with failed: assert_skewness(price, 0, 1)")
    with pytest.raises(LookupError):
        store.read("nothing")


def test_dataset_functions(spark, lake):
    store = builds.BuildStore(spark, lake)

    @builds.dataset("d", dependencies=["datasets/x"], rules=[q.Unique(["id"])])
    def numbers(session):
        return session.range(3)

    @builds.dataset("none")
    def nothing(session):
        return None

    @builds.dataset("bad")
    def raising(session):
        raise SystemExit("stopped")

    @builds.dataset("l", description="two rows")
    def listed(session):
        return [{"a": 1}, {"a": 2, "b": "x"}]

    assert store.build(nothing) is None
    with pytest.raises(LookupError):
        store.read("none")
    store.build(numbers)
    assert store.read("d").count() == 3
    store.build(listed)
    assert sorted(map(tuple, store.read("l").collect())) == [(1, None), (2, "x")]
    with pytest.raises(SystemExit):
        store.build(raising)
    states = {r["name"]: r["status"] for r in store.builds().collect()}
    assert states == {"none": "COMPLETED", "d": "COMPLETED", "l": "COMPLETED", "bad": "FAILED"}
    known = {r["name"]: (r["description"], r["dependencies"]) for r in store.registrations().collect()}
    assert known["d"] == ("", ["datasets/x"]) and known["l"] == ("two rows", [])
    assert store.write(spark.range(0), "empty") and store.read("empty").isEmpty()
    with pytest.raises(ValueError):
        builds.dataset("d", dependencies=[3])


def test_column_types_round_trip(spark, lake):
    schema = (
        "id long, b boolean, s string, i8 byte, i16 short, i32 int, f float, d double, day date, tod time(6), ts timestamp_ntz, "
        "la array<long>, sa array<string>, img binary, u64 decimal(20,0)"
    )
    row = (
        2**63 - 1, True, "ünï", 127, -5, 7, 1.5, 1.7976931348623157e308, datetime.date(2022, 2, 3), datetime.time(1, 2, 3, 4),
        datetime.datetime(2022, 2, 3, 4, 5, 6, 7), [1, None], [], b"\x89PNG", decimal.Decimal(2**64 - 1),
    )
    df = spark.createDataFrame([row, (0,) + (None,) * 14], schema)
    store = builds.BuildStore(spark, lake)
    store.write(df, "types")
    back = store.read("types")
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == sorted(map(tuple, df.collect()), key=lambda r: r[0])


def test_nanosecond_times(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    pq.write_table(pa.table({"t": pa.array([1_500_000_000_123_456_789], pa.timestamp("ns"))}), path)
    got = builds.read_nanosecond_times(spark, path, ["t"]).first()["t"]
    assert got == datetime.datetime(2017, 7, 14, 2, 40, 0, 123456)


def test_manifest_and_format_gate(spark, lake):
    df = spark.range(100)
    df.repartition(2).write.parquet(f"{lake}/a")
    df.orderBy(F.desc("id")).coalesce(1).write.parquet(f"{lake}/b")
    df.coalesce(1).write.parquet(f"{lake}/c")
    spark.range(101).coalesce(1).write.parquet(f"{lake}/d")
    one, two, other = [files.partition_manifest(spark, [f"{lake}/{n}"]).first() for n in "bcd"]
    assert one["checksum"] == two["checksum"] != other["checksum"]
    manifest = files.partition_manifest(spark, [f"{lake}/a"])
    assert manifest.agg(F.sum("n_rows")).first()[0] == 100
    assert files.require_parquet(manifest).count() == 2
    csv = manifest.withColumn("format", F.lit("csv")).withColumn("checksum", F.lit(""))
    # A plan counts the checksums when it is made, so it is refused there.
    for read in (lambda: files.require_parquet(csv).count(), lambda: files.cache_plan(csv, manifest, "location")):
        with pytest.raises(Exception, match="Unsupported partition format: csv"):
            read()
    df.write.csv(f"{lake}/other")
    with pytest.raises(Exception, match="Unsupported partition format: csv"):
        files.partition_manifest(spark, [f"{lake}/a", f"{lake}/other"])
    rows = [("a", None), (None, "a")]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], "x string, y string").write.parquet(f"{lake}/null{i}")
    assert len({files.partition_manifest(spark, [f"{lake}/null{i}"]).first()["checksum"] for i in range(2)}) == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_files(spark, f"{lake}/missing").collect()


def test_cache_plan(spark):
    rows = [(1, "known"), (2, "new"), (3, "new"), (4, ""), (5, None), (6, "new")]
    manifest = spark.createDataFrame(rows, "location long, checksum string").withColumn("format", F.lit("parquet"))
    cache = spark.createDataFrame([("known",), ("unused",)], "checksum string")
    plan = {r["location"]: r["action"] for r in files.cache_plan(manifest, cache, "location").collect()}
    assert plan == {1: "cache", 2: "fetch", 3: "cache", 4: "remote", 5: "remote", 6: "cache"}
    assert files.cache_plan(manifest, cache, "location", no_cache=True).filter("action <> 'remote'").isEmpty()


def test_admission_is_decimal_and_allows_the_limit(spark):
    rows = [("a.png", 1_000_000), ("a.png", 1_000_001), ("a.webm", 100_000_000), ("a", 100_000_001)]
    df = spark.createDataFrame(rows, "p string, n long").select(files.admit(F.col("p"), F.col("n")).alias("a"))
    assert [(r["a"]["type"], r["a"]["admitted"]) for r in df.collect()] == [("IMAGE", True), ("IMAGE", False), ("VIDEO", True), ("FILE", False)]


def test_records(spark):
    got = records.check_table([{"a": 1}, {"b": "x", "a": 2}]).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, "x")]
    assert records.check_table([]).isEmpty()
    for wrong in ([1], "x", spark.createDataFrame([], "struct<>")):
        with pytest.raises((TypeError, ValueError)):
            records.check_table(wrong)


def test_predict_outputs(spark):
    import numpy as np
    import pandas as pd

    from assetlake.operators.predict import normalise_output, predict

    class Twice:
        def predict(self, frame):
            return np.column_stack([frame["a"] * 2, frame["a"] * 3])

    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, a double")
    got = predict(df, Twice(), ["a"], "x double, y double", keep=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 2.0, 3.0), (2, 4.0, 6.0)]
    for result in ([1, 2], np.array([1, 2]), pd.Series([1, 2]), pd.DataFrame({"q": [1, 2]})):
        assert normalise_output(result, ["p"])["p"].tolist() == [1, 2]
    with pytest.raises(TypeError):
        normalise_output("x", ["p"])
    with pytest.raises(TypeError):
        predict(df, object(), ["a"], "x double")


def test_a_set_is_built_in_order(spark, lake):
    store, seen = builds.BuildStore(spark, lake), []

    def made(name, *needs):
        def make(spark, *tables):
            seen.append(name)
            return spark.range(1 + sum(t.count() for t in tables))

        return builds.dataset(name, needs)(make)

    store.write(spark.range(10), "outside")
    a, b, c = made("a"), made("b", "a"), made("c", "a", "outside")
    got = {r["name"]: r for r in store.build_all([made("d", b, c), c, b, a]).collect()}
    assert seen[0] == "a" and seen[3] == "d"
    assert {n: (r["level"], r["status"]) for n, r in got.items()} == {n: (i, "COMPLETED") for n, i in zip("abcd", (0, 1, 1, 2))}
    assert store.read("d").count() == 1 + 2 + 12
    used = {(r["name"], r["dependency"]): r["used_build_id"] for r in store.used_builds().collect()}
    assert len(used) == 5 and used["d", "b"] == got["b"]["build_id"] and used["c", "a"] == got["a"]["build_id"]
    again = {r["name"]: r for r in store.build_all([b]).collect()}
    assert again["b"]["uses"] == {"a": got["a"]["build_id"]}


def test_sets_that_cannot_be_built(spark, lake):
    store = builds.BuildStore(spark, lake)
    make = lambda spark, *tables: spark.range(1)
    ring = [builds.dataset(n, [d])(make) for n, d in (("x", "z"), ("y", "x"), ("z", "y"))]
    with pytest.raises(CycleError, match="->"):
        store.build_all(ring)
    with pytest.raises(AnalysisException):
        store.events()  # nothing was started
    with pytest.raises(ValueError, match="same dataset"):
        store.build_all([builds.dataset("x")(make), builds.dataset("x")(make)])
    lost = store.build_all([builds.dataset("x", ["nowhere"])(make), builds.dataset("y", ["x"])(make)]).collect()
    assert [(r["status"], r["info"]) for r in lost] == [("FAILED", "no completed build of nowhere"), ("NOT BUILT", "not built: x")]

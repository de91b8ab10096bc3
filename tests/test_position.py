import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from assetlake.operators import batches as b
from assetlake.operators import position as p
from assetlake.operators.profile import fingerprint
from assetlake.sources.builds import BuildStore

ORDER = ["k", "i"]


@pytest.fixture(scope="module")
def rows(spark):
    """1,000 rows of which one key holds a third."""
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (1000 - F.col("id")).alias("i"),
    )
    return df.repartition(7)


@pytest.fixture(scope="module")
def expected(rows):
    return sorted((r["k"], r["i"]) for r in rows.collect())


@pytest.mark.parametrize("per_block", [10, 64, 5000])
def test_position(rows, expected, per_block):
    got = p.with_position(rows, ORDER, "idx", per_block).collect()
    assert sorted((r["idx"], r["k"], r["i"]) for r in got) == [(n, *e) for n, e in enumerate(expected)]


def test_blocks_split_the_hot_key(rows):
    total, blocked = p.in_blocks(rows, ORDER, 50)
    sizes = blocked.groupBy("_block").count().collect()
    assert total == 1000
    assert max(r["count"] for r in sizes) < 200


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("b", 4)], "k string, i long")
    got = p.with_position(df, ORDER, rows_per_block=1).orderBy("idx").collect()
    assert [(r["k"], r["i"]) for r in got] == [(None, 1), (None, 3), ("a", 2), ("b", 4)]


@pytest.mark.parametrize(
    "cut",
    [(None, None, None), (3, 17, 4), (-20, None, 3), (None, None, -1), (900, 20, -7), (5, 5, None), (2000, 10, None), (None, -995, 2)],
)
@pytest.mark.parametrize("per_block", [37, 5000])
def test_slice(rows, expected, cut, per_block):
    got = p.row_slice(rows, ORDER, *cut, rows_per_block=per_block).orderBy("pos").collect()
    assert [(r["k"], r["i"]) for r in got] == expected[slice(*cut)]


def test_row_at_and_head(rows, expected):
    row = p.row_at(rows, ORDER, -2, rows_per_block=50).first()
    assert (row["k"], row["i"]) == expected[-2]
    with pytest.raises(IndexError):
        p.row_at(rows, ORDER, 1000)
    with pytest.raises(TypeError):
        p.row_at(rows, ORDER, "1")
    assert p.head(rows, ORDER).count() == 5
    assert p.head(rows, ORDER, -990, rows_per_block=50).count() == 10


def test_slices_of_a_stored_build_scan_their_files_only(spark, lake, rows, expected, monkeypatch):
    store = BuildStore(spark, lake)
    store.write(rows, "rows", max_records_per_file=50, order=ORDER)
    table = store.ordered("rows")
    assert table.total == 1000 and table.index.count() == 20 and store.read("rows").count() == 1000

    def refuse(*args):
        raise AssertionError("a slice must not write")

    monkeypatch.setattr(DataFrameWriter, "parquet", refuse)
    for cut in [(100, 130, 1), (None, None, None), (-3, None, None), (700, 20, -9), (5, 5, None)]:
        got = table.slice(*cut).orderBy("pos").collect()
        assert [(r["k"], r["i"]) for r in got] == expected[slice(*cut)]
    assert len(table.slice(500, 510).inputFiles()) <= 3  # the index, and one file or two
    assert len(table.at(-1).inputFiles()) == 2
    assert tuple(table.at(42).first()) == expected[42] and table.head(3).count() == 3
    with pytest.raises(IndexError):
        table.at(-1001)


def test_nothing_in_order(spark, rows):
    table = p.ordered(rows.limit(0), ORDER)
    assert table.total == 0 and table.slice().count() == 0 and table.rows().count() == 0


def images(spark, *contents):
    return spark.createDataFrame([(i, bytes([c])) for i, c in enumerate(contents)], "i long, image binary")


@pytest.mark.parametrize(
    "left, right, equal",
    [((0, 1), (0, 1), [True, True]), ((0, 1), (0, 2), [True, False]), ((0, 1), (0,), [True, False]), ((0,), (0, 1), [True])],
)
def test_positional_equals(spark, left, right, equal):
    got = p.positional_equals(images(spark, *left), images(spark, *right), "image", ["i"], ["i"]).orderBy("idx")
    assert [r["equal"] for r in got.collect()] == equal


def test_positional_equals_of_other_types(spark):
    other = spark.createDataFrame([(0, "x")], "i long, image string")
    got = p.positional_equals(images(spark, 0, 1), other, "image", ["i"], ["i"])
    assert [r["equal"] for r in got.collect()] == [False, False]


def test_loader_pair(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")

    def shout(frame):
        return frame.assign(y=frame["y"] + "!")

    loaded = b.training_batches(b.transform_rows(df, shout, "x long, y string"), ["x"], 1)
    assert sorted((r["batch_id"], r["x"], r["y"]) for r in loaded.collect()) == [(0, 1, "a!"), (1, 2, "b!")]


def test_shuffle_is_a_permutation_and_repeatable(rows):
    def order(seed):
        got = b.training_batches(rows, ORDER, 16, shuffle_seed=seed, rows_per_block=100)
        return [(r["k"], r["i"]) for r in got.orderBy("idx").collect()]

    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == sorted(order(2))


def test_drop_last_and_shards(rows):
    got = b.training_batches(rows, ORDER, 64, drop_last=True, shards=4)
    assert got.rdd.getNumPartitions() == 4
    assert got.groupBy("batch_id").count().filter("count <> 64").isEmpty()
    assert got.count() == 960


def test_sampler_may_repeat_one_row(spark, rows, expected):
    picks = spark.range(300).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("idx"))
    got = b.sampled_batches(rows, ORDER, picks, 10, rows_per_block=100).orderBy("batch_id", "slot").collect()
    assert [(r["k"], r["i"]) for r in got] == [expected[7 if n % 3 == 0 else n] for n in range(300)]


def test_collate_with_python(rows):
    import pandas as pd

    def fold(batch):
        return pd.DataFrame({"batch_id": batch["batch_id"].head(1), "total": [batch["i"].sum()]})

    placed = b.training_batches(rows, ORDER, 100)
    got = b.collate_with(placed, fold, "batch_id long, total long").collect()
    assert len(got) == 10 and sum(r["total"] for r in got) == sum(range(1, 1001))


def test_fingerprint(spark):
    import hashlib

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "i long, t string").repartition(5)
    flat = "".join(digest(f"t{i}") for i in range(50))
    assert fingerprint(df, ["i"], "t").first()["digest"] == digest(flat)
    many = spark.createDataFrame([(i, f"t{i}") for i in range(600)], "i long, t string").repartition(5)
    groups = [digest("".join(digest(f"t{i}") for i in range(s, min(s + 256, 600)))) for s in range(0, 600, 256)]
    for per_block in (7, 5000):
        tree = fingerprint(many, ["i"], "t", rows_per_block=per_block).first()
        assert (tree["n_rows"], tree["digest"]) == (600, digest("".join(groups)))


def test_positions_from_the_end_and_out_of_range(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(4)], "i long, t string")
    picks = spark.createDataFrame([(0, 0), (1, -1), (2, 3), (3, -4)], "pos long, idx long")
    got = b.sampled_batches(df, ["i"], picks, 2).orderBy("batch_id", "slot").collect()
    assert [(r["idx"], r["t"]) for r in got] == [(0, "t0"), (3, "t3"), (3, "t3"), (0, "t0")]
    for wrong in (4, -5, None):
        with pytest.raises(Exception, match="out of range"):
            b.sampled_batches(df, ["i"], spark.createDataFrame([(0, wrong)], "pos long, idx long"), 2).collect()
    groups = spark.createDataFrame([(0, 0, 2), (0, 1, -2), (1, 0, 0)], "batch_id long, slot int, idx long")
    got = b.grouped_batches(df, ["i"], groups).orderBy("batch_id", "slot").collect()
    assert [r["t"] for r in got] == ["t2", "t2", "t0"]

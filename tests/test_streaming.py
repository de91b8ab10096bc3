import time

import pytest
from pyspark.sql import functions as F

from assetlake.operators import quality as q
from assetlake.operators import series
from assetlake.streaming import feeds


@pytest.fixture()
def parts(spark, lake):
    """300 readings of three hosts, one of them hot, in three files written one after the other."""
    df = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 2)).alias("host"),
        F.col("id").alias("seq"),
        (F.col("id") / 2).cast("long").alias("t"),
        (F.col("id") * F.col("id") * 10**8).alias("c"),
        F.when(F.col("id") % 7 == 0, 0.0).otherwise(2.0).alias("lim"),
    )
    for n in range(3):
        df.filter(F.col("seq").between(n * 100, n * 100 + 99)).coalesce(1).write.mode("append").parquet(f"{lake}/in")
        time.sleep(1.1)
    return df, f"{lake}/in"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_counter_rates_carry_their_baseline_over_batches(spark, lake, parts):
    df, path = parts
    stream = feeds.table_stream(spark, path, files_per_batch=1)
    columns = {"seq": "seq", "time": "t", "counter": "c", "limit": "lim"}
    feeds.counter_rates(stream, ["host"], columns, f"{lake}/out", f"{lake}/cp").awaitTermination()
    got = spark.read.parquet(f"{lake}/out")
    assert got.select("batch").distinct().count() == 3
    batch = series.counter_rate(df, ["host"], "seq", "t", "c", "lim")
    assert rows(got.select(batch.columns)) == rows(batch)
    starts = {r["host"]: r["t"] for r in df.groupBy("host").agg(F.min("t").alias("t")).collect()}
    assert all(r["x"] == r["t"] - starts[r["host"]] for r in got.collect())
    sampled = feeds.sampled_rates(spark, f"{lake}/out", ["host"], "seq")
    assert 0 < sampled.count() < got.count()
    assert sampled.groupBy("host", "step").count().filter("count > 1").isEmpty()


def test_tail_goes_on_where_it_stopped(spark, lake, parts):
    df, path = parts

    def read_on():
        lines = feeds.table_stream(spark, path).select("host", "seq")
        assert feeds.drain(feeds.tail(lines, f"{lake}/lines", f"{lake}/cp")) is None
        return spark.read.parquet(f"{lake}/lines").count()

    assert read_on() == 300
    assert read_on() == 300
    df.limit(5).write.mode("append").parquet(path)
    assert read_on() == 305


def test_following_stops_after_the_grace_period(spark, lake, parts):
    _, path = parts
    query = feeds.tail(feeds.table_stream(spark, path), f"{lake}/lines", f"{lake}/cp", follow=True)
    feeds.follow_until(query, lambda: True, grace=0.1)
    assert not query.isActive
    assert spark.read.parquet(f"{lake}/lines").count() == 300


def test_failing_batches_are_quarantined(spark, lake, parts):
    _, path = parts
    stream = feeds.table_stream(spark, path, files_per_batch=1)
    rules = [q.IsTrue("max(seq) < 200 OR min(seq) < 100", "early"), q.NotNull(["host"])]
    feeds.checked_sink(stream, rules, f"{lake}/good", f"{lake}/held", f"{lake}/reports", f"{lake}/cp").awaitTermination()
    assert spark.read.parquet(f"{lake}/good").agg(F.max("seq")).first()[0] == 199
    # Each file is a batch of 100 rows, and only the last one fails.
    assert spark.read.parquet(f"{lake}/good").count() == 200
    assert spark.read.parquet(f"{lake}/held").count() == 100
    assert rows(spark.read.parquet(f"{lake}/reports").filter("NOT passed").select("batch", "rule")) == [(2, "assert_true")]


def test_outcomes_over_batches(spark, lake, parts):
    _, path = parts
    history = feeds.table_stream(spark, path, files_per_batch=1).select(
        "host",
        "seq",
        F.lit("run").alias("source"),
        F.when((F.col("host") == "hot") & (F.col("seq") > 150), "FAILED").when(F.col("seq") == 250, "SUCCEEDED").otherwise("RUNNING").alias("status"),
        F.col("seq").cast("string").alias("info"),
    )
    feeds.fold_statuses(history, ["host"], "seq", f"{lake}/out", f"{lake}/cp").awaitTermination()
    got = feeds.current_outcomes(spark, f"{lake}/out", ["host"]).select("host", "outcome", "info")
    assert rows(got.fillna("")) == [("h0", "RUNNING", ""), ("h1", "RUNNING", ""), ("hot", "FAILED", "151")]


def test_counter_rates_go_on_after_a_restart(spark, lake, parts):
    df, path = parts
    columns = {"seq": "seq", "time": "t", "counter": "c", "limit": "lim"}

    def read_on(ttl=None):
        stream = feeds.table_stream(spark, f"{lake}/new")
        feeds.counter_rates(stream, ["host"], columns, f"{lake}/out", f"{lake}/cp", ttl=ttl).awaitTermination()
        return spark.read.parquet(f"{lake}/out")

    df.filter("seq < 120").coalesce(1).write.parquet(f"{lake}/new")
    read_on()
    df.filter("seq >= 120").coalesce(1).write.mode("append").parquet(f"{lake}/new")
    batch = series.counter_rate(df, ["host"], "seq", "t", "c", "lim")
    got = read_on()
    assert rows(got.select(batch.columns)) == rows(batch)
    assert got.filter("host = 'hot' AND batch > 0").agg(F.min("x")).first()[0] > 50  # counted from the first time of all


def test_keys_leave_the_state(spark, lake, parts):
    df, _ = parts
    columns = {"seq": "seq", "time": "t", "counter": "c", "limit": "lim"}

    def read_on(low, high):
        df.filter(F.col("seq").between(low, high)).coalesce(1).write.mode("append").parquet(f"{lake}/new")
        stream = feeds.table_stream(spark, f"{lake}/new")
        feeds.counter_rates(stream, ["host"], columns, f"{lake}/out", f"{lake}/cp", ttl=0.5).awaitTermination()

    read_on(0, 119)
    time.sleep(2)
    read_on(120, 299)
    halves = [series.counter_rate(df.filter(part), ["host"], "seq", "t", "c", "lim") for part in ("seq < 120", "seq >= 120")]
    got = spark.read.parquet(f"{lake}/out")
    assert rows(got.select(halves[0].columns)) == rows(halves[0].unionByName(halves[1]))
    assert got.filter("batch > 0").agg(F.min("x")).first()[0] < 5


def test_a_decision_stands_after_its_run_left_the_state(spark, lake):
    def read_on(*events):
        history = spark.createDataFrame(list(events), "run string, seq long, source string, status string, info string")
        history.coalesce(1).write.mode("append").parquet(f"{lake}/history")
        stream = feeds.table_stream(spark, f"{lake}/history")
        feeds.fold_statuses(stream, ["run"], "seq", f"{lake}/out", f"{lake}/cp", ttl=0.5).awaitTermination()
        got = feeds.current_outcomes(spark, f"{lake}/out", ["run"]).select("run", "outcome", "info")
        return rows(got.fillna(""))

    first = read_on(("a", 5, "task", "FAILED", "disk"), ("b", 1, "run", "RUNNING", None), ("a", 7, "run", "SUCCEEDED", None))
    assert first == [("a", "FAILED", "disk"), ("b", "RUNNING", "")]
    time.sleep(2)
    assert read_on(("a", 9, "run", "SUCCEEDED", None), ("b", 3, "run", "SUCCEEDED", None)) == [("a", "FAILED", "disk"), ("b", "SUCCEEDED", "")]


def test_windows_that_are_open_at_the_end_are_there(spark, lake):
    df = spark.createDataFrame([("u", 0, 10), ("u", 1, 20), ("u", 1, 6), ("v", 30, 5)], "user string, sec long, units long")
    df.select("user", F.timestamp_seconds("sec").alias("ts"), "units").coalesce(1).write.parquet(f"{lake}/in")
    rates = feeds.live_rate(feeds.table_stream(spark, f"{lake}/in"), ["user"], "ts", "units", "1 second")
    feeds.updated_rows(rates, f"{lake}/out", f"{lake}/cp").awaitTermination()
    got = feeds.last_written(spark, f"{lake}/out", ["user", "at"]).select("user", F.unix_seconds("at").alias("at"), "rate")
    want = [("u", 1, 10)] + [("u", at, 18) for at in range(2, 21)] + [("u", 21, 26)] + [("v", at, 5) for at in range(31, 51)]
    assert rows(got) == want
    with pytest.raises(ValueError):
        feeds.live_rate(rates, ["user"], "at", "rate", "1 second", window=64)


def test_outcomes_without_expiry_need_no_call_per_run(spark, lake, monkeypatch):
    monkeypatch.setattr(feeds.keyed, "with_state", None)
    events = [("a", 5, "task", "FAILED", "disk"), ("a", 7, "run", "SUCCEEDED", None), (None, 2, "run", "SUCCEEDED", None), ("b", 1, "run", "RUNNING", None)]
    for some in (events, [("a", 9, "run", "RUNNING", None), ("b", 3, "run", "SUCCEEDED", None)]):
        history = spark.createDataFrame(some, "run string, seq long, source string, status string, info string")
        history.coalesce(1).write.mode("append").parquet(f"{lake}/history")
        feeds.fold_statuses(feeds.table_stream(spark, f"{lake}/history"), ["run"], "seq", f"{lake}/out", f"{lake}/cp").awaitTermination()
    last = spark.read.parquet(f"{lake}/out/batch=1").select("run", "seq", "outcome", "info")
    assert rows(last.fillna("")) == [("a", 5, "FAILED", "disk"), ("b", 3, "SUCCEEDED", "")]
    got = feeds.current_outcomes(spark, f"{lake}/out", ["run"]).select("run", "outcome")
    assert rows(got.fillna("")) == [("", "SUCCEEDED"), ("a", "FAILED"), ("b", "SUCCEEDED")]


def test_live_rates_keep_two_rows_of_state_for_a_bucket(spark, lake):
    events = [("u", 0, 10), ("u", 21, None), ("u", 25, 7), ("u", 39, 4), (None, 40, 6), ("u", 61, 1)]
    for some in (events, [("u", 39, 8), ("u", 62, 3)]):
        df = spark.createDataFrame(some, "user string, sec long, units long").select("user", F.timestamp_seconds("sec").alias("ts"), "units")
        df.coalesce(1).write.mode("append").parquet(f"{lake}/in")
        rates = feeds.live_rate(feeds.table_stream(spark, f"{lake}/in"), ["user"], "ts", "units", "100 seconds", "1 second")
        query = feeds.updated_rows(rates, f"{lake}/out", f"{lake}/cp")
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * len(events)
    got = feeds.last_written(spark, f"{lake}/out", ["user", "at"]).select("user", F.unix_seconds("at").alias("at"), "rate")
    units = {"u": {0: 10, 21: None, 25: 7, 39: 12, 61: 1, 62: 3}, None: {40: 6}}
    want = []
    for user, buckets in units.items():
        for at in range(1, 90):
            inside = [n for sec, n in buckets.items() if at - 20 <= sec < at]
            if inside:
                known = [n for n in inside if n is not None]
                want.append((user, at, round(sum(known) / len(inside)) if known else None))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)

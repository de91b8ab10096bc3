import random

import pytest
from pyspark.sql import functions as F

from assetlake.functions import counters
from assetlake.operators import series as s
from assetlake.operators.scan import Running, running
from assetlake.operators.skew import lookup


@pytest.fixture(scope="module")
def readings():
    """Readings of three hosts, one of them with two thirds of all; times repeat and step back."""
    rnd = random.Random(5)
    rows = []
    for seq in range(600):
        host = rnd.choice(["hot", "hot", "hot", "hot", "a", "b"])
        rows.append((host, seq, seq // 3 + rnd.choice([-4, 0, 0, 2]), rnd.choice([0, seq * 10**9, seq * 10**9 + 7]), rnd.choice([0.0, 2.0])))
    return rows


def follow(rows):
    """The rules applied reading by reading."""
    base, out = {}, []
    for host, seq, t, counter, limit in rows:
        if host in base:
            last_t, last_counter = base[host]
            if t <= last_t:
                continue
            if counter and limit:
                out.append((host, seq, round((counter - last_counter) / (t - last_t) / 1e9, 4)))
        base[host] = (t, counter)
    return sorted(out)


@pytest.mark.parametrize("per_block", [20, 100, 10**6])
def test_counter_rate(spark, readings, per_block):
    df = spark.createDataFrame(readings, "host string, seq long, t long, c long, lim double").repartition(5)
    got = s.counter_rate(df, ["host"], "seq", "t", "c", "lim", per_block).collect()
    assert sorted((r["host"], r["seq"], r["used"]) for r in got) == follow(readings)


@pytest.mark.parametrize("per_block", [15, 10**6])
def test_running(spark, readings, per_block):
    df = spark.createDataFrame([(h, q, c % 97) for h, q, _, c, _ in readings], "host string, seq long, v long")
    values = [Running("total", "sum", F.col("v")), Running("low", "min", F.col("v"), inclusive=False)]
    got = {(r["host"], r["seq"]): (r["total"], r["low"]) for r in running(df, ["host"], ["seq"], values, per_block).collect()}
    totals, lows = {}, {}
    for host, seq, _, c, _ in readings:
        v = c % 97
        totals[host] = totals.get(host, 0) + v
        assert got[(host, seq)] == (totals[host], lows.get(host))
        lows[host] = min(v, lows.get(host, v))


def test_trailing_rate_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(s, "CHUNK", 32)
    rnd = random.Random(3)
    seconds = sorted(rnd.sample(range(500), 200))
    df = spark.createDataFrame([("h", t, t + 5) for t in seconds], "host string, sec long, units long")
    got = {r["sec"]: r["rate"] for r in s.trailing_rate(df, ["host"], "sec").collect()}
    for t in seconds:
        seen = [u + 5 for u in seconds if t - 20 <= u < t]
        assert got[t] == (round(sum(seen) / len(seen)) if seen else 0)


def test_eta_is_zero_without_a_rate(spark):
    rates = spark.createDataFrame([("h", 1, 10, 0), ("h", 2, 10, 4)], "host string, sec long, units long, rate long")
    totals = spark.createDataFrame([("h", 50)], "host string, total long")
    got = s.transfer_eta(rates, totals, ["host"], "sec").orderBy("sec").collect()
    assert [r["eta"] for r in got] == [0, 8]  # 30 / 4 = 7.5 rounds to even


def test_sampling_grid(spark):
    df = spark.createDataFrame([(float(v),) for v in (0.9, 14.9, 15, 19.9, 59, 60, 74.9, 75)], "e double")
    assert [r[0] for r in df.select(s.sampling_grid(F.col("e"))).collect()] == [0, 14, 15, 15, 55, 60, 60, 75]


def test_counter_text(spark):
    rows = [("usage_usec 5\nuser_usec 12\n", "max 100000", "max\n"), ("usage_usec 5\n", "150000 100000", "1024"), (None, "7", None), (None, None, "x")]
    df = spark.createDataFrame(rows, "stat string, cpu string, mem string")
    got = df.select(
        counters.user_time_ns(F.col("stat")), counters.quota(F.col("cpu")), counters.memory_limit(F.col("mem"), F.lit(99))
    ).collect()
    assert [tuple(r) for r in got] == [(12000, 1.0, 99), (0, 1.5, 1024), (0, 0.0, 0), (0, 0.0, None)]


@pytest.mark.parametrize("weighted", [False, True])
def test_lookup_with_hot_null_and_missing_keys(spark, weighted, monkeypatch):
    from assetlake.operators import skew

    monkeypatch.setattr(skew, "HOT_SHARE", 0.15)
    keys = ["hot"] * 300 + [None] * 200 + ["gone"] * 200 + [f"k{i % 60}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(keys)), "id long, k string").repartition(6)
    dim_rows = [("hot", 1), (None, 2)] + [(f"k{i}", 10 + i) for i in range(50)]
    dim = spark.createDataFrame(dim_rows, "k string, v long")
    if weighted:
        dim = dim.withColumn("n", F.when(F.col("k") == "hot", 300).otherwise(5))
    want = dict(dim_rows)
    got = lookup(df, dim, ["k"], weight="n" if weighted else None).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(i, want.get(k)) for i, k in enumerate(keys)]
    inner = lookup(df, dim, ["k"], how="inner", weight="n" if weighted else None)
    assert inner.count() == sum(k in want for k in keys)

"""Hard negatives against a plain version that scores everything."""

import math
import random

import numpy as np
import pytest

from assetlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label string, `part` string, `row` long, kind map<string,int>"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    good = [
        r for r in rows
        if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]

    def score(a, b):
        return sum(int(x) * int(y) for x, y in zip(a, b))

    def order(pair):
        return (-pair[0], pair[1] is None, pair[1] or 0)

    out = []
    for i, a in enumerate(good):
        if a[0] is None or a[0] % every:
            continue
        scored = [(score(a[1], b[1]), b[0], b[2]) for j, b in enumerate(good) if j != i]
        best = sorted([s for s in scored if s[2] == a[2]], key=order)[:positives]
        for p in best:
            fit = [s for s in scored if s[2] != a[2] and low * p[0] <= 100 * s[0] <= high * p[0]]
            for rank, n in enumerate(sorted(fit, key=order)[:negatives], 1):
                out.append((a[0], p[1], rank, n[1], p[0], n[0]))
    return sorted(out, key=repr)


def table(rng, n=700, dim=12):
    """Vectors around few centres, of very different lengths, with ties, copies and every odd case."""
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + 0.6 * rng.normal(size=dim)
        v = np.floor(20 * v * rng.choice([0.05, 1, 1, 1, 40]))
        rows.append((i - 40, v.tolist(), "hot" if i % 3 == 0 else f"l{rng.integers(4)}", "p", 1, {"a": 1}))
    same = rows[50][1]
    rows += [(1000 + i, same, "hot" if i % 2 else "l1", None, None, None) for i in range(300)]
    rows += [rows[40], rows[140], rows[140], rows[141], (None, rows[40][1], "hot", "", 0, {}), (None, rows[40][1], "l2", "", 0, {})]
    rows += [(2000, None, "hot", "", 0, {}), (2100, same, None, "", 0, {}), (2200, [1.0, None], "l1", "", 0, {})]
    rows += [(2300, [float("nan")] * dim, "l1", "", 0, {}), (2400, [float("inf")] + [0.0] * (dim - 1), "l1", "", 0, {})]
    rows += [(2500, [], "hot", "", 0, {}), (2600, [0.0] * dim, "l1", "", 0, {}), (2700, [7.0] * (dim // 2), "l1", "", 0, {})]
    rows += [(2800, [float(2**30)] * dim, "l3", "", 0, {}), (2801, [float(2**27 + 1)] * dim, "l3", "", 0, {})]
    rows += [(2802, [float(2**19)] * dim, "hot", "", 0, {})]
    return rows


@pytest.mark.parametrize("part_bytes, bucket", [(1 << 25, 4096), (9_000, 16)])
def test_against_brute_force(spark, monkeypatch, part_bytes, bucket):
    monkeypatch.setattr(hn, "PART_BYTES", part_bytes)
    monkeypatch.setattr(hn, "SEED_BYTES", part_bytes // 2)
    monkeypatch.setattr(hn, "BUCKET", bucket)
    rows = table(np.random.default_rng(3))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in hn.hard_negatives(df, every=20).collect()), key=repr)
    want = brute(rows, every=20)
    assert len(want) > 1000 and got == want


def test_feasible_ranges_never_lose_a_row():
    rng = np.random.default_rng(8)
    vectors = np.floor(100 * rng.normal(size=(400, 9)))
    vectors[5] = 0
    norms = np.sqrt((vectors**2).sum(axis=1))
    order = np.argsort(-norms)
    bucket = hn.Bucket(vectors[order], norms[order], 0)
    pruned = 0
    for _ in range(200):
        q = np.floor(100 * rng.normal(size=9))
        exact = bucket.vectors @ q
        needed = float(random.Random(int(q[0])).choice(sorted(exact)[-10:]))
        focus = np.argsort(-np.abs(q))[: hn.FOCUS]
        at, scores = bucket.search(q, float(np.sqrt(q @ q)), focus, needed)
        assert set(np.flatnonzero(exact >= needed)) <= set(at) and (exact[at] == scores).all()
        pruned += len(exact) - len(at)
    assert pruned > 10_000


def test_nothing_and_no_positives(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(empty).count() == 0
    lonely = spark.createDataFrame([(100, [1.0, 2.0], "a"), (101, [1.0, 2.0], "b")], "vec_id long, embedding array<float>, label string")
    assert hn.hard_negatives(lonely).count() == 0


def test_floor_of_scaled_components(spark):
    values = [0.1, -0.1, 1e30, -1e30, 2.0**52, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(hn.floor_scaled(df.x, 256)).collect()]
    assert got == [25.0, -26.0, 256e30, -256e30, 2.0**60, None, None, None]

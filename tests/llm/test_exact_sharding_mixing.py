import zlib
from collections import Counter, defaultdict

from brute import equal_groups, split

from assetlake.llm import exact_dedup, mixing, sharding
from assetlake.llm.queries import ORACLES, QUERIES
from compare import duck, duck_table, spark_table

SMALL = "/root/testdata/sf0.001"


def test_exact_groups(docs, rows):
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == equal_groups([r[:2] for r in rows])


def test_a_full_filter_costs_work_only(docs, rows):
    flagged, hashed = exact_dedup.refine(docs, "doc_id", "text", bits=6)
    sparse, few = exact_dedup.refine(docs, "doc_id", "text")
    assert few.count() < hashed.count() and flagged.count() == sparse.count() == len(rows)
    assert {tuple(r) for r in few.collect()} <= {tuple(r) for r in hashed.collect()}


def test_exact_dedup_keeps_one_whole_row_of_each(docs, rows):
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert set(got) <= set(rows) and exact_dedup.exact_dedup(docs).columns == docs.columns
    want = Counter(keep for _, keep, _, _ in {(g[1], *g[1:]) for g in equal_groups([r[:2] for r in rows])})
    texts = {" ".join(split(r[1])) for r in rows}
    assert {" ".join(split(g[1])) for g in got} == texts and set(want) == {g[0] for g in got}
    assert len(got) == len({exact_key(r) for r in rows})


def exact_key(row):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")


def test_exact_of_nothing(nothing, odd):
    assert exact_dedup.exact_groups(nothing).isEmpty() and exact_dedup.exact_dedup(nothing).isEmpty()
    assert {tuple(r) for r in exact_dedup.exact_groups(odd).collect()} == {(1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False), (4, 4, 1, True)}
    assert sorted(r["doc_id"] for r in exact_dedup.exact_dedup(odd).collect()) == [1, 4]


def test_shards(docs, rows):
    got = sharding.shard(docs, 7, bucket_rows=20).collect()
    assert Counter(tuple(r)[:-2] for r in (g[: len(rows[0])] + (0, 0) for g in map(tuple, got))) == Counter(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] is not None]
    again = [r["doc_id"] for r in sharding.shard(docs, 7, bucket_rows=20, seed=1).orderBy("shard", "slot").collect() if r["doc_id"] is not None]
    assert order != sorted(order) and order != again


def test_shards_are_shuffled_within_and_across_buckets(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    got = [r["doc_id"] for r in sharding.shard(df, 4, bucket_rows=1_000).orderBy("shard", "slot").collect()]
    # Mean and spread of the first shard are those of a uniform sample; neighbours are unrelated.
    first = got[:5_000]
    assert abs(sum(first) / 5_000 - 10_000) < 400
    near = sum(abs(a - b) < 200 for a, b in zip(got, got[1:]))
    assert near < 3 * 20_000 * 400 / 20_000


def test_shards_written(docs, lake):
    sharding.write_shards(sharding.shard(docs, 3), lake)
    assert docs.sparkSession.read.parquet(lake).groupBy("shard").count().count() == 3


def test_shards_of_nothing(nothing, odd):
    assert sharding.shard(nothing, 4).isEmpty()
    assert sorted((r["shard"], r["slot"]) for r in sharding.shard(odd, 8).collect()) == [(0, 0), (2, 0), (4, 0), (6, 0)]
    again = sharding.shard(sharding.shard(odd, 2), 2)
    assert again.columns.count("shard") == 1 and again.count() == 4


def reshared(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def test_mix(docs, rows):
    planned = mixing.plan_mix(docs, carry=["doc_id", "source", "text"], rows_per_block=7).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    want, taken, largest = reshared(sizes), defaultdict(int), defaultdict(int)
    assert len(planned) == len(rows)
    for r in planned:
        source = r["row"]["source"]
        assert r["size"] == len(split(r["row"]["text"])) and r["source_size"] == sizes[source]
        assert abs(r["target"] - want[source]) < 1e-6 * (1 + want[source])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    once = mixing.plan_mix(docs, carry=["doc_id", "source", "text"]).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, planned))


def test_mixed_rows_come_in_training_order(docs):
    mixed = mixing.mix(docs)
    got = mixed.collect()
    assert mixed.columns == [*docs.columns, "_position"]
    at = [r["_position"] for r in got]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    planned = mixing.plan_mix(docs, carry=["doc_id"]).collect()
    assert len(got) == sum(r["copies"] for r in planned)


def test_mixing_query_places_every_copy_in_training_order(spark, docs):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    at = defaultdict(list)
    for r in mixing.mix(table).collect():
        at[r["doc_id"]].append(r["position"])
    got = QUERIES["op8_mixing"](spark, SMALL).collect()
    assert len(got) == table.count()
    assert all(r["taken"] == len(at[r["doc_id"]]) * r["size"] for r in got)
    first = [min(at[r["doc_id"]], default=2.0) for r in got]
    assert first == sorted(first) and first[0] < 0.1 and 0.5 < max(p for p in first if p <= 1) <= 1
    planned = mixing.plan_mix(docs, carry=["doc_id", "text"])
    placed = mixing.mix_plan(planned).collect()
    plain = ["row", "size", "source_size", "target", "copies", "taken"]
    assert Counter(tuple(r[c] for c in plain) for r in placed) == Counter(tuple(r[c] for c in plain) for r in planned.collect())
    every = sorted(p for r in placed for p in r["places"] or [])
    assert every == sorted(r["_position"] for r in mixing.mix(docs).collect())


def test_positions_follow_the_schedule(spark):
    from pyspark.sql import functions as F

    for knots in mixing.SCHEDULES:
        u = spark.range(1001).select((F.col("id") / 1000).alias("u"))
        got = u.select("u", mixing.inverse_demand(F.col("u"), knots).alias("t")).orderBy("u").collect()
        area = sum((t1 - t0) * (m0 + m1) / 2 for (t0, m0), (t1, m1) in zip(knots, knots[1:]))
        for r in got:
            done = 0.0
            for (t0, m0), (t1, m1) in zip(knots, knots[1:]):
                if r["t"] > t0:
                    t = min(r["t"], t1)
                    m = m0 + (m1 - m0) * (t - t0) / (t1 - t0)
                    done += (t - t0) * (m0 + m) / 2
            assert abs(done / area - r["u"]) < 1e-9


def test_mix_of_nothing(nothing, odd):
    assert mixing.plan_mix(nothing).isEmpty() and mixing.mix(nothing).isEmpty() and mixing.mix(odd).isEmpty()
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.plan_mix(odd).collect()] == [(0, 0.0, 0)] * 4


def test_queries_equal_their_sql(spark):
    con = duck(SMALL)
    for name, sql in ORACLES.items():
        assert spark_table(QUERIES[name](spark, SMALL)) == duck_table(con, sql), name


def test_sharding_query(spark):
    got = QUERIES["op6_sharding"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts) and {r["law"] for r in got} == {"rows"}
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), None)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1

import pytest
from pyspark.sql import functions as F

from assetlake.operators.skew import HOT_SHARE, hot_keys, lookup
from assetlake.session import cut_lineage
from assetlake.sources import files


@pytest.fixture()
def plain_joins(spark):
    """No broadcast but the asked-for ones, and 32 shuffle partitions as they are."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest(df):
    """Rows of the largest partition over the mean of those that have rows."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / (sum(sizes) / len(sizes))


@pytest.fixture()
def facts(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id") % 20_011)
    return cut_lineage(spark.range(120_000).select(F.col("id"), hot.alias("k")).repartition(8), "facts")


def test_no_partition_holds_a_hot_key(spark, plain_joins, facts):
    dim = cut_lineage(spark.range(20_011).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.sql("SELECT null, -1L")), "dim")
    counted = cut_lineage(facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "counted")
    for found in (lookup(facts, dim, ["k"]), lookup(facts, counted, ["k"], weight="n")):
        assert largest(found) <= 2
        assert found.count() == 120_000
    got = lookup(facts, dim, ["k"], how="inner")
    assert got.filter("NOT v <=> coalesce(k * 2, -1)").isEmpty() and got.count() == 120_000


def test_hot_keys(spark, facts):
    shares = hot_keys(facts, ["k"])
    null = spark.sql("SELECT xxhash64(cast(null as bigint))").first()[0]
    assert list(shares) == [null] and abs(shares[null] - 1 / 3) < HOT_SHARE
    even = spark.range(50_000).select((F.col("id") % 25_000).alias("k"))
    assert hot_keys(even, ["k"]) == {} and hot_keys(even.limit(0), ["k"]) == {}


def test_a_repeated_row_is_dealt_over_the_input_partitions(spark, plain_joins):
    rows = spark.range(0, 64_000, 1, 64).selectExpr("if(id % 3 = 0, 7, id) AS k", "1 AS v")
    dim = cut_lineage(spark.range(64_000).selectExpr("id AS k", "id + 1 AS w"), "dim")
    found = lookup(rows, dim, ["k"])
    assert largest(found) <= 2.5 and found.filter("w <> k + 1 OR w IS NULL").isEmpty()


def scans(df):
    """Input files read by a query, as often as each is scanned."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation ")


def test_each_side_is_read_once_after_the_sketch(spark, plain_joins, facts):
    dim = cut_lineage(spark.range(20_011).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "dim")
    assert scans(lookup(facts, dim, ["k"])) == 2


def test_rows_without_a_partner(spark, facts):
    dim = spark.createDataFrame([(5, "five")], "k long, v string")
    left = lookup(facts, dim, ["k"])
    assert left.count() == 120_000 and left.filter("v IS NOT NULL").count() == facts.filter("k = 5").count()
    assert lookup(facts, dim, ["k"], how="inner").count() == facts.filter("k = 5").count()
    with pytest.raises(ValueError):
        lookup(facts, dim, ["k"], how="outer")


def test_cache_plan_with_half_the_checksums_empty(spark, plain_joins):
    text = F.when(F.col("id") % 2 == 0, "").otherwise(F.md5((F.col("id") % 50_000).cast("string")))
    manifest = cut_lineage(spark.range(120_000).select(F.col("id").alias("location"), text.alias("checksum"), F.lit("parquet").alias("format")).repartition(32), "manifest")
    plan = files.cache_plan(manifest, manifest.limit(10), "location")
    assert largest(plan) <= 2 and plan.filter("action = 'remote'").count() == 60_000

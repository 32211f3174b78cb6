import pytest
from pyspark.sql import functions as F

from timbrel.operators import results, skew, uploads


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _large(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 4000))
    return spark.range(0, 30000, 1, 16).select(key.alias("k"), "id")


def test_hot_keys_are_found(spark):
    assert skew.hot_keys(_large(spark), "k") == ["hot"]
    assert skew.hot_keys(spark.range(1000).withColumn("k", F.col("id")), "k") == []
    assert skew.hot_keys(spark.range(0).withColumn("k", F.col("id")), "k") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_same_rows_as_a_plain_join(spark, no_broadcast, how):
    large = _large(spark)
    lookup = large.filter("k = 'hot' OR id % 7 = 0").groupBy("k").agg(F.max("id").alias("m"))
    plain = large.join(lookup, "k", how)
    spread = skew.join_spread(large, lookup, "k", how)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    assert spread.columns == plain.columns


def test_a_hot_key_is_joined_by_many_tasks(spark, no_broadcast):
    large = _large(spark)
    lookup = large.groupBy("k").agg(F.max("id").alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = (
            skew.join_spread(large, lookup, "k", "left")
            .filter("k = 'hot'")
            .groupBy(F.spark_partition_id().alias("task"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(t["count"] for t in tasks) == 10000
    assert len(tasks) >= 4 and max(t["count"] for t in tasks) < 6000


def test_operators_on_a_hot_key(spark, no_broadcast):
    large = _large(spark)
    done = large.filter("id % 2 = 0")
    left = results.skip_existing(large, done, "k")
    assert left.filter("k = 'hot'").count() == 0
    assert left.count() == large.join(done.select("k").distinct(), "k", "left_anti").count()
    accepted = uploads.accept_prefix(large.filter("k IS NOT NULL"), "k", "id", F.col("id") != 15000).filter("accepted")
    assert accepted.filter("k = 'hot'").count() == 5000

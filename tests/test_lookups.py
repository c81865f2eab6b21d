import pytest
from pyspark.sql import functions as F

from framekeel.operators.lookups import per_key

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200)
    return spark.range(0, 200_000, 1, 8).select("id", key.alias("k"), F.lit("s").alias("t"))


def test_hot_key_is_split_in_the_join_back(spark, small_partitions):
    df = rows(spark)
    joined = df.join(per_key(df, ["k"], F.count("*").alias("n")), "k")
    # Summing the ids keeps them in the shuffle, which would otherwise hold next to nothing.
    checked = joined.agg(F.count("*"), F.max("n"), F.sum("id"))
    expected = df.groupBy("k").count().agg(F.max("count")).first()[0]
    assert tuple(checked.collect()[0]) == (200_000, expected, sum(range(200_000)))
    assert "SortMergeJoin(skew=true)" in checked._jdf.queryExecution().executedPlan().toString()


def test_distinct_keys(spark):
    df = rows(spark)
    keys = per_key(df, ["k", "t"])
    assert keys.columns == ["k", "t"]
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, df.select("k", "t").distinct().collect()))

"""Ordered operators against plain windows, and the join that AQE can split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from attestry.operators.segments import Ordered, broadcast_if_small, join_on_key, latest_per_key, neighbour, numbered, spread


def skewed(spark, n=3000):
    """A third of the rows share one key; some keys and values are null."""
    i = F.col("id")
    return spark.range(n).select(
        i,
        F.when(i % 3 == 0, F.lit(7)).when(i % 50 == 1, F.lit(None)).otherwise(i % 40).cast("bigint").alias("k"),
        ((i * 7919) % 500).alias("t"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), i.cast("string"))).alias("v"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=[1, 2, 7, 40])
def ranges(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_neighbour_is_a_lag(spark, ranges):
    df = skewed(spark)
    got = neighbour(df, ["k"], ["t", "id"], ["v", "id"])
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumns({"prev_v": F.lag("v").over(w), "prev_id": F.lag("id").over(w)})
    assert rows(got) == rows(want.select(got.columns))


def test_neighbour_forward_and_where(spark, ranges):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    # Matches that are rare leave whole ranges of a key without one.
    for where in (F.col("v").isNotNull(), F.col("id") % 977 == 5):
        later = F.first(F.when(where, F.col("id")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
        got = neighbour(df, ["k"], ["t", "id"], ["id"], where=where, forward=True)
        assert rows(got) == rows(df.withColumn("prev_id", later).select(got.columns))
        earlier = F.last(F.when(where, F.col("id")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        got = neighbour(df, ["k"], ["t", "id"], ["id"], where=where)
        assert rows(got) == rows(df.withColumn("prev_id", earlier).select(got.columns))


def test_neighbour_without_key_on_nulls_and_empty(spark, ranges):
    df = skewed(spark, 400)
    w = Window.partitionBy(F.lit(1)).orderBy("v", "id")
    assert rows(neighbour(df, [], ["v", "id"], ["id"])) == rows(df.withColumn("prev_id", F.lag("id").over(w)))
    assert neighbour(df.limit(0), ["k"], ["t", "id"], ["id"]).collect() == []
    assert rows(numbered(df.limit(1), ["k"], ["t", "id"], "n"))[0][-1] == 1


def test_numbered(spark, ranges):
    df = skewed(spark)
    got = numbered(df, ["k"], ["t", "id"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("bigint"))
    assert rows(got) == rows(want)
    everything = numbered(df, [], ["id"], "n")
    assert rows(everything) == rows(df.withColumn("n", F.row_number().over(Window.orderBy("id")).cast("bigint")))


def test_a_hot_key_in_one_instant_is_spread_evenly(spark):
    """A third of all rows have one key and one day; ranges are even all the same."""
    df = spark.range(0, 60_000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date").alias("day"),
    )
    dealt = Ordered(df, ["k"], ["day", "id"], 16).dealt
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.5 * 60_000 / 16


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once(spark):
    """Whatever is asked of the dealt rows: one exchange of rows, from which the carries are taken too."""
    df = skewed(spark)
    one = neighbour(df, ["k"], ["t", "id"], ["v"])
    several = Ordered(df, ["k"], ["t", "id"]).neighbour(["v"]).neighbour(["id"], prefix="next_", forward=True).numbered("n").rows()
    for plan in (final_plan(one), final_plan(several)):
        final = plan.split("Initial Plan")[0]
        assert len(set(re.findall(r"Exchange shufflepartitionidpassthrough.*?plan_id=(\d+)", final))) == 1
        # No other exchange holds rows: the rest are the sample, one edge per range and their broadcast.
        assert "hashpartitioning(k" not in final and "rangepartitioning" not in final


def test_latest_per_key_is_limited_before_the_shuffle(spark):
    newest = latest_per_key(skewed(spark), ["k"], ["t", "id"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert newest.count() == skewed(spark).select("k").distinct().count()


def test_join_on_key_keeps_null_keys_and_lets_aqe_split_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        big = spark.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
        big = big.withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
        counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        total = join_on_key(big, counts, ["k"], "left").agg(F.sum("n").alias("s"), F.max("pad").alias("m"))
        plain = big.join(counts, "k", "left").agg(F.sum("n").alias("s"), F.max("pad").alias("m"))
        assert total.collect() == plain.collect()
        assert "SortMergeJoin(skew=true)" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    df = skewed(spark)
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = join_on_key(df, stats, ["k"], "left", nulls_match=True)
    assert joined.count() == df.count()
    assert joined.filter("n IS NULL").isEmpty()
    plain = join_on_key(df, stats, ["k"], "left")
    assert plain.count() == df.count()
    assert plain.filter("n IS NULL").count() == df.filter("k IS NULL").count() > 0


def test_broadcast_only_after_counting(spark):
    small = spark.range(10)
    assert "broadcast" in broadcast_if_small(small, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(small, 10, size=50)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(small, 9)._jdf.queryExecution().logical().toString()


def test_spread(spark):
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() >= 8
    assert spread(spark.range(0, 100, 1, 50)).rdd.getNumPartitions() == 50

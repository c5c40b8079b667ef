"""One key holds most rows: the joins split it, and groupings shrink it before the shuffle."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fx, links, reconcile, star
from tidemark.operators.hierarchy import _double

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def lopsided(spark, rows=60_000, keys=200):
    """Half of all rows carry key 0."""
    return spark.range(0, rows, 1, 8).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % keys).cast("bigint").alias("key")
    )


def splits(df, expected_rows):
    assert df.count() == expected_rows
    df.write.format("noop").mode("overwrite").save()
    frame = df.select("*")
    frame.collect()
    return "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def test_member_status(skewed):
    members = lopsided(skewed).select(F.col("id").alias("group_id"), F.col("key").alias("user_id"))
    users = skewed.range(200).select(F.col("id").alias("user_id"), F.lit("active").alias("status"))
    assert splits(links.member_status(members, users), 60_000)


def test_junction(skewed):
    fact = lopsided(skewed).select(F.col("id").alias("transaction_id"), F.col("key").alias("card_id"))
    cards = skewed.range(200).select(F.col("id").alias("card_id"), F.lit("x").alias("card_name"))
    assert splits(star.junction(fact, cards, "transaction_id", "card_id"), 60_000)


def test_conversion(skewed):
    txns = lopsided(skewed).select(
        F.col("id").alias("transaction_id"), F.lit("EUR").alias("currency_code"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("key").cast("int")).alias("transaction_date"),
        F.lit(1).cast("decimal(18,2)").alias("original_amount"),
    )
    rates = skewed.range(200).select(
        F.lit("EUR").alias("currency"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("rate_date"), F.lit(2.0).alias("rate"),
    )
    assert splits(fx.convert_currency(txns, rates), 60_000)


def test_replaced_children(skewed):
    stored = lopsided(skewed).select(F.col("key").alias("p"), F.col("id").alias("c"))
    batch = skewed.range(100, 200).select(F.col("id").alias("p"), F.col("id").alias("c"))
    gone = stored.filter("p >= 100").count()
    assert splits(reconcile.replace_children(stored, batch, "p"), 60_000 - gone + 100)


def test_jumps_through_one_ancestor(skewed):
    jumps = lopsided(skewed).select((F.col("id") + 1000).alias("child"), F.col("key").alias("parent")).unionByName(
        skewed.range(200).select(F.col("id").alias("child"), F.lit(5000).cast("bigint").alias("parent"))
    )
    doubled = _double(jumps)
    assert doubled.count() >= 60_000


def test_activity_and_survivors_shrink_before_the_shuffle(skewed):
    members = lopsided(skewed).select(F.col("key").alias("group_id"), F.lit("active").alias("user_status"))
    plan = links.direct_activity(members)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan[plan.index("Exchange"):]
    one = reconcile.dedup_latest(lopsided(skewed), ["key"], ["id"])
    assert one.filter("key = 0").first().id == 59_998

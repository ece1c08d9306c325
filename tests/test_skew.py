"""A hot key / hot content group holding a third of all rows: results stay whole and
exact, and the plans aggregate partially before the shuffle."""

from pyspark.sql import functions as F

from letwise.operators.dedup import content_dedup, latest_per_key
from letwise.operators.joins import skip_known


def hot_frame(spark, n=30000):
    # a third of the rows share key 'hot' and identical content
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("o"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id").cast("double")).alias("rent"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("x")).alias("region"),
    ).repartition(8)


def test_latest_per_key_hot_key(spark):
    df = hot_frame(spark)
    out = latest_per_key(df, ["k"], ["o"])
    assert out.count() == 20001
    assert out.where("k = 'hot'").first().o == 29997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_content_dedup_hot_group(spark):
    df = hot_frame(spark).withColumn("ads_id", F.col("o").cast("string")).drop("k", "o")
    out = content_dedup(df, ["rent", "region"])
    assert out.count() == 20001
    assert out.where("region IS NULL").first().ads_id == "0"
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_skip_known_hot_duplicate_ids(spark):
    inc = spark.range(1000).select(F.col("id").cast("string").alias("ads_id"))
    known = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("5")).otherwise(F.lit("7")).alias("ads_id"))
    out = skip_known(inc, known)
    assert out.count() == 998
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "HashAggregate" in plan

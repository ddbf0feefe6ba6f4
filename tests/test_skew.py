"""The split forms for hot keys give what the plain forms give."""

import random

import pytest
from pyspark.sql import functions as F

from chainloom.functions import skew


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}"
        data.append((key, i, rng.choice([1, 3, None])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, at long, op int").persist()


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_row_position(rows):
    plain = skew.row_position(rows, ["key"], ["at"]).select("key", "at", "position")
    split = skew.row_position(rows, ["key"], ["at"], limit=50).select("key", "at", "position")
    assert result(plain) == result(split)
    assert plain.filter("key = 'hot'").agg(F.max("position")).first()[0] > 1000


def test_row_position_keeps_null_keys(spark):
    frame = spark.createDataFrame([(None, i) for i in range(20)], "key string, at long")
    split = skew.row_position(frame, ["key"], ["at"], limit=5)
    assert sorted(r["position"] for r in split.collect()) == list(range(20))


def test_previous_value(rows):
    plain = skew.previous_value(rows, ["key"], ["at"], F.col("op"), out="before")
    split = skew.previous_value(rows, ["key"], ["at"], F.col("op"), out="before", limit=50)
    columns = ["key", "at", "op", "before"]
    assert result(plain.select(*columns)) == result(split.select(*columns))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_group_stats(rows, how):
    stats = rows.filter("op = 3").groupBy("key").agg(F.count("*").alias("n"))
    plain = skew.join_group_stats(rows, stats, ["key"], how=how)
    split = skew.join_group_stats(rows, stats, ["key"], how=how, limit=100)
    assert result(plain) == result(split)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_group_profile(spark, rows):
    largest, total = skew.group_profile(rows, ["key"])
    assert total == 3000 and largest > 1000
    assert skew.group_profile(rows.limit(0), ["key"]) == (0, 0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_lookup_beyond_its_bound(rows, how):
    lookup = rows.filter("op = 3").select("key").distinct().withColumn("found", F.lit(True))

    def hinted(frame):
        return "strategy=broadcast" in frame._jdf.queryExecution().logical().toString().lower()

    small = skew.join_lookup(rows, lookup, ["key"], how=how)
    large = skew.join_lookup(rows, lookup, ["key"], how=how, bound=3)
    split = skew.join_lookup(rows, lookup, ["key"], how=how, bound=3, limit=100)
    assert hinted(small) and not hinted(large)
    assert result(small) == result(large) == result(split)


def test_checkpoint_dir_is_the_configured_one(spark):
    assert skew.ensure_checkpoint_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_broadcast_is_bound_by_bytes(spark):
    frame = spark.createDataFrame([("x" * 50, ["y" * 40]), (None, None)], "a string, b array<string>")
    assert skew.fits_broadcast(frame, 2, 1000)
    assert not skew.fits_broadcast(frame, 1, 1000)
    assert not skew.fits_broadcast(frame, 2, 100)
    assert skew.fits_broadcast(frame.limit(0), 0, 0)

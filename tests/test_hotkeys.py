import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from coinslot.operators import hotkeys


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [("hot" if i % 3 else f"k{i % 20}", i, rng.randrange(40), rng.choice([None, i])) for i in range(400)]
    data += [(None, 1000 + i, i, i) for i in range(30)]
    return spark.createDataFrame(data, "k string, id int, o int, v int")


def as_set(df):
    return sorted(map(str, df.collect()))


def test_no_hot_key(rows):
    assert hotkeys.find_hot_keys(rows, ["k"], "o", 1000) is None


def test_hot_keys_are_the_large_ones_including_null(rows):
    hot = hotkeys.find_hot_keys(rows, ["k"], "o", 25)
    assert {r["_k_k"] for r in hot.collect()} == {"hot", None}


def test_slices_are_bounded(rows):
    hot = hotkeys.find_hot_keys(rows, ["k"], "id", 25)
    sliced = hotkeys._slice(rows, hot, ["k"], ["id"])
    assert sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0] <= 30
    assert sliced.count() == rows.count()


@pytest.mark.parametrize("limit", [3, 25])
def test_next_in_key(rows, limit):
    hot = hotkeys.find_hot_keys(rows, ["k"], "id", limit)
    got = hotkeys.next_in_key(rows, ["k"], "id", ["o", "v"], "n", hot)
    plain = rows.withColumn("n", F.lead(F.struct("o", "v")).over(Window.partitionBy("k").orderBy("id")))
    assert as_set(got.select(*plain.columns)) == as_set(plain)


@pytest.mark.parametrize("limit", [3, 25])
def test_newest_rank(rows, limit):
    hot = hotkeys.find_hot_keys(rows, ["k"], "o", limit, ["id"], newest_first=True)
    got = hotkeys.newest_rank(rows, ["k"], "o", ["id"], "n", hot)
    plain = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o"), "id")))
    assert as_set(got.select(*plain.columns)) == as_set(plain)


@pytest.mark.parametrize("limit", [3, 25])
def test_last_known(rows, limit):
    hot = hotkeys.find_hot_keys(rows, ["k"], "o", limit, ["id"])
    got = hotkeys.last_known(rows, ["k"], "o", ["id"], "v", "n", hot)
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumn("n", F.last("v", ignorenulls=True).over(w))
    assert as_set(got.select(*plain.columns)) == as_set(plain)


@pytest.mark.parametrize("newest_first", [False, True])
def test_ties_are_split(spark, newest_first):
    """Two distinct days, some of them unknown: slices still stay below the limit."""
    day = F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 2)
    rows = spark.range(20_000).select(F.lit("a").alias("k"), day.alias("o"), "id")
    hot = hotkeys.find_hot_keys(rows, ["k"], "o", 1000, ["id"], newest_first)
    sliced = hotkeys._slice(rows, hot, ["k"], ["o", "id"], newest_first)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 20_000

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from coinslot.operators import layout, skipping


def table(spark, folder, rows=8000):
    pick = random.Random(5)
    data = [
        (f"{pick.random():.9f}", pick.random() if i % 50 else None, date(2020, 1, 1 + pick.randrange(28)), i, "hot" if i % 3 else f"g{i}")
        for i in range(rows)
    ]
    spark.createDataFrame(data, "name string, score double, day date, id bigint, _morton string").write.parquet(f"{folder}/in")
    return spark.read.parquet(f"{folder}/in")


def test_each_key_skips_and_nothing_is_lost(spark, folder):
    df = table(spark, folder)
    skipping.skipping_write(df, f"{folder}/out", ["name", "score"], ["name", "id"], files=4, row_group_rows=32)
    out = spark.read.parquet(f"{folder}/out")
    assert out.columns == df.columns
    assert out.exceptAll(df).isEmpty() and df.exceptAll(out).isEmpty()
    one = df.first()
    # 250 groups lie about 16 by 16 over the keys; a narrow strip of one key meets 16 cells, each cut by two groups at most.
    strip = 2 * 16 * 32
    for condition, most in [
        (F.col("name") == one.name, 100), (F.col("id") == 4321, 100), (F.col("score") > 0.99, strip),
        (F.col("name") < "0.01", strip), (F.col("score").isNull(), strip), (F.col("name") == "absent", 40),
    ]:
        rows, scanned = skipping.rows_scanned(out.filter(condition))
        assert sorted(rows) == sorted(df.filter(condition).collect())
        assert len(rows) <= scanned <= most


def test_ranks_and_interleaving(spark, folder):
    df = table(spark, folder)
    bounds = skipping.quantiles(df, ["score", "day"])
    kinds = dict(df.dtypes)
    ranked = df.select("score", "day", *[skipping.rank(k, bounds[k], kinds[k]).alias(f"r_{k}") for k in bounds]).collect()
    for key in bounds:
        for row in ranked:
            want = 0 if row[key] is None else sum(b <= row[key] for b in bounds[key])
            assert row[f"r_{key}"] == want
    code = spark.range(1).select(skipping.morton([F.lit(5).cast("long"), F.lit(3).cast("long")])).first()[0]
    # 5 = 101, 3 = 011: pairs of bits from the top are 10, 01, 11.
    assert code == 0b100111


@pytest.mark.parametrize("rows", [[], [(None, None)], [("a", 1.0)] * 9, [("a", float("nan")), ("b", None), (None, 2.0)]])
def test_small_and_odd_tables(spark, folder, rows):
    spark.createDataFrame(rows, "k string, v double").write.parquet(f"{folder}/in")
    df = spark.read.parquet(f"{folder}/in")
    skipping.skipping_write(df, f"{folder}/out", ["k", "v"], ["k"], files=2, row_group_rows=4)
    out = spark.read.schema(df.schema).parquet(f"{folder}/out")
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_a_published_table_keeps_its_rows(spark, folder):
    df = table(spark, folder, 500)
    layout.publish(df, "skipped", ["name", "score"], ["name"], 16)
    stored = spark.table("skipped")
    assert stored.count() == 500
    rows, scanned = skipping.rows_scanned(stored.filter(F.col("name") == df.first().name))
    assert len(rows) == 1 and scanned <= 50

from pyspark.sql import functions as F

from coinslot.functions import expr
from coinslot.model.dims import dim_channel, dim_console


def test_console_dim(spark):
    rows = {r.platform_code: r for r in dim_console(spark).collect()}
    assert len(rows) == 12
    assert {r.console_family for r in rows.values()} == {"PlayStation", "Xbox"}
    assert [rows[c].era for c in ("PS", "PS2", "PS4", "PS5", "XBL")] == ["90s", "00s", "10s", "20s", None]
    assert rows["PSP"].generation is None and rows["XBL"].launch_year is None


def test_channel_dim_covers_all_purchase_modes(spark):
    assert {r.channel_type for r in dim_channel(spark).collect()} == {"PHYSICAL", "DIGITAL", "MEMBERSHIP", "HARDWARE"}


def test_release_era_and_launch_era(spark):
    df = spark.createDataFrame([(1997,), (2004,), (2015,), (2022,), (1989,), (None,)], "y int")
    got = df.select("y", expr.release_era("y").alias("r"), expr.launch_era("y").alias("l")).collect()
    assert [(r.r, r.l) for r in got] == [
        ("90s", "90s"), ("00s", "00s"), ("10s", "10s"), ("20s", "20s"), ("90s", None), ("20s", None),
    ]


def test_net_revenue_with_and_without_discount(spark):
    df = spark.createDataFrame([(60.0, 2, 0.25), (10.0, 3, None)], "p double, q int, d double")
    assert [r[0] for r in df.select(expr.net_revenue("p", "q", "d")).collect()] == [90.0, 30.0]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(expr.ratio("a", "b")).collect()] == [None, None, 0.25]


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.71,), (0.7,), (0.41,), (0.4,)], "p double")
    assert [r[0] for r in df.select(expr.risk_band("p")).collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_document_keeps_empty_parts(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(expr.document_text("x", "y", "z")).first()[0] == "a —  — c"


def test_dims_are_broadcast_without_a_hint(spark):
    facts = spark.range(1000).withColumn("platform_code", F.concat(F.lit("PS"), F.col("id")))
    plan = facts.join(dim_console(spark), "platform_code")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan

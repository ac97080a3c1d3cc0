import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from coinslot.ml import churn
from coinslot.model import views
from coinslot.model.dims import dim_channel, dim_console
from coinslot.operators import layout
from coinslot.plans import catalog, features, gold, lookups, refresh, silver

SALES = "Name string, Platform string, Year string, Genre string, Publisher string, NA_Sales string, EU_Sales string, JP_Sales string, Other_Sales string, Global_Sales string"
EVENTS = (
    "event_id string, occurred_at timestamp, player_id string, platform string, channel_code string, "
    "product_id string, product_type string, title string, quantity int, unit_price double, "
    "discount_pct double, is_preowned boolean, membership_tier string"
)
HISTORY = "_pk string, _lsn long, player_id string, membership_tier string, status string, mrr string, is_current boolean, is_deleted boolean, valid_from timestamp"


@pytest.fixture(scope="module")
def raw_sales(spark):
    return spark.createDataFrame(
        [
            (" Halo ", "XOne", "2014", "A", "M", "1", "1", "1", "1", "4"),
            ("Halo", "xone", "2014", "A", "M", "1", "0", "0", "0", "1"),
            ("Old", "PS", "1989", "A", "S", "1", "0", "0", "0", "1"),
            ("Bad", "PS", "N/A", "A", "S", "1", "0", "0", "0", "1"),
            ("Live", "XBL", "2007", "A", "M", "2", "0", "0", "0", "2"),
            ("Gone", "SNES", "1995", "A", "N", "2", "0", "0", "0", "2"),
            ("Halo", "XOne", "2015", "A", "M", "3", "0", "0", "0", "3"),
        ],
        SALES,
    )


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(
        [("Halo", "XOne", "90", "tbd", "M"), ("Halo", "XONE", "80", "9", "T")],
        "Name string, Platform string, Critic_Score string, User_Score string, Rating string",
    )


@pytest.fixture(scope="module")
def sales(spark, raw_sales, ratings):
    return silver.game_sales(raw_sales, ratings, dim_console(spark))


@pytest.fixture(scope="module")
def raw_events(spark):
    rows = [
        ("1", datetime(2001, 1, 1), "p", "XOne", "digital_store", "t1", "GAME", "Halo", 2, 60.0, 0.25, False, None),
        ("2", datetime(2001, 12, 1), "p", "PS2", "physical_retail", "t2", "GAME", "Ico", 1, 10.0, None, True, None),
        ("3", datetime(2001, 1, 1), "q", "SNES", "membership_fee", "t3", "GAME", "Zelda", 1, 0.0, None, False, "GOLD"),
    ]
    return spark.createDataFrame(rows, EVENTS)


@pytest.fixture(scope="module")
def events(spark, raw_events):
    return silver.purchase_events(raw_events, dim_channel(spark), dim_console(spark))


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [
            ("S1", 1, "p", "SILVER", "ACTIVE", "5.00", True, False, datetime(2001, 1, 5)),
            ("S2", 2, "p", "GOLD", "ACTIVE", "9.99", True, False, datetime(2001, 3, 5)),
            ("S3", 3, "q", "GOLD", "LAPSED", "9.99", True, True, datetime(2001, 3, 6)),
        ],
        HISTORY,
    )


def test_sales_conforming(sales):
    rows = {(r.title, r.platform_code, r.release_year): r for r in sales.collect()}
    assert set(rows) == {("Halo", "XONE", 2014), ("Halo", "XONE", 2015), ("Live", "XBL", 2007)}
    halo = rows[("Halo", "XONE", 2014)]
    assert (halo.global_sales_musd, halo.critic_score, halo.user_score, halo.era) == (4.0, 90.0, None, "10s")
    assert rows[("Live", "XBL", 2007)].era == "00s"


def test_events_conforming(events):
    rows = {r.event_id: r for r in events.collect()}
    assert (rows["1"].net_revenue, rows["1"].console_family, rows["1"].era) == (90.0, "Xbox", "10s")
    assert rows["2"].is_physical and not rows["2"].is_membership
    assert rows["3"].console_family is None and rows["3"].is_membership


def test_player_360(events, history):
    rows = {r.player_id: r for r in gold.player_360(events, history, F.expr("DATE '2001-12-31'")).collect()}
    assert len(rows) == 2
    p, q = rows["p"], rows["q"]
    assert (p.purchase_count, p.lifetime_value, p.avg_order_value, p.digital_share) == (2, 100.0, 50.0, 0.9)
    assert (p.physical_spend, p.digital_spend, p.membership_spend) == (10.0, 90.0, 0.0)
    assert (p.recency_days, p.tenure_days, p.is_churned, p.platforms_used) == (30, 364, 0, 2)
    assert p.console_families == ["PlayStation", "Xbox"]
    assert (p.membership_tier, p.mrr) == ("GOLD", 9.99)
    assert (q.digital_share, q.is_churned, q.membership_tier, q.console_families) == (None, 1, None, [])
    feats = {r.player_id: r for r in features.player_features(gold.player_360(events, history, F.expr("DATE '2001-12-31'"))).collect()}
    assert (feats["q"].digital_share, feats["q"].mrr, feats["q"].membership_tier) == (0.0, 0.0, "NONE")


def test_sales_by_era_keeps_both_sides(sales, events):
    rows = gold.sales_by_era_platform(sales, events).collect()
    assert {(r.platform_code, r.channel_type) for r in rows} == {
        ("XONE", "PHYSICAL"), ("XBL", "PHYSICAL"), ("XONE", "DIGITAL"), ("PS2", "PHYSICAL"), ("SNES", "MEMBERSHIP"),
    }
    assert all((r.physical_units_m is None) != (r.net_revenue is None) for r in rows)


def test_lifecycle(sales):
    rows = gold.console_lifecycle(sales).filter("platform_code = 'XONE'").orderBy("release_year").collect()
    assert [(r.software_units_m, r.cumulative_units_m, r.years_since_launch) for r in rows] == [(4.0, 4.0, 1), (3.0, 7.0, 2)]
    assert gold.console_lifecycle(sales).filter("platform_code = 'XBL'").first().years_since_launch is None


def test_mrr(spark):
    rows = [
        ("A", 1, "p", "GOLD", "ACTIVE", "10.00", False, False, datetime(2001, 1, 5)),
        ("A", 2, "p", "GOLD", "CANCELLED", "10.00", True, False, datetime(2001, 3, 5)),
        ("B", 3, "q", "GOLD", "LAPSED", "5.00", True, False, datetime(2001, 4, 5)),
    ]
    mart = gold.membership_mrr(spark.createDataFrame(rows, HISTORY)).orderBy("month").collect()
    assert [(r.mrr, r.prior_mrr, r.net_new_mrr, r.churn_rate) for r in mart] == [
        (10.0, None, 10.0, 0.0), (0.0, 10.0, -10.0, 1.0), (0.0, 0.0, 0.0, None),
    ]


def test_movements(spark):
    states = ["ACTIVE", "CANCELLED", "ACTIVE", "ACTIVE"]
    rows = [("A", i, "p", "GOLD", s, f"{i + 1}.00", i == 3, False, datetime(2001, i + 1, 1)) for i, s in enumerate(states)]
    h = spark.createDataFrame(rows, HISTORY)
    for limit in (1, 100):
        got = {r.month.month: r[1:] for r in gold.membership_movements(h, limit).collect()}
        assert got == {3: (1, 0, 0.0), 4: (0, 1, 1.0)}


def test_lookups(spark, sales, events):
    mart = gold.sales_by_era_platform(sales, events)
    assert {r.console_family for r in lookups.lookup_sales_by_era(mart).collect()} == {"PlayStation"}
    with pytest.raises(ValueError):
        lookups.lookup_sales_by_era(mart, "'; DROP TABLE x")
    scores = spark.createDataFrame([("p", 0.9, "HIGH")], "player_id string, churn_probability double, risk_band string")
    assert lookups.lookup_player_churn(scores, "p").first().risk_band == "HIGH"
    assert lookups.lookup_player_churn(scores, "nobody").isEmpty()


def daily(spark, days, gap=1):
    rows = [(i * gap, "PS2", "digital_store", float(i)) for i in range(days)]
    return spark.createDataFrame(rows, "d int, platform_code string, channel_code string, net_revenue double").select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).cast("timestamp").alias("occurred_at"),
        "platform_code", F.lit("DIGITAL").alias("channel_type"), "net_revenue",
    )


def test_lags_count_rows_not_days(spark):
    rows = features.sales_timeseries(daily(spark, 40, gap=3)).orderBy("ds").collect()
    assert len(rows) == 12
    first = rows[0]
    assert (first.revenue, first.revenue_lag_1, first.revenue_lag_7, first.revenue_lag_28) == (28.0, 27.0, 21.0, 0.0)
    assert (first.revenue_roll_7, first.revenue_roll_28) == (25.0, 14.5)
    assert features.sales_timeseries(daily(spark, 28)).isEmpty()


def test_sequences(spark):
    ts = features.sales_timeseries(daily(spark, 128))
    assert ts.count() == 100
    windows = features.sequence_windows(ts)
    assert windows.count() == 100 - 56 - 28
    assert features.sequence_windows(ts, keep_last=True).count() == 17
    first = windows.orderBy("last_ds").first()
    assert first.x_revenue == [float(28 + i) for i in range(56)] and first.y == [float(84 + i) for i in range(28)]
    assert len(first.x_dow) == 56
    assert features.sequence_windows(features.sales_timeseries(daily(spark, 100))).isEmpty()


def test_split_is_per_series_and_in_time(spark):
    split = features.chronological_split(features.sales_timeseries(daily(spark, 128)))
    got = {r.split: (r.n, r.a, r.b) for r in split.groupBy("split").agg(F.count("*").alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b")).collect()}
    assert got["train"][0] == 85 and got["validation"][0] == 15
    assert got["train"][2] < got["validation"][1]


def test_interactions_and_rank(spark):
    rows = [("p" if i % 4 else "q", f"t{i}", "GAME", "x", "PS2", "PlayStation", 5.0, datetime(2001, 1, 1 + i % 9)) for i in range(40)]
    rows.append(("p", "c", "CONSOLE", "x", "PS2", "PlayStation", 5.0, datetime(2001, 1, 1)))
    df = spark.createDataFrame(rows, "player_id string, product_id string, product_type string, title string, platform_code string, console_family string, net_revenue double, occurred_at timestamp")
    plain = sorted(map(str, features.interaction_features(df).collect()))
    assert len(plain) == 40
    assert sorted(map(str, features.interaction_features(df, max_group_rows=5).collect())) == plain


def test_enrichment_retries_then_rejects(spark):
    rows = [("a", "PS", "90s", "G", "P", 3.0), ("b", "PS", "90s", "G", "P", 2.0), ("c", "PS", "90s", None, "P", 1.0)]
    source = spark.createDataFrame(rows, "title string, platform_code string, era string, genre string, publisher string, global_sales_musd double")
    done = source.filter("title = 'a'")
    todo = catalog.enrichment_todo(source, done, 10)
    assert [r.title for r in todo.collect()] == ["b", "c"]
    assert [r.title for r in catalog.enrichment_todo(source, None, 1).collect()] == ["a"]
    calls = []

    def complete(prompts, instruction):
        assert "HIGH" in instruction
        calls.append(prompts)
        if '"b"' in prompts[0] and len(calls) < 2:
            raise RuntimeError("busy")
        if '"c"' in prompts[0]:
            raise RuntimeError("always down")
        return ['{"sub_genre": "s", "retro_appeal": "HIGH", "themes": ["x", "y"]}' for _ in prompts]

    done = catalog.enrich(source, complete, pause=0.0, parallelism=1, prompts_per_call=1).cache()
    good = {r.title: r for r in catalog.accepted(done).collect()}
    assert set(good) == {"a", "b"} and good["a"].themes == ["x", "y"]
    bad = catalog.rejected(done).collect()
    assert [(r.title, r.reject_reason, r.call_error) for r in bad] == [("c", "no completion", "always down")]


def test_refresh_builds_all_layers(spark, raw_sales, ratings, raw_events, history, folder):
    refresh.refresh_dims(spark, "lake_silver")
    for run in ("1", "2"):
        refresh.refresh_silver(spark, "lake_silver", f"{folder}/quarantine", raw_sales, ratings, raw_events, run_id=run)
    assert spark.table("lake_silver.silver_purchase_events").count() == 2
    assert spark.read.parquet(f"{folder}/quarantine/silver_purchase_events").count() == 2
    events = spark.table("lake_silver.silver_purchase_events")
    days = F.sequence(F.col("occurred_at"), F.col("occurred_at") + F.expr("INTERVAL 39 DAYS"), F.expr("INTERVAL 1 DAY"))
    layout.publish(events.withColumn("occurred_at", F.explode(days)), "lake_silver.silver_purchase_events")
    weights = churn.LogisticWeights(0.4, 0.01, -0.0002, -0.1)
    refresh.refresh_gold(
        spark, "lake_silver", "lake_gold", history, F.expr("DATE '2001-12-31'"), lambda f: churn.score_churn(f, weights)
    )
    scores = spark.table("lake_gold.gold_player_churn_scores")
    assert [r.player_id for r in lookups.lookup_player_churn(scores, "p").collect()] == ["p"]
    assert spark.table("lake_gold.gold_player_360").count() == 1
    assert {t.name for t in spark.catalog.listTables("lake_gold")} >= {"gold_membership_mrr", "feat_player", "feat_sales_ts"}


def test_term_vectors(spark):
    rows = [("a", "PS2", "Halo halo, wars"), ("b", "PS2", "Ico wars"), ("c", "PS2", None), ("d", None, "!?"), ("b", "PS2", "Ico wars")]
    documents = spark.createDataFrame(rows, "title string, platform_code string, document string")
    got = catalog.term_vectors(documents, 4096).collect()
    by_title = {r.title: r for r in got}
    assert len(got) == 5 and {t: r.n_terms for t, r in by_title.items()} == {"a": 3, "b": 2, "c": 0, "d": 0}
    norms = {t: sum(x * x for x in r.embedding) for t, r in by_title.items()}
    assert norms == pytest.approx({"a": 1.0, "b": 1.0, "c": 0.0, "d": 0.0})
    # Rarer and repeated terms weigh more: of five texts one has "halo", twice; three have "wars".
    high, low = sorted((x for x in by_title["a"].embedding if x), reverse=True)
    assert high / low == pytest.approx(2 * math.log(6 / 2) / math.log(6 / 4), rel=1e-4)
    assert catalog.term_vectors(documents.limit(0)).count() == 0


def test_no_line_is_shuffled_with_the_texts_of_parts(spark):
    """Parts are joined last and customers to orders, so the listing's lines carry numbers only until then."""
    plan = views.raw_sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "p_partkey" in joins[0] and "l_orderkey" in joins[1] and len(joins) == 5

import datetime
import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from coinslot.ml import churn, forecast, metrics, recommend, similarity
from coinslot.plans import features
from coinslot.session import discard, materialise


def test_dense_codes_are_dense_and_stable(spark):
    ids = spark.range(500).select(F.concat(F.lit("p"), F.col("id") % 300).alias("id"))
    codes = recommend.dense_codes(ids, "id", "code")
    rows = codes.collect()
    assert sorted(r.code for r in rows) == list(range(300)) and len({r.id for r in rows}) == 300
    again = recommend.dense_codes(ids.repartition(7), "id", "code")
    assert sorted(again.collect()) == sorted(rows)


def test_topk_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(200, 8)).astype("float32")
    vectors[150:] = vectors[:50]
    vectors[7] = 0
    catalog = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, vectors[i].tolist()) for i in (1, 60)], "query_id long, embedding array<float>")
    got = similarity.cosine_topk(catalog.repartition(5), queries, 5, "vec_id").orderBy("query_id", "rank").collect()
    expected = []
    for q in (1, 60):
        scored = []
        for i, v in enumerate(vectors.astype("float64")):
            if np.linalg.norm(v):
                u = vectors[q].astype("float64")
                scored.append((-round(float(u @ v / np.linalg.norm(u) / np.linalg.norm(v)), 6), i))
        expected += [(q, i) for _, i in sorted(scored)[:5]]
    assert [(r.query_id, r.vec_id) for r in got] == expected


def test_queries_are_worked_through_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 4)))]
    catalog = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = catalog.filter("vec_id % 3 = 0").withColumnRenamed("vec_id", "query_id")
    whole = sorted(map(tuple, similarity.cosine_topk(catalog, queries, 3, "vec_id").collect()))
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 4)
    monkeypatch.setattr(similarity, "ROWS", 7)
    assert sorted(map(tuple, similarity.cosine_topk(catalog, queries, 3, "vec_id").collect())) == whole
    assert len(whole) == 14 * 3 and similarity.cosine_topk(catalog, queries.filter("false"), 3, "vec_id").count() == 0


def test_lsh_finds_true_neighbours_only(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 6))
    catalog = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(0, base[0].tolist())], "query_id long, embedding array<double>")
    found = {r.vec_id: r.distance for r in similarity.lsh_matches(catalog, queries, 2.0, "vec_id").collect()}
    assert found[0] == 0.0
    for i, d in found.items():
        assert d == pytest.approx(np.linalg.norm(base[i] - base[0]), abs=1e-5) and d < 2.0


def test_recall_and_gate(spark):
    relevant = spark.createDataFrame([("p", "a"), ("q", "b"), ("r", "c"), ("s", "a")], "player_id string, product_id string")
    recommended = spark.createDataFrame([("a",), ("b",)], "product_id string")
    row = metrics.recall_at_k(recommended, relevant, ["product_id"]).first()
    assert (row.relevant, row.hits, row.recall) == (4, 3, 0.75)
    metric = lambda v: spark.createDataFrame([(v,)], "m double")
    assert metrics.promotion_gate(metric(0.5), metric(0.51), "m").first().promote
    assert not metrics.promotion_gate(metric(0.5), metric(0.505), "m").first().promote
    assert metrics.promotion_gate(metric(0.5).filter("false"), metric(0.02), "m").first()[0] == 0.0


def test_forecast_errors(spark):
    df = spark.createDataFrame([("s", 1.0, 1.5), ("s", 5.0, 2.0)], "k string, a double, p double")
    row = metrics.forecast_errors(df, "a", "p", ["k"]).first()
    assert (row.n, row.mae, row.rmse, row.huber) == (2, 1.75, 2.1506, round((0.125 + 2.5) / 2, 4))


def players(spark):
    return spark.range(400).select(
        F.col("id").cast("string").alias("player_id"),
        F.when(F.col("id") % 2 == 0, 200).otherwise(10).alias("recency_days"),
        F.when(F.col("id") % 2 == 0, 900).otherwise(100).alias("tenure_days"),
        (F.col("id") % 2 * 10 + 1).alias("purchase_count"),
        F.lit(10.0).alias("avg_order_value"), F.lit(0.5).alias("digital_share"),
        F.lit(2).alias("platforms_used"), F.lit(3.0).alias("log_ltv"), F.lit(0.0).alias("mrr"),
        (F.col("id") % 2 == 0).cast("int").alias("is_churned"),
    )


def test_churn_model_and_udf(spark):
    rows = players(spark)
    scored = churn.apply_churn(churn.fit_churn(rows), rows)
    assert scored.filter("(churn_probability > 0.5) <> (is_churned = 1)").isEmpty()
    weights = churn.LogisticWeights(0.0, 0.01, 0.0, 0.0)
    got = {r.recency_days: r for r in churn.score_churn(rows, weights).collect()}
    assert got[200].churn_probability == pytest.approx(1 / (1 + np.exp(-2.0)), abs=1e-6)
    assert (got[200].risk_band, got[10].risk_band) == ("HIGH", "MEDIUM")
    opaque = churn.score_with(rows, lambda recency: 1 / (1 + np.exp(-0.01 * recency)), ["recency_days"])
    assert {r.churn_probability for r in opaque.collect()} == {r.churn_probability for r in got.values()}


def test_churn_scores_every_player_whatever_is_missing(spark):
    rows = players(spark).withColumn("mrr", F.when(F.col("player_id") % 3 != 0, F.col("mrr")))
    training, held = churn.holdout(rows)
    assert training.count() + held.count() == rows.count() and not held.isEmpty()
    scored = churn.apply_churn(churn.fit_churn(training.unionAll(held)), rows)
    assert scored.filter("churn_probability BETWEEN 0 AND 1").count() == rows.count()


def test_training_set_codes_labelled_players_only(spark):
    rows = [("p", "a", 1.0), ("p", "b", 2.0), ("q", "b", 3.0), ("r", "c", 4.0), (None, "a", 5.0), ("q", None, 6.0)]
    pairs = spark.createDataFrame(rows, "player_id string, product_id string, confidence double")
    labels = spark.createDataFrame([("p", 1), ("q", 0), ("q", 1), ("idle", 0), (None, 1)], "player_id string, is_churned int")
    training = recommend.training_set(pairs, labels)
    code = lambda ids: {i: n for n, i in enumerate(sorted(ids, key=lambda i: hashlib.md5(i.encode()).hexdigest()))}
    players, items = code("pq"), code("ab")
    want = [("p", "a", 1.0, 1), ("p", "b", 2.0, 1), ("q", "b", 3.0, 0), ("q", "b", 3.0, 1)]
    assert sorted(map(tuple, training.collect())) == [(p, i, players[p], items[i], c, k) for p, i, c, k in want]
    # Interactions meet the labels once, not again for every list of ids.
    assert training._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_interactions_by_type_leave_no_event_out(spark):
    columns = "player_id string, product_id string, title string, platform_code string, console_family string, product_type string, net_revenue double, occurred_at timestamp"
    at = [datetime.datetime(2024, 1, day) for day in (1, 2, 3)]
    rows = [("p", "a", "t", "x", "f", "GAME", 1.0, at[0]), ("p", "a", "t", "x", "f", "GAME", None, at[1]), ("p", "a", "t", "x", "f", "CONSOLE", 2.0, at[2])]
    events = spark.createDataFrame([*rows, ("q", "a", "t", None, None, None, 2.0, None)], columns)
    both = features.interactions_by_type(events)
    games = both.filter("product_type = 'GAME'").drop("product_type").collect()
    assert games == features.interactions(events).collect() and games[0].purchases == 2
    assert {(r.player_id, r.last_seen) for r in both.groupBy("player_id").agg(F.max("last_seen").alias("last_seen")).collect()} == {("p", at[2]), ("q", None)}


def test_recommender_prefers_the_own_cluster(spark):
    rows = [(f"p{u}", f"i{i}", 2.0) for u in range(20) for i in range(20) if u % 2 == i % 2 and (u, i) != (0, 0)]
    pairs = spark.createDataFrame(rows, "player_id string, product_id string, confidence double")
    labels = pairs.select("player_id", F.lit(0).alias("is_churned")).distinct()
    training = recommend.training_set(pairs, labels).cache()
    model = recommend.fit_recommender(training, rank=4, iterations=8)
    user = training.filter("player_id = 'p0'").select("player_code").limit(1).withColumnRenamed("player_code", "u")
    items = training.select("product_id", "item_code").distinct()
    probe = items.join(user, F.lit(True)).select("product_id", F.col("u").cast("int").alias("player_code"), F.col("item_code").cast("int").alias("item_code"))
    score = {r.product_id: r.prediction for r in model.transform(probe).collect()}
    assert score["i0"] > max(score["i1"], score["i3"])


def test_forecast_model_beats_nothing_known(spark):
    rows = [(i, "PS2", "DIGITAL", float(100 + i % 7)) for i in range(200)]
    from coinslot.plans import features

    df = spark.createDataFrame(rows, "d int, platform_code string, channel_type string, net_revenue double").select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).cast("timestamp").alias("occurred_at"),
        "platform_code", "channel_type", "net_revenue",
    )
    split = features.chronological_split(features.sales_timeseries(df))
    base = metrics.forecast_errors(forecast.seasonal_baseline(split), "revenue", "forecast", features.SERIES).first()
    assert base.mae == 0.0
    model = metrics.forecast_errors(forecast.apply_forecast(forecast.fit_forecast(split), split), "revenue", "forecast", features.SERIES).first()
    assert model.mae < 0.5


def test_recommender_lists_titles_beyond_the_popular_and_fills_every_list(spark):
    """p0 has the 60 most bought titles, p1 most of them, p2 all titles but three; unpopular titles come up."""
    own = {"p0": range(60), "p1": range(45), "p2": range(3, 80)} | {f"q{u}": [*range(0, 60, 3), 60 + u, 61 + u] for u in range(19)}
    rows = [(u, f"i{i:02}", 2.0) for u, items in own.items() for i in items]
    pairs = spark.createDataFrame(rows, "player_id string, product_id string, confidence double")
    labels = pairs.select("player_id", F.lit(0).alias("is_churned")).distinct()
    training = recommend.training_set(pairs, labels).cache()
    got = recommend.best_items(training, recommend.fit_recommender(training, rank=4), 10).collect()
    by_player = {}
    for r in got:
        by_player.setdefault(r.player_id, {})[r["rank"]] = r.product_id
    assert {u: len(set(x.values())) for u, x in by_player.items()} == {u: 3 if u == "p2" else 10 for u in own}
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in by_player.values())
    assert all(not {int(i[1:]) for i in x.values()} & set(own[u]) for u, x in by_player.items())
    assert all(int(i[1:]) >= 60 for i in by_player["p0"].values())
    assert recommend.best_items(training.limit(0), recommend.fit_recommender(training, rank=4), 10).count() == 0


def test_recall_of_the_model_uses_titles_it_has_not_seen(spark):
    """Two groups of players buy two groups of titles; the newest title of each is held out."""
    from coinslot.checks.queries import model_recall

    rows = [(f"p{u}", f"i{i:02}", 2.0, 1 + (i // 2 + u) % 14) for u in range(28) for i in range(28) if u % 2 == i % 2]
    ranked = spark.createDataFrame([*rows, ("lone", "i00", 2.0, 1)], "player_id string, product_id string, confidence double, _rank_desc int")
    row = model_recall(ranked).first()
    assert row.relevant == 29 and row.hits == 28


def test_lsh_reach_follows_the_distances_and_recall_is_measured(spark):
    """Vectors spread by 1 and by 50: one pair in twenty is near in both, found rows are matches, the rest is missed."""
    from coinslot.checks.queries import lsh_recall, lsh_search

    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 6))
    for spread in (1.0, 50.0):
        vectors = [(i, (v * spread).tolist()) for i, v in enumerate(base)]
        catalog = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
        asked = spark.createDataFrame(vectors[:5], "query_id long, embedding array<double>")
        both, reach = lsh_search(catalog, asked)
        exact = [(q, i, np.linalg.norm(base[i] - base[q]) * spread) for q in range(5) for i in range(400)]
        near = {(q, i) for q, i, d in exact if d < reach}
        assert 0.03 * len(exact) < len(near) < 0.07 * len(exact)
        found = {(r.query_id, r.vec_id) for r in both.filter("distance IS NOT NULL").collect()}
        assert found <= near
        for r in lsh_recall(both, reach).collect():
            own = {p for p in near if p[0] == r.query_id}
            assert r.near == len(own) and r.recall == pytest.approx(len(own & found) / len(own) if own else 1.0)


def test_auc_against_all_pairs(spark):
    rows = [(round((i * 37 % 23) / 23, 6), int(i * 7 % 5 < 2)) for i in range(200)] + [(0.5, 1)] * 60 + [(0.5, 0)] * 40
    odd = [(None, 1), (0.3, None), (float("nan"), 1), (1.5, 0)]
    got = metrics.auc(spark.createDataFrame(rows + odd, "s double, y int"), "s", "y").first()
    pairs = [(a > b) + (a == b) / 2 for a, x in rows if x for b, y in rows if not y]
    assert (got.rows, got.positives, got.auc) == (300, sum(y for _, y in rows), round(sum(pairs) / len(pairs), 6))
    for few in ([], [(0.2, 1), (0.4, 1)]):
        row = metrics.auc(spark.createDataFrame(few, "s double, y int"), "s", "y").first()
        assert (row.rows, row.auc) == (len(few), None)


def test_recommender_blocks_hold_the_exact_best_titles(spark):
    """Several blocks of players and titles: the scores are those of all pairs, without the pairs there are."""
    rng = np.random.default_rng(5)
    rows = sorted({(f"p{u}", f"i{i}") for u, i in zip(rng.integers(0, 90, 900).tolist(), rng.integers(0, 300, 900).tolist())})
    pairs = spark.createDataFrame([(u, i, 1.0 + len(u + i) % 3) for u, i in rows], "player_id string, product_id string, confidence double")
    training = recommend.training_set(pairs, pairs.select("player_id", F.lit(0).alias("is_churned")).distinct()).cache()
    model = recommend.fit_recommender(training, rank=4)
    names = [dict(training.select(f"{c}_code", f"{n}_id").distinct().collect()) for c, n in (("player", "player"), ("item", "product"))]
    users, items = ({names[n][r.id]: np.array(r.features) for r in f.collect()} for n, f in enumerate((model.userFactors, model.itemFactors)))
    got = {}
    for r in recommend.best_items(training, model, 7, player_block=40, item_block=70).collect():
        got.setdefault(r.player_id, {})[r["rank"]] = (r.product_id, r.prediction)
    owned = set(rows)
    assert len(got) == len(users)
    for user, listed in got.items():
        scores = {i: float(users[user] @ v) for i, v in items.items() if (user, i) not in owned}
        assert sorted(listed) == list(range(1, 8))
        assert np.allclose([listed[k][1] for k in range(1, 8)], sorted(scores.values(), reverse=True)[:7], atol=1e-5)
        assert all(abs(scores[i] - p) < 1e-5 for i, p in listed.values()) and len({i for i, _ in listed.values()}) == 7


def shuffle_bytes(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_recommender_blocks_take_no_disk_of_their_own(spark):
    """Sixty blocks of players and of titles: nothing is stored per pair of blocks, and a stored result keeps no shuffle files."""
    rows = [(f"p{u}", f"i{i}", 1.0 + i % 3) for u in range(1200) for i in range(u % 67, 1200, 67)]
    pairs = spark.createDataFrame(rows, "player_id string, product_id string, confidence double")
    training = materialise(recommend.training_set(pairs, pairs.select("player_id", F.lit(0).alias("is_churned")).distinct()), "training")
    model = recommend.fit_recommender(training, iterations=1)
    before = shuffle_bytes(spark)
    got = recommend.best_items(training, model, 5, player_block=20, item_block=20).collect()
    assert shuffle_bytes(spark) - before < 1_000_000
    score = {(r.player_id, r["rank"]): r.prediction for r in recommend.best_items(training, model, 5).collect()}
    assert len(got) == len(score) == 1200 * 5
    assert all(abs(score[r.player_id, r["rank"]] - r.prediction) < 1e-5 for r in got)


def test_discarded_scratch_goes_and_nothing_else(spark, folder):
    spark.range(5).write.parquet(f"{folder}/table")
    table, kept = spark.read.parquet(f"{folder}/table"), materialise(spark.range(3), "kept")
    spent = materialise(kept.crossJoin(table.withColumnRenamed("id", "other")), "spent")
    at = spent.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(at)
    discard(spent.crossJoin(table))
    assert not os.path.exists(at) and (kept.count(), table.count()) == (3, 5)


@pytest.mark.parametrize("name", ["recommend_recall", "recommend_gate"])
def test_measures_of_the_model_leave_no_interim_tables(spark, folder, name):
    """What the ranks and the training set were made from is deleted, and the ranked pairs carry no texts."""
    from coinslot.checks import queries

    tables = {
        "lineitem": "id AS l_orderkey, 1 + id % 7 AS l_linenumber, id * 7 % 40 AS l_partkey, 1L AS l_suppkey, DATE'2000-01-01' + CAST(id % 300 AS int) AS l_shipdate, "
        "'N' AS l_returnflag, 2D AS l_quantity, 0D AS l_discount",
        "orders": "id AS o_orderkey, id % 30 AS o_custkey, '1-URGENT' AS o_orderpriority",
        "part": "id AS p_partkey, 'title ' || id AS p_name, id % 50 AS p_size, 9.5D AS p_retailprice, 'x' AS p_type, 'y' AS p_brand",
    }
    for table, columns in tables.items():
        spark.range(40 if table == "part" else 1200).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/{table}.parquet")
    at = f"{spark.conf.get('spark.checkpoint.dir')}/coinslot"
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    assert queries.QUERIES[name](spark, folder).count() == 1
    left = {folder.rsplit("-", 1)[0]: folder for folder in set(os.listdir(at)) - before}
    assert "ranked" in left and not left.keys() & {"interactions", "training-pairs"}
    assert "title" not in spark.read.parquet(f"{at}/{left['ranked']}").columns

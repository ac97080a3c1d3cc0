import numpy as np
import pytest
from pyspark.sql import functions as F

from coinslot.ml import cells, similarity

SCHEMA = "vec_id bigint, embedding array<float>, cell string"


def table(spark, n=600, dims=12, hot=200):
    """Clusters, a third of all rows copies of one vector, and rows that have no direction or another length."""
    pick = np.random.default_rng(3)
    middles = pick.normal(size=(15, dims))
    vectors = [middles[i % 15] + 0.3 * pick.normal(size=dims) for i in range(n)]
    rows = [(i, [float(x) for x in (vectors[0] if i < hot else v)], "x") for i, v in enumerate(vectors)]
    odd = [(n, None, "x"), (n + 1, [], "x"), (n + 2, [0.0] * dims, "x"), (n + 3, [1.0, 2.0], "x"), (n + 4, [float("nan")] * dims, "x")]
    odd += [(n + 5, [None] + [1.0] * (dims - 1), "x"), (n + 6, [float("inf")] * dims, None)]
    return spark.createDataFrame(rows + odd, SCHEMA), n


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 32)


def test_all_cells_are_exact_and_few_are_measured(spark, folder, small_blocks):
    rows, n = table(spark)
    index = cells.build(rows, f"{folder}/index", "vec_id", cells=20)
    stored = index.rows(spark)
    assert sorted(r.id for r in stored.select("id").collect()) == list(range(n))
    largest = stored.groupBy("cell", "block").count().agg(F.max("count")).first()[0]
    assert largest < 100 and stored.groupBy("cell").count().agg(F.max("count")).first()[0] >= 200
    asked = rows.filter(f"vec_id % 50 = 0 AND vec_id < {n}").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = similarity.cosine_topk(rows.filter(f"vec_id < {n}"), asked, 10, "vec_id")
    want = sorted(exact.select("query_id", "vec_id", "rank").collect())
    everything = cells.search(spark, index, asked, 10, len(index.centres))
    assert sorted(everything.select("query_id", "vec_id", "rank").collect()) == want
    probes, share, found = cells.tune_probes(spark, index, asked, exact, 10, 0.9)
    assert probes < len(index.centres) and share >= 0.9
    hits = {(r.query_id, r.vec_id) for r in found.collect()} & {(r[0], r[1]) for r in want}
    assert len(hits) / len(want) == pytest.approx(share)


def test_empty_catalog_and_queries(spark, folder):
    rows, _ = table(spark, 60, hot=0)
    none = rows.limit(0).select(F.col("vec_id").alias("query_id"), "embedding")
    index = cells.build(rows, f"{folder}/some", "vec_id", cells=4)
    assert cells.search(spark, index, none, 3, 2).count() == 0
    assert cells.recall(none.withColumn("vec_id", F.col("query_id")), none.withColumn("vec_id", F.col("query_id")), "vec_id") == 1.0
    bare = rows.filter("vec_id >= 60 AND vec_id <> 63")
    index = cells.build(bare, f"{folder}/bare", "vec_id")
    asked = rows.limit(2).select(F.col("vec_id").alias("query_id"), "embedding")
    assert cells.search(spark, index, asked, 3, 1).count() == 0

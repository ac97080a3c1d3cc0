"""The classifier on a held-out fold, exact search against brute force, the pipeline stage by stage."""

import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from coinslot.llm import quality, topk
from test_text_operators import brute_components, check_pieces, library_ids, plain_spans, table

SF = "/root/testdata/sf0.001"


def test_classifier_ranks_the_held_out_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(quality.labelled_sample(docs, labels))
    scored = quality.score_documents(docs, model).withColumn("held", quality.held_out(F.col("doc_id")))
    rows = scored.join(labels, "doc_id").filter("held").select("doc_id", "score", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95 and len(good) and len(bad)


def test_classifier_never_learns_from_the_held_out_fold(spark):
    docs = table(spark, [f"text {i}" for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    sample = quality.labelled_sample(docs, labels).collect()
    assert {r.doc_id for r in sample} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(quality.labelled_sample(docs, labels, limit=10).collect()) == 10


def test_classifier_features_come_in_blocks(monkeypatch):
    """Features of all words together took several hundred bytes a feature; the blocks give the same in the same order."""
    words = pa.array([f"w{i}é{'x' * (i % 40)}{i * 7919}" for i in range(50_000)], pa.large_string())
    tracemalloc.start()
    features, first = quality.features_by_word(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(features) and features.dtype == np.uint16
    for k in (0, 19_999, 20_000, 49_999):
        assert features[first[k] : first[k + 1]].tolist() == quality.word_features(words.slice(k, 1))[0].tolist()
    assert len(first) == len(words) + 1 and first[-1] == len(features)
    nothing = quality.features_by_word(words.slice(0, 0))
    assert len(nothing[0]) == 0 and nothing[1].tolist() == [0]


def test_classifier_edges(spark):
    docs = table(spark, ["good plain words", None, "", "### $$$", "x" * 50_000, "good plain words"], [1, 2, 3, None, 5, 1])
    model = quality.fit(spark.createDataFrame([], "doc_id long, text string, label int"))
    rows = quality.score_documents(docs, model, into="chance").collect()
    assert len(rows) == 6 and all(r.chance == 0.5 for r in rows)
    sample = spark.createDataFrame([(i, "good words" if i % 2 else "### $$$", i % 2) for i in range(40)], "doc_id long, text string, label int")
    model = quality.fit(sample)
    rows = {r.text: r.chance for r in quality.score_documents(docs, model, into="chance").collect()}
    assert rows["good plain words"] > 0.5 > rows["### $$$"] and 0 <= rows[None] <= 1 and rows[None] == rows[""]
    assert quality.score_documents(table(spark, []), model, into="chance").count() == 0
    assert quality.score_documents(docs, model, into="chance").columns == [*docs.columns, "chance"]
    with pytest.raises(ValueError):
        quality.score_documents(docs, model)


def test_classifier_sees_repeated_words(spark):
    """The same words, once each in turn and once in runs: only the repeats tell them apart."""
    words = [f"w{i}" for i in range(12)]
    good, bad = " ".join(words * 5), " ".join(w for w in words for _ in range(5))
    sample = spark.createDataFrame([(i, good if i % 2 else bad, i % 2) for i in range(40)], "doc_id long, text string, label int")
    model = quality.fit(sample)
    rows = {r.doc_id: r.chance for r in quality.score_documents(table(spark, ["a b c d e f g", "a a a b b b c c c"]), model, into="chance").collect()}
    assert rows[0] > rows[1]


def brute_topk(vectors, k, every):
    rows = [(i, np.floor(np.asarray(v, float) * 64)) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in sorted(((i, v) for i, v in rows), key=lambda r: tuple(r[1]), reverse=True)}.items():
        if q % every == 0:
            scored = sorted((-int(a @ v), i) for i, v in rows if i != q and len(v) == len(a))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 3, 400])
def test_topk(spark, monkeypatch, n):
    rng = np.random.default_rng(n)
    vectors = [(int(i), rng.normal(size=8).round(3).tolist()) for i in rng.permutation(n)]
    if n > 3:
        monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
        same = vectors[0][1]
        vectors += [(1000 + i, same) for i in range(60)] + [(2000, None), (2001, []), (2005, [1.0, None]), (2010, [float("nan")] * 8)]
        vectors += [(2015, [float("inf")] * 8), (None, same), (2020, [0.5] * 3), (2025, [1.5] * 3), (5, [0.25] * 8), (2030, [0.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0, 4).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute_topk(vectors, 4, 5)


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_pipeline_stages_against_brute_force(spark, folder):
    """Each stage is held against its own input, as it is written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_dropped", F.lit(1)).withColumn("score", F.lit("own"))
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        rows, old = after.collect(), {r.doc_id: r for r in before}
        if name != "packing":
            assert after.columns == docs.columns
            assert all(r == old[r.doc_id] for r in rows) or name == "pii"
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in rows}
            good = [d for d in old if labels.get(d) == 1]
            assert sum(d in kept for d in good) >= 0.95 * len(good) and len(kept) < len(old)
        if name == "exact_dedup":
            best = {}
            for r in before:
                best[plain(r.text)] = min(best.get(plain(r.text), (0, r.doc_id)), (-len(r.text), r.doc_id))
            assert {r.doc_id for r in rows} == {d for _, d in best.values()}
        if name == "ngram_jaccard":
            root = brute_components([r.doc_id for r in before], [r.text for r in before])
            assert {r.doc_id for r in rows} == set(root.values())
        if name == "pii":
            assert {r.doc_id for r in rows} == set(old)
            for r in rows:
                assert not plain_spans(r.text) and r.n_chars == len(r.text)
                assert plain_spans(old[r.doc_id].text) or r.text == old[r.doc_id].text
        if name == "packing":
            check_pieces(rows, {i: x + [2] for i, x in zip(old, library_ids([old[i].text for i in old]))}, 4096)
        docs, before = after, rows


@pytest.mark.parametrize("texts", [[], [None, "", "word", "word", "### ###"]])
def test_pipeline_stages_on_edges(spark, folder, texts):
    docs = table(spark, texts, [None, 1, 1, 2, 3][: len(texts)])
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    assert docs.count() == 0 or texts


def test_pipeline_batches_are_bounded_by_bytes(spark, monkeypatch):
    """Long texts come to a stage a few megabytes at a time, not ten thousand rows at a time."""

    def sized(docs):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

        return docs.mapInArrow(run, "n long")

    docs = table(spark, ["x" * 100_000] * 100).coalesce(1)
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda given, *_: sized(given))
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    sizes = [r.n for r in dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF).collect()]
    assert max(sizes) < 5_000_000 and sum(sizes) > 10_000_000


def test_pipeline_exact_stage_keeps_one_row_per_text(spark):
    """Repeated, shared and null ids, by their exact rows."""
    texts = ["A", "A", "B", "C", "C", "C ", "D", "D", "D", "E é\U0001f600", "E\té \U0001f600", None, "", " \v\f", "F", "F"]
    ids = [0, 1, 1, 2, 2, 2, None, None, 7, None, None, 8, 9, None, 3, 3]
    docs = table(spark, texts, ids)
    for given in (docs, docs.repartition(5), docs.orderBy(F.desc("text")).coalesce(1)):
        kept = corpus_pipeline.exact_copies(spark, given, SF)
        assert kept.columns == docs.columns
        got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
        assert got == [("0", "A"), ("1", "B"), ("2", "C "), ("3", "F"), ("7", "D"), ("None", " \v\f"), ("None", "E\té \U0001f600")]


def test_pipeline_near_stage_tells_rows_of_an_id_apart(spark):
    """A unique text stays although its id is also on a near copy; near copies without an id go."""
    base = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcd"]
    texts = [base[0], base[0] + " x", "own words of one", base[1], base[1] + " x", base[2], base[2] + " x", base[3], "", ""]
    ids = [0, 1, 1, None, None, 9, 5, 6, None, 1]
    docs = table(spark, texts, ids)
    kept = corpus_pipeline.near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted((str(r.doc_id), r.text[:6]) for r in got if r.doc_id is not None) == [
        ("0", "a0 a1 "), ("1", ""), ("1", "own wo"), ("5", "c0 c1 "), ("6", "d0 d1 ")
    ]
    assert sorted(r.text[:6] for r in got if r.doc_id is None) == ["", "b0 b1 "]

"""The document pipeline: quality, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
stage's documents. All but the last keep the columns of the documents they get. Rows with a null id
are kept by the filters as far as their text allows. After the exact stage no two rows have equal
texts, whatever their ids.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.llm import exact_dedup, jaccard_join, packing, pii, quality
from coinslot.llm.queries import END, WORDS
from coinslot.llm.rows import bounded_batches, documents, free_name
from coinslot.ml.recommend import dense_codes
from coinslot.session import materialise


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labelled rows of this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.labelled_sample(docs, labels))
    score = free_name(docs, "score")
    return quality.score_documents(docs, model, into=score).filter(F.col(score) >= 0.5).drop(score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: the longest as written, then the smallest id, a null id last.

    Rows are told apart by id and text; of rows that repeat both, one stays.
    """
    mark, order = free_name(docs, "_mark"), free_name(docs, "_order")
    plain = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), " \t\n\v\f\r", "")
    marked = docs.withColumn(mark, F.sha2(plain, 256))
    groups = materialise(exact_dedup.exact_groups(docs), "pipeline-exact")
    pairs = groups.groupBy("doc_id", "text_sha256").agg(F.bool_and("kept").alias("_kept"), F.count("*").alias("_n"))
    found = pairs.filter("NOT _kept OR _n > 1").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "_kept")
    listed = materialise(found, "pipeline-copies")
    same = marked["doc_id"].cast("long").eqNullSafe(listed["_id"]) & (marked[mark] == listed["_sha"])
    single = marked.join(listed, same, "left_anti").select(*docs.columns)
    if listed.filter("_kept").isEmpty():
        return single
    # Each task reduces its repeats to one row per id and text before they meet.
    longest = F.struct(-F.length(F.coalesce("text", F.lit(""))), "text")
    rows = marked.join(listed.filter("_kept"), same, "left_semi").withColumn(order, longest)
    one = rows.groupBy("doc_id", mark).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return single.unionByName(one)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.75, the smallest id stays, a null id last.

    Rows that share an id or have none are told apart by their text.
    """
    shared = docs.groupBy(F.col("doc_id").cast("long").alias("_id")).count().filter("_id IS NULL OR count > 1").select("_id")
    shared = materialise(shared, "pipeline-shared")
    if not shared.isEmpty():
        return _near_rows(docs, shared)
    components = jaccard_join.jaccard_components(docs)
    return _without(docs, components.filter("component_id < doc_id").select(F.col("doc_id").alias("_dropped")))


def _near_rows(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Near copies where ids are null or shared: such rows get numbers of their own above all ids, by id and text."""
    mark, vertex = free_name(docs, "_mark"), free_name(docs, "_vertex")
    marked = docs.withColumn(mark, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    number = marked["doc_id"].cast("long")
    keys = marked.join(shared, number.eqNullSafe(shared["_id"])).select("_id", F.col(mark).alias("_sha")).distinct()
    named = keys.withColumn("_key", F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), "_sha"))
    named = materialise(named, "pipeline-keys")
    top = docs.agg(F.coalesce(F.max(F.col("doc_id").cast("long")), F.lit(0))).first()[0]
    coded = named.join(dense_codes(named, "_key", "_code"), "_key").select("_id", "_sha", (F.col("_code") + top + 1).alias("_own"))
    coded = materialise(coded, "pipeline-numbers")
    own = number.eqNullSafe(coded["_id"]) & (marked[mark] == coded["_sha"])
    rows = marked.join(coded, own, "left").select(*[marked[c] for c in docs.columns], F.coalesce("_own", number).alias(vertex))
    components = materialise(jaccard_join.jaccard_components(rows, vertex), "pipeline-near")
    order = F.struct(
        (F.col("_own").isNotNull() & F.col("_id").isNull()).alias("n"), F.when(F.col("_own").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("i"), "_sha"
    )
    ordered = components.join(coded, components["doc_id"] == coded["_own"], "left").select("doc_id", "component_id", order.alias("o"))
    first = ordered.groupBy("component_id").agg(F.min_by("doc_id", "o").alias("_first"))
    dropped = ordered.join(first, "component_id").filter("doc_id <> _first").select(F.col("doc_id").alias("_dropped")).distinct()
    return rows.join(dropped, rows[vertex] == dropped["_dropped"], "left_anti").select(*docs.columns)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The planner sends the list of dropped ids to all tasks only if it is small."""
    dropped = dropped.filter("_dropped IS NOT NULL").distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kinds; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 4096."""
    return packing.pack(docs, public_tokenizers.path(WORDS), END)


def _bounded(stage):
    """The stage with Arrow batches bounded by bytes: the executors run all stages in the same memory."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_classifier", _bounded(quality_filter)),
    ("exact_dedup", _bounded(exact_copies)),
    ("ngram_jaccard", _bounded(near_copies)),
    ("pii", _bounded(personal_data)),
    ("packing", _bounded(pack_sequences)),
]

#: Learned scores and tokenizers have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's table is stored in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of this subpackage, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.llm import (
    byte_bpe, exact_dedup, greedy_bpe, jaccard_join, license_scan, packing, periodic_runs, pii, quality, token_alignment, token_counts,
    token_store, topk,
)
from coinslot.llm.rows import documents
from coinslot.session import materialise, shared_dir

BYTES = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"
MERGES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ids that close a document: contract of the store and the packer, and the tokenizer's own end mark.
END, MARK = 2, 49407


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORDS)
    return token_counts.token_counts(documents(spark, sf_dir), shared_dir(spark, "flat-tokens"), path, MARK)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTES)
    encoded = byte_bpe.encode_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-store")
    token_store.write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path(WORDS), END)
    stored = token_store.read_tokens(spark, folder)
    rows = token_store.with_starts(token_store.checksums(stored), stored)
    return rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_checksums(packing.pack(documents(spark, sf_dir), public_tokenizers.path(WORDS), END))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.labelled_sample(docs, labels))
    scored = quality.score_documents(docs, model)
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)


def op11_greedy_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(MERGES)
    decoded = greedy_bpe.decode_documents(greedy_bpe.encode_documents(documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(MERGES), public_tokenizers.path(PIECES)
    aligned = token_alignment.align_documents(documents(spark, sf_dir), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    stored = materialise(aligned.withColumn("groups_sha256", digest).drop("groups"), "token-alignment")
    return token_alignment.score_links(stored)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumns({"_best": periodic_runs.longest_run(F.col("runs")), "_lines": F.array_join(lines, "")})
    best = F.col("_best")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_token_counts, op3_byte_bpe, op4_token_store, op5_packing, op6_quality, op7_exact_dedup,
        op8_license_scan, op9_pii, op10_topk, op11_greedy_bpe, op12_token_alignment, op13_periodic_runs,
    )
}

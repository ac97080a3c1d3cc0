"""File landing: incremental CSV ingest, schema evolution, rescued values, content checksums."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from coinslot.session import read_stored

FILES_PER_TRIGGER = 256
#: Bytes that are hashed at once.
BLOCK_BYTES = 32 * 1024 * 1024
RESCUED = "_rescued_data"
GENERATIONS = "generation int, body string"
LINEAGE = ["_source_file", "_ingested_at", "_dataset_key"]
WIDENING = [IntegerType(), LongType(), DoubleType()]


def wider(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if a in WIDENING and b in WIDENING:
        return WIDENING[max(WIDENING.index(a), WIDENING.index(b))]
    return StringType()


def evolve_schema(known: StructType | None, seen: StructType) -> StructType:
    """Known columns first, new ones appended; a column seen with another type is widened."""
    if known is None:
        return seen
    fields = [StructField(f.name, wider(f.dataType, seen[f.name].dataType) if f.name in seen.names else f.dataType) for f in known]
    return StructType(fields + [f for f in seen if f.name not in known.names])


def load_schema(spark: SparkSession, store: str) -> StructType | None:
    """The newest stored schema generation, None before the first."""
    rows = read_stored(spark, GENERATIONS, store, "json")
    newest = rows.orderBy(F.desc("generation")).first()
    return StructType.fromJson(json.loads(newest["body"])) if newest else None


def track_schema(spark: SparkSession, sample: str, store: str) -> StructType:
    """Infers the schema of the files in ``sample``, merges it with the stored one, stores a change."""
    known = load_schema(spark, store)
    seen = spark.read.option("header", True).option("inferSchema", True).csv(sample).schema
    merged = evolve_schema(known, seen)
    store_schema(spark, store, merged)
    return merged


def store_schema(spark: SparkSession, store: str, schema: StructType) -> None:
    """Adds a generation, unless the newest one is this schema."""
    if schema != load_schema(spark, store):
        last = read_stored(spark, GENERATIONS, store, "json").agg(F.max("generation")).first()[0]
        generation = 0 if last is None else last + 1
        row = spark.createDataFrame([(generation, schema.json())], GENERATIONS)
        row.coalesce(1).write.mode("append").json(store)


def as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


def rescue(df: DataFrame, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """Text columns to their types; a value that does not fit is NULL and kept in ``_rescued_data``, as is
    every value of a column that is neither in ``schema`` nor in ``keep`` (default: all others are kept)."""
    casts: dict[str, Column] = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    misfits = [F.when(F.col(n).isNotNull() & c.isNull(), F.col(n)).alias(n) for n, c in casts.items()]
    others = [c for c in df.columns if c not in casts]
    kept = others if keep is None else [c for c in others if c in keep]
    unknown = [F.col(c) for c in others if c not in kept]
    return df.select(
        *[c.alias(n) for n, c in casts.items()],
        F.nullif(F.to_json(F.struct(*misfits, *unknown)), F.lit("{}")).alias(RESCUED),
        *kept,
    )


def _headers(batch: DataFrame) -> dict[str, list[str]]:
    """Files of a batch by their first line. The batch has ``value``, ``path`` and ``block`` of its lines;
    it holds a bounded number of files, so their list fits the driver."""
    first = batch.withColumn("_n", F.monotonically_increasing_id()).filter("block = 0")
    found: dict[str, list[str]] = {}
    for row in first.groupBy("path").agg(F.min_by("value", "_n").alias("header")).orderBy("path").collect():
        found.setdefault(row["header"], []).append(row["path"])
    return found


def ingest_csv(
    spark: SparkSession, folder: str, target: str, checkpoint: str, schemas: str, dataset_key: str,
    hints: StructType | None = None, new_columns: bool = True, max_files: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Takes in the CSV files not seen before, each bound by its own header; returns the whole target.

    The schema is tracked in ``schemas``: known columns keep their type, new ones are added with the type of
    ``hints`` or the inferred one. Whatever does not fit goes to ``_rescued_data``: values of another type, and
    with ``new_columns=False`` whole columns. Columns that a file lacks are NULL. A batch writes its own folder,
    so a replay replaces itself.
    """
    hints = hints or StructType()

    def typed(seen: StructType) -> StructType:
        return StructType([StructField(f.name, hints[f.name].dataType if f.name in hints.names else f.dataType) for f in seen])

    def write(batch: DataFrame, batch_id: int) -> None:
        groups = list(_headers(batch).values())
        if not groups:
            return
        frames = [
            spark.read.option("header", True).csv(paths).select("*", F.col("_metadata.file_path").alias(LINEAGE[0]))
            for paths in groups
        ]
        known = load_schema(spark, schemas)
        for paths in groups:
            seen = typed(spark.read.option("header", True).option("inferSchema", True).csv(paths).schema)
            fresh = [f for f in seen if known is None or (new_columns and f.name not in known.names)]
            known = StructType([*(known or StructType()), *fresh])
        store_schema(spark, schemas, known)
        parts = []
        for frame in frames:
            absent = {f.name: F.lit(None).cast("string") for f in known if f.name not in frame.columns}
            parts.append(rescue(frame.withColumns(absent), known, LINEAGE[:1]))
        rows = reduce(DataFrame.unionByName, parts).withColumns(
            {LINEAGE[1]: F.current_timestamp(), LINEAGE[2]: F.lit(dataset_key)}
        )
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/batch_id={batch_id}")

    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )
    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    known = load_schema(spark, schemas) or StructType()
    extra = StructType([StructField(RESCUED, StringType()), *ingest_lineage()])
    return read_stored(spark, StructType([*known, *extra]), target)


def ingest_lineage() -> list[StructField]:
    return [StructField(c, TimestampType() if c == "_ingested_at" else StringType()) for c in LINEAGE]


def csv_stream(
    spark: SparkSession, folder: str, schema: StructType, dataset_key: str, max_files: int = FILES_PER_TRIGGER
) -> DataFrame:
    raw = (
        spark.readStream.schema(as_text(schema))
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_source_file"),
            F.current_timestamp().alias("_ingested_at"),
            F.lit(dataset_key).alias("_dataset_key"),
        )
    )
    return rescue(raw, schema)


def ingest_files(
    spark: SparkSession, folder: str, target: str, checkpoint: str, schema: StructType, dataset_key: str,
    max_files: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Takes in the files not seen before, then stops; returns the whole target."""
    query = (
        csv_stream(spark, folder, schema, dataset_key, max_files)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def folder_manifest(spark: SparkSession, folder: str, pattern: str = "*", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per file: name, path, length and a digest of its whole content.

    Files are hashed block by block where they are read, so a task holds one block and a large file is spread
    over many tasks. ``sha256`` is the SHA-256 over the blocks' digests in order. Blocks are read by offset,
    for stores that Arrow can open. Files without bytes are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )
    last = F.greatest(F.col("length") - 1, F.lit(0))
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(block_bytes).cast("long"))).alias("at"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                store, name = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(name) as source:
                    data = source.read_at(min(block_bytes, row["length"] - row["at"]), row["at"])
                found.append(hashlib.sha256(data).hexdigest())
            yield batch.append_column("digest", pa.array(found, pa.string()))

    hashed = blocks.repartition("path", "at").mapInArrow(digests, "path string, length long, at long, digest string")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x.digest)
    return hashed.groupBy("path", "length").agg(F.sha2(F.concat_ws("", ordered), 256).alias("sha256")).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length", "sha256"
    )


def folder_digest(manifest: DataFrame) -> DataFrame:
    """One digest per folder, independent of read order: file digests are hashed per bucket,
    then the at most 256 bucket digests are."""
    leaf = F.sha2(F.concat_ws(":", "file_name", "sha256"), 256)
    buckets = (
        manifest.select(leaf.alias("leaf"), "length")
        .groupBy(F.substring("leaf", 1, 2).alias("bucket"))
        .agg(F.sort_array(F.collect_list("leaf")).alias("leaves"), F.count("*").alias("n"), F.sum("length").alias("b"))
        .select("bucket", F.sha2(F.concat_ws("", "leaves"), 256).alias("digest"), "n", "b")
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "digest"))), lambda x: x.digest)
    return buckets.agg(
        F.sha2(F.concat_ws("", ordered), 256).alias("checksum"),
        F.sum("n").alias("files"),
        F.sum("b").alias("bytes"),
    )


def changed_files(manifest: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Files that are new or differ from the previous manifest; empty means: skip the load."""
    if previous is None:
        return manifest
    return manifest.join(previous.select("path", "sha256"), ["path", "sha256"], "left_anti")


def land(df: DataFrame, folder: str, ingest_date: str, fmt: str = "csv") -> None:
    """Writes one ingest day below ``folder``; rerunning the day replaces it."""
    df.write.mode("overwrite").option("header", True).format(fmt).save(f"{folder}/ingest_date={ingest_date}")

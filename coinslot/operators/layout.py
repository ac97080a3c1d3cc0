"""Table layout: clustered writes, compaction, publishing by location swap, maintenance."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinslot.operators.skipping import ROW_GROUP_ROWS, skipping_write
from coinslot.session import materialise, table_dir


def clustered_write(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Range-partitioned and sorted by ``keys``, so row-group statistics can skip data.

    Range bounds are sampled over all keys plus a spread column: one hot key value is cut over
    several files instead of filling one.
    """
    spread = F.xxhash64(*df.columns)
    ranges = [*[F.col(k) for k in keys], spread]
    placed = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    placed.sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def declare(spark: SparkSession, table: str, schema: StructType) -> None:
    """Creates an empty parquet table below the warehouse, unless it exists."""
    if not spark.catalog.tableExists(table):
        path = table_dir(spark, table)
        spark.createDataFrame([], schema).write.parquet(path)
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)


def append(df: DataFrame, path: str, evolve: bool = False) -> None:
    """Appends to a parquet folder. Strict by default: the columns and types must be the stored ones.

    With ``evolve`` new columns may appear; read such a folder with ``read_evolved``.
    """
    stored = _stored_types(df.sparkSession, path)
    given = {f.name: f.dataType for f in df.schema}
    if stored is not None:
        clash = [c for c in given if c in stored and given[c] != stored[c]]
        if clash or (not evolve and set(given) != set(stored)):
            raise ValueError(f"schema mismatch on append: {sorted(given)} to {sorted(stored)}, types differ: {clash}")
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def _stored_types(spark: SparkSession, path: str) -> dict | None:
    try:
        return {f.name: f.dataType for f in read_evolved(spark, path).schema}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def analyse(spark: SparkSession, table: str) -> None:
    """Table and column statistics; nested columns have none."""
    nested = ("array", "map", "struct", "timestamp_ntz", "variant")
    columns = [f"`{c}`" for c, t in spark.table(table).dtypes if not t.startswith(nested)]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, from the file listing only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Rewrites a folder of small parquet files into files of about ``target_bytes``."""
    files = max(1, math.ceil(folder_bytes(spark, source) / target_bytes))
    spark.read.parquet(source).repartition(files).write.mode("errorifexists").parquet(target)
    return files


def publish(
    df: DataFrame, table: str, cluster_by: list[str] | None = None, bloom: list[str] | None = None,
    row_group_rows: int = ROW_GROUP_ROWS,
) -> None:
    """Staged publish: a fresh folder is written and counted, then the table points to it.

    Readers see the old or the new mart; a failed or incomplete write leaves the old one in place. Only
    where the columns changed is the table dropped and made again, as a location cannot carry columns.
    With ``bloom`` columns the layout serves lookups on each clustering key (see ``operators.skipping``).
    Folders of earlier versions stay for running readers; the operator removes them.
    """
    spark = df.sparkSession
    path = table_dir(spark, table)
    if cluster_by:
        # Stored first: the range exchange reads its input twice, and the stored rows are what must arrive.
        staged = materialise(df, "publish")
        if bloom:
            skipping_write(staged, path, cluster_by, bloom, row_group_rows=row_group_rows)
        else:
            clustered_write(staged, path, cluster_by)
    else:
        df.write.option("compression", "zstd").parquet(path)
    fresh = spark.read.parquet(path)
    rows = fresh.count()
    if rows == 0:
        raise ValueError(f"refusing to publish an empty {table}")
    if cluster_by and rows != staged.count():
        raise ValueError(f"{table}: {rows} rows arrived of {staged.count()}")
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == fresh.schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def publish_external(df: DataFrame, fmt: str, **options: str) -> None:
    """The same mart to any batch sink on the classpath (warehouse connector, jdbc)."""
    df.write.format(fmt).options(**options).mode("overwrite").save()


def publish_existing(spark: SparkSession, marts: list[str], send) -> list[str]:
    """Calls ``send(name, frame)`` for every mart that exists; returns the skipped names."""
    missing = [m for m in marts if not spark.catalog.tableExists(m)]
    for mart in marts:
        if mart not in missing:
            send(mart, spark.table(mart))
    return missing


def maintain(spark: SparkSession, tables: list[str], target_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Compacts and analyses each table; a failure is reported and does not stop the others."""
    outcome = {}
    for table in tables:
        try:
            rows = spark.table(table)
            location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]
            path = table_dir(spark, table)
            compact(spark, location, path, target_bytes)
            if spark.read.parquet(path).schema != rows.schema:
                raise ValueError("schema changed while compacting")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            analyse(spark, table)
            outcome[table] = "ok"
        except Exception as error:  # noqa: BLE001 - isolated per table
            outcome[table] = f"failed: {error}"
    return outcome

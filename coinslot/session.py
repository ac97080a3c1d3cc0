"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings that may be changed on a running session. Skewed joins are split at run time, also
# where the split costs one more exchange: a hot key may hold a third of all rows. Stream state
# lives in RocksDB, so it may outgrow executor memory.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submitter owns master and memory."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's checkpoint folder, never on one machine's disk.

    Only a local session without ``spark.checkpoint.dir`` gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="coinslot-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/coinslot/{purpose}-{uuid.uuid4().hex}"


def table_dir(spark: SparkSession, table: str) -> str:
    """A fresh folder for a published table, below the warehouse: scratch folders expire, tables do not."""
    base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/coinslot/{table.replace('.', '-')}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **changed: str) -> Iterator[None]:
    """Session settings (dots as double underscores) for what is executed inside only."""
    changed = {key.replace("__", "."): value for key, value in changed.items()}
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def collecting(spark: SparkSession, seconds: float = 5.0) -> Iterator[None]:
    """The driver's JVM collects its garbage at once, every few seconds inside, and once behind.

    Spark deletes the shuffle files of a lineage nobody holds any more only when the driver meets it as garbage.
    """
    done, jvm = threading.Event(), spark.sparkContext._jvm

    def run() -> None:
        while not done.wait(seconds):
            jvm.System.gc()

    def now() -> None:
        gc.collect()
        jvm.System.gc()

    thread = threading.Thread(target=run, daemon=True)
    now()
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
        now()


def materialise(df, purpose: str):
    """Write once, read many: a columnar cut in the lineage that outlives lost executors.

    The shuffle files of the write go with it, as nothing reads them again.
    """
    path = shared_dir(df.sparkSession, purpose)
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Deletes the scratch folders that ``df`` reads from, for what nothing reads any more; tables and inputs stay."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def located(path: str):
        path = jvm.org.apache.hadoop.fs.Path(path)
        files = path.getFileSystem(conf)
        return files, files.makeQualified(path)

    scratch = located(shared_dir(spark, "any"))[1].getParent().toString()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        files, path = located(folder)
        if path.getParent().toString() == scratch:
            files.delete(path, True)


def read_stored(spark: SparkSession, schema, path: str, fmt: str = "parquet"):
    """A control folder that may not have been written yet: then it is empty."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

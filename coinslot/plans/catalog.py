"""Catalog enrichment and embedding: model calls are the caller's functions, run in tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coinslot.functions.expr import document_text, parsed_once
from coinslot.model.schemas import ENRICHMENT, RETRO_APPEAL
from coinslot.session import materialise, read_stored

CATALOG_KEY = ["title", "platform_code"]
PROMPT_FIELDS = ["title", "platform_code", "era", "genre", "publisher"]

# The answer's contract is the schema; the instruction states it and nothing else.
INSTRUCTION = (
    f"Reply with one JSON object per request, matching {ENRICHMENT.simpleString()} "
    f"with retro_appeal in {'/'.join(RETRO_APPEAL)}."
)


def enrichment_todo(source: DataFrame, done: DataFrame | None, n: int | None = None) -> DataFrame:
    """The titles not enriched yet; with ``n`` the ``n`` best-selling of them."""
    todo = source.select(*PROMPT_FIELDS, "global_sales_musd")
    if done is not None:
        todo = todo.join(done.select(*CATALOG_KEY), CATALOG_KEY, "left_anti")
    return todo if n is None else todo.orderBy(F.desc("global_sales_musd"), *[F.asc(c) for c in PROMPT_FIELDS]).limit(n)


def prompt_text():
    """The prompt fields as JSON; absent ones are left out."""
    return F.to_json(F.struct(*PROMPT_FIELDS))


def _ask(
    complete: Callable[[list[str], str], list[str]], prompts: list[str], tries: int, pause: float
) -> list[tuple[str | None, str | None]]:
    """Answers of one call for several prompts; a call that keeps failing is an error of each of them."""
    for attempt in range(tries):
        try:
            answers = complete(prompts, INSTRUCTION)
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
            return [(answer, None) for answer in answers]
        except Exception as error:  # noqa: BLE001 - a model client may raise anything
            message = str(error)
            if attempt + 1 < tries:
                time.sleep(pause * 2**attempt)
    return [(None, message)] * len(prompts)


def complete_catalog(
    todo: DataFrame, complete: Callable[[list[str], str], list[str]], tries: int = 3, pause: float = 1.0,
    prompts_per_call: int = 32, parallelism: int | None = None,
) -> DataFrame:
    """``todo`` plus ``raw`` (the completion) and ``call_error``.

    Each task calls with a list of prompts at a time. ``parallelism`` bounds how many tasks call at once,
    where the model's owner asks for it; otherwise the session's shuffle setting decides.
    """
    columns = todo.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = batch["_prompt"].tolist()
            answers = [
                pair for i in range(0, len(prompts), prompts_per_call)
                for pair in _ask(complete, prompts[i : i + prompts_per_call], tries, pause)
            ]
            yield batch[columns].assign(raw=[a for a, _ in answers], call_error=[e for _, e in answers])

    schema = StructType([*todo.schema.fields, *[StructField(c, StringType()) for c in ("raw", "call_error")]])
    asked = todo.withColumn("_prompt", prompt_text())
    asked = asked.repartition(parallelism, *CATALOG_KEY) if parallelism else asked.repartition(*CATALOG_KEY)
    return asked.mapInPandas(run, schema)


def validate_completions(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``enrichment`` and ``reject_reason`` (NULL for a usable completion)."""
    schema = StructType([*ENRICHMENT.fields, StructField("_bad", StringType())])
    parsed = parsed_once(F.col(raw), schema, {"columnNameOfCorruptRecord": "_bad"})
    reason = (
        F.when(F.col(raw).isNull(), "no completion")
        .when(F.col("_e").isNull() | F.col("_e._bad").isNotNull(), "invalid json")
        .when(~F.coalesce(F.col("_e.retro_appeal").isin(*RETRO_APPEAL), F.lit(False)), "invalid retro_appeal")
    )
    checked = df.withColumn("_e", parsed).withColumn("reject_reason", reason)
    usable = F.when(F.col("reject_reason").isNull(), F.col("_e").dropFields("_bad"))
    return checked.withColumn("enrichment", usable).drop("_e")


def enrich(todo: DataFrame, complete: Callable[[list[str], str], list[str]], **options) -> DataFrame:
    return validate_completions(complete_catalog(todo, complete, **options))


def accepted(enriched: DataFrame) -> DataFrame:
    return enriched.filter("reject_reason IS NULL").select(*PROMPT_FIELDS, "enrichment.*")


def rejected(enriched: DataFrame) -> DataFrame:
    return enriched.filter("reject_reason IS NOT NULL").drop("enrichment")


def enrich_into(
    spark: SparkSession, source: DataFrame, complete: Callable[[list[str], str], list[str]], folder: str, run: str,
    n: int | None = None, **options,
) -> None:
    """Enriches titles that are not accepted yet and stores both outcomes below ``folder``.

    ``run`` names the run: its folders are overwritten, so a repeated run replaces itself and asks again only
    for what other runs left open. Rejected titles are asked again by later runs.
    """
    done = stored_enrichment(spark, folder).filter(F.col("run") != run)
    answers = materialise(enrich(enrichment_todo(source, done, n), complete, **options), "enriched")
    accepted(answers).write.mode("overwrite").parquet(f"{folder}/accepted/run={run}")
    rejected(answers).write.mode("overwrite").parquet(f"{folder}/rejected/run={run}")


def stored_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    fields = [StructField(c, StringType()) for c in PROMPT_FIELDS]
    return read_stored(spark, StructType([*fields, *ENRICHMENT.fields, StructField("run", StringType())]), f"{folder}/accepted")


def catalog_documents(catalog: DataFrame) -> DataFrame:
    return catalog.select(*CATALOG_KEY, document_text("title", "platform_code", "genre", "sub_genre").alias("document"))


def embed(documents: DataFrame, model: Callable[[list[str]], np.ndarray], chunk: int = 250) -> DataFrame:
    """Title, platform and vector; the model gets at most ``chunk`` texts per call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["document"].tolist()
            rows = [v for i in range(0, len(texts), chunk) for v in model(texts[i : i + chunk])]
            yield batch[CATALOG_KEY].assign(embedding=[np.asarray(v, dtype="float32") for v in rows])

    return documents.mapInPandas(run, "title string, platform_code string, embedding array<float>")


def terms(text: str):
    """Runs of letters and digits in lower case; none for a null text."""
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.filter(F.split(lowered, "[^a-z0-9]+"), lambda t: t != "")


def term_vectors(documents: DataFrame, dims: int = 256) -> DataFrame:
    """The embedder without a model client: hashed term counts, weighted by rarity, of length one.

    Built-in stages only; what is fitted is ``dims`` document counts. A text without terms has the zero vector,
    and so have texts all of whose terms are in every document.
    """
    bare = "title string, platform_code string, embedding array<float>, n_terms int"
    counted = documents.select(*CATALOG_KEY, terms("document").alias("_terms"))
    counts = HashingTF(numFeatures=dims, inputCol="_terms", outputCol="_counts").transform(counted)
    if counts.isEmpty():
        return documents.sparkSession.createDataFrame([], bare)
    weighted = IDF(inputCol="_counts", outputCol="_weighted").fit(counts).transform(counts)
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit").transform(weighted)
    return unit.select(*CATALOG_KEY, vector_to_array("_unit", "float32").alias("embedding"), F.size("_terms").alias("n_terms"))

"""Declarative data-quality rules: warn, drop or fail, with every failing row quarantined.

A rule whose condition is NULL counts as passed. All rules are evaluated in one projection as a
bit mask; rule names are only spelled out for failing rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from coinslot.session import shared_dir

MASK = "_dq_mask"
FAILED = "_dq_failed_rules"


class QualityError(ValueError):
    pass


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")


@dataclass(frozen=True)
class DQResult:
    valid: DataFrame
    quarantine: DataFrame
    flagged: DataFrame


def sales_rules(as_of: str = "current_date()") -> list[Expectation]:
    # Names, conditions and actions of the sales contract.
    regions = " + ".join(f"coalesce({r}_sales, 0)" for r in ("na", "eu", "jp", "other"))
    return [
        Expectation("game_title_not_null", "title IS NOT NULL AND length(trim(title)) > 0", "drop"),
        Expectation("platform_known", "platform_code IS NOT NULL", "drop"),
        Expectation("year_plausible", f"release_year BETWEEN 1990 AND year({as_of}) + 1", "warn"),
        Expectation("sales_non_negative", "global_sales_musd >= 0", "fail"),
        Expectation("regions_sum_matches", f"abs({regions} - global_sales_musd) < 0.05", "warn"),
    ]


def event_rules(as_of: str = "current_timestamp()") -> list[Expectation]:
    # Names, conditions and actions of the event contract.
    member = "channel_code LIKE 'membership%'"
    return [
        Expectation("event_id_not_null", "event_id IS NOT NULL", "fail"),
        Expectation("price_positive", "unit_price > 0 OR channel_code = 'membership_included'", "drop"),
        Expectation("discount_bounded", "discount_pct IS NULL OR discount_pct BETWEEN 0 AND 1", "drop"),
        Expectation("membership_tier_consistency", f"NOT {member} OR membership_tier IS NOT NULL", "warn"),
        Expectation("freshness", f"occurred_at <= {as_of} + INTERVAL 5 MINUTES", "warn"),
    ]


def _mask(rules: Sequence[Expectation]) -> Column:
    bits = [F.when(~F.expr(r.condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("int")


def _names(rules: Sequence[Expectation]) -> Column:
    return F.array_compact(
        F.array(*[F.when(F.col(MASK).bitwiseAND(1 << i) != 0, r.name) for i, r in enumerate(rules)])
    )


def _drop_bits(rules: Sequence[Expectation], policy: str, mode: str) -> int:
    """Which failing rules remove a row. In ``reference`` mode one drop rule arms all of them."""
    everything = (1 << len(rules)) - 1
    if policy == "drop":
        return everything
    if mode == "reference":
        return everything if any(r.action == "drop" for r in rules) else 0
    return sum(1 << i for i, r in enumerate(rules) if r.action in ("drop", "fail"))


def apply_expectations(
    df: DataFrame, rules: Sequence[Expectation], policy: str = "warn", mode: str = "reference"
) -> DQResult:
    """Lazy: the flagged frame and its two halves. Hard rules are enforced by ``run_expectations``."""
    if policy not in ("warn", "drop", "fail") or mode not in ("reference", "per_rule"):
        raise ValueError(f"unknown policy or mode: {policy}, {mode}")
    flagged = df.withColumn(MASK, _mask(rules))
    drop = _drop_bits(rules, policy, mode)
    kept = flagged.filter(F.col(MASK).bitwiseAND(drop) == 0) if drop else flagged
    bad = flagged.filter(F.col(MASK) != 0).withColumn(FAILED, _names(rules))
    return DQResult(kept.drop(MASK), bad.drop(MASK), flagged)


def rule_counts(result: DQResult, rules: Sequence[Expectation]) -> DataFrame:
    """Failures per broken rule, summed from the bits: no row is expanded, each task sends one row."""
    counts = result.flagged.agg(
        *[F.count_if(F.col(MASK).bitwiseAND(1 << i) != 0).alias(r.name) for i, r in enumerate(rules)]
    )
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("failures")) for r in rules])
    return counts.select(F.inline(pairs)).filter("failures > 0")


def run_expectations(
    df: DataFrame,
    rules: Sequence[Expectation],
    quarantine_path: str,
    policy: str = "warn",
    mode: str = "reference",
    run_id: str | None = None,
) -> DataFrame:
    """Evaluates the input once: stores the flagged rows, appends quarantine, enforces hard rules.

    The quarantine folder of ``run_id`` is overwritten, so a retried run does not count twice. Without one
    each call is a run of its own and adds to the quarantine.
    """
    run_id = run_id or uuid.uuid4().hex
    spark = df.sparkSession
    stage = shared_dir(spark, "dq")
    flagged = df.withColumn(MASK, _mask(rules))
    flagged.withColumn("_dq_ok", F.col(MASK) == 0).write.partitionBy("_dq_ok").parquet(stage)
    schema = StructType([*flagged.schema.fields, StructField("_dq_ok", BooleanType())])
    stored = spark.read.schema(schema).parquet(stage)
    bad = stored.filter(~F.col("_dq_ok")).drop("_dq_ok").withColumn(FAILED, _names(rules))
    (
        bad.drop(MASK)
        .withColumn("_quarantined_at", F.current_timestamp())
        .write.mode("overwrite")
        .parquet(f"{quarantine_path}/run_id={run_id}")
    )
    hard = sum(1 << i for i, r in enumerate(rules) if r.action == "fail" or policy == "fail")
    seen = bad.agg(
        F.count("*").alias("rows"), F.coalesce(F.bit_or(MASK), F.lit(0)).alias("bits")
    ).first()
    if seen["bits"] & hard:
        raise QualityError(
            f"Hard data-quality expectation breached ({seen['rows']} rows quarantined in {quarantine_path})"
        )
    drop = _drop_bits(rules, policy, mode)
    kept = stored.filter(F.col(MASK).bitwiseAND(drop) == 0) if drop else stored
    return kept.select(*df.columns)


def empty_tables(counts: dict[str, DataFrame]) -> DataFrame:
    """Freshness gate: names of the tables that hold no row, found without counting them."""
    probes = [
        df.select(F.lit(name).alias("table_name")).limit(1).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name, df in counts.items()
    ]
    return reduce(DataFrame.unionByName, probes).filter("n = 0").select("table_name")


def recent_failures(quarantine: DataFrame, at: str, as_of: str, days: int = 1) -> DataFrame:
    """Quarantined rows per rule in the last ``days`` before ``as_of``.

    The outer explode loses nothing, as each row has a failed rule; the inner one would push the
    computation of the names below every join to test that they are not empty.
    """
    since = F.col(at) > F.expr(f"{as_of} - INTERVAL {days} DAYS")
    return (
        quarantine.filter(since & (F.col(at) <= F.expr(as_of)))
        .select(F.explode_outer(FAILED).alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("failures"))
    )

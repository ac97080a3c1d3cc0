"""Slowly changing history (type 2) from change-data-capture envelopes.

Changes are appended to a log, one folder per micro-batch, overwritten on replay; the history is
derived from the log. Each version ends where the next version by LSN begins, so late, repeated
and reordered changes all lead to the same history. Deletes are versions with ``is_deleted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinslot.functions.expr import parsed_once
from coinslot.model.schemas import envelope_schema
from coinslot.operators.dedup import best_row
from coinslot.operators.hotkeys import MAX_GROUP_ROWS, find_hot_keys, last_known, next_in_key

TECHNICAL = ["_pk", "_op", "_lsn", "_committed_at"]


def parse_envelopes(raw: DataFrame, payload: StructType, value: str = "value") -> DataFrame:
    """Text envelopes to columns; other columns of ``raw`` are kept."""
    others = [c for c in raw.columns if c != value]
    return raw.select(parsed_once(value, envelope_schema(payload)).alias("_d"), *others).select("_d.*", *others)


def flatten_envelope(df: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per change. A delete carries only ``before``, so each column falls back to it."""
    fields = df.schema["after"].dataType.names
    payload = {f: F.when(F.col("after").isNotNull(), F.col(f"after.{f}")).otherwise(F.col(f"before.{f}")) for f in fields}
    return df.select(
        F.coalesce(f"after.{key}", f"before.{key}").alias("_pk"),
        F.col("op").alias("_op"),
        F.col("source.lsn").alias("_lsn"),
        F.timestamp_millis("ts_ms").alias("_committed_at"),
        *[c.alias(f) for f, c in payload.items()],
        *keep,
    )


def last_writer(changes: DataFrame, batch: str | None = None) -> DataFrame:
    """The newest change per key, or per key and batch."""
    keys = ["_pk"] if batch is None else ["_pk", batch]
    rest = [c for c in changes.columns if c not in (*keys, "_lsn")]
    return best_row(changes, keys, "_lsn", *rest)


def distinct_changes(changes: DataFrame) -> DataFrame:
    """One row per (key, LSN): replays fold into one."""
    rest = [c for c in changes.columns if c not in ("_pk", "_lsn")]
    return best_row(changes, ["_pk", "_lsn"], *rest)


def scd2_history(
    changes: DataFrame,
    batch: str | None = None,
    collapse_within_batch: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """History of flattened changes; ``collapse_within_batch`` keeps one version per key and batch.

    Hot keys are looked up in ``changes``, so that should be a scan. Without one, a single exchange
    by key serves both dedups and the window; with one, replays are folded by (key, LSN) first.
    """
    hot = find_hot_keys(changes, ["_pk"], "_lsn", max_group_rows)
    placed = changes.repartition("_pk") if hot is None else changes
    if collapse_within_batch:
        if batch is None:
            raise ValueError("collapse_within_batch needs the batch column")
        placed = last_writer(placed, batch)
    unique = distinct_changes(placed if batch is None else placed.drop(batch))
    linked = next_in_key(unique, ["_pk"], "_lsn", ["_committed_at"], "_next", hot)
    return linked.select(
        *unique.columns,
        (F.col("_op") == "d").alias("is_deleted"),
        F.col("_committed_at").alias("valid_from"),
        F.col("_next._committed_at").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_apply(
    history: DataFrame | None, batch: DataFrame, key: str, collapse_within_batch: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """History after one more batch of envelopes: same state for a replayed batch."""
    flat = flatten_envelope(batch, key)
    if collapse_within_batch:
        flat = last_writer(flat)
    if history is not None:
        flat = history.select(*flat.columns).unionByName(flat)
    return scd2_history(flat, max_group_rows=max_group_rows)


def append_changes(batch: DataFrame, batch_id: int, key: str, log: str, collapse_within_batch: bool = False) -> None:
    """``foreachBatch`` body: writes only this batch's folder, so a replay replaces itself."""
    flat = flatten_envelope(batch, key)
    if collapse_within_batch:
        flat = last_writer(flat)
    flat.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") & ~F.col("is_deleted"))


def scd2_as_of(history: DataFrame, at: Column) -> DataFrame:
    """Versions valid at a moment, tombstones left out."""
    open_ended = F.col("valid_to").isNull() | (F.col("valid_to") > at)
    return history.filter((F.col("valid_from") <= at) & open_ended & ~F.col("is_deleted"))


def point_in_time_join(
    facts: DataFrame, history: DataFrame, fact_key: str, at: str, columns: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each fact with the version valid at its time, or NULLs.

    Facts and versions are sorted together per key and the latest version is carried forward, so
    no fact meets every version of its key. Should the clock run against the LSN, the version that
    started last wins. Both inputs should be stored data.
    """
    version = F.struct("valid_from", "valid_to", "is_deleted", *columns)
    started = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    events = facts.select(
        F.col(fact_key).alias("_k"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast("long").alias("_seq"), F.struct(*facts.columns).alias("_fact"),
    )
    starts = started.select(
        F.col("_pk").alias("_k"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
        F.col("_lsn").alias("_seq"), version.alias("_version"),
    )
    timeline = events.unionByName(starts, allowMissingColumns=True)
    order = ["_k", "_at", "_kind", "_seq"]
    hot = find_hot_keys(events.select(*order).unionByName(starts.select(*order)), ["_k"], "_at", max_group_rows, order[2:])
    filled = last_known(timeline, ["_k"], "_at", ["_kind", "_seq"], "_version", "_seen", hot)
    alive = (F.col("_seen.valid_to").isNull() | (F.col("_at") < F.col("_seen.valid_to"))) & ~F.col("_seen.is_deleted")
    return filled.filter("_kind = 1").select(
        "_fact.*", *[F.when(alive, F.col(f"_seen.{c}")).alias(c) for c in columns]
    )

"""Ordered windows that survive a hot key.

A window partitioned by a key puts the whole key into one task. Here every key above
``max_group_rows`` is cut into slices along the window's whole order, ties included; the window runs
per (key, slice) and what crosses a slice border is carried over from a small per-slice summary. Without
a hot key the plan is the plain window. The results are the same rows and values either way.

Looking for hot keys is one more pass over the key and order columns: give ``find_hot_keys`` a cheap
frame with at least the rows per key of the frame that is windowed, such as the scan before a dedup.
The cuts are stored, as two branches of the plan read them and must see the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinslot.session import materialise

MAX_GROUP_ROWS = 5_000_000
#: Share of the limit that a slice aims at, and sampled rows per slice.
FILL, SAMPLED = 0.6, 64


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def _precedes(left: Column, right: Column, fields: list[str], newest_first: bool) -> Column:
    """Whether one struct of order values comes before another: the first field may be descending, the
    others ascend; NULL is the smallest value."""

    def less(a: Column, b: Column) -> Column:
        return F.coalesce(a < b, a.isNull() & b.isNotNull())

    out = F.lit(False)
    for i, field in reversed(list(enumerate(fields))):
        a, b = left[field], right[field]
        before = less(b, a) if newest_first and i == 0 else less(a, b)
        out = before | (a.eqNullSafe(b) & out)
    return out


def find_hot_keys(
    probe: DataFrame, keys: list[str], order: str, max_group_rows: int = MAX_GROUP_ROWS,
    ties: list[str] | None = None, newest_first: bool = False,
) -> DataFrame | None:
    """The hot keys with their cuts along ``order`` and ``ties``, or None when no key is over the limit.

    At most ``rows / max_group_rows`` keys can be hot, and a key has a cut per slice, so this stays small
    next to the data; whether it is broadcast is still left to the planner.
    """
    fields = [order, *(ties or [])]
    probe = probe.select(*keys, *fields)
    hot = probe.groupBy(*keys).count().filter(F.col("count") > max_group_rows)
    if hot.isEmpty():
        return None
    aim = max(1.0, max_group_rows * FILL)
    chosen = F.pmod(F.xxhash64(*fields), F.lit(1_000_000)) < int(min(1.0, SAMPLED / aim) * 1_000_000)
    wanted = _renamed(hot, keys)
    sample = probe.filter(chosen).join(wanted, _same(probe, wanted, keys))
    in_order = lambda a, b: (
        F.when(_precedes(a, b, fields, newest_first), -1).when(_precedes(b, a, fields, newest_first), 1).otherwise(0)
    )
    sorted_ = F.array_sort(F.collect_list(F.struct(*fields)), in_order)
    found = sample.groupBy(*keys).agg(sorted_.alias("_s"), F.max("count").alias("_n"))
    slices = F.ceil(F.col("_n") / aim).cast("int")
    at = F.sequence(F.lit(1), F.greatest(slices - 1, F.lit(1)))
    cut = F.transform(at, lambda i: F.get("_s", (i * F.size("_s") / slices).cast("int")))
    return materialise(_renamed(found.select(*keys, F.array_distinct(F.array_compact(cut)).alias("_cuts")), keys), "cuts")


def _slice(df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], newest_first: bool = False) -> DataFrame:
    """Adds ``_slice``: how many cuts of the key come before the row. The sorted cuts are searched in
    two steps, every n-th cut first, so a row of a hot key meets about twice the root of them."""
    row = F.struct(*order)

    def before(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: _precedes(cut, row, order, newest_first)))

    step = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    marked = hot.withColumn("_step", step).withColumn("_coarse", F.filter("_cuts", lambda _, i: (i + 1) % F.col("_step") == 0))
    return (
        df.join(marked, _same(df, marked, keys), "left")
        .withColumn("_hot", F.col("_cuts").isNotNull())
        .withColumn("_from", F.when(F.col("_hot"), before(F.col("_coarse")) * F.col("_step")))
        .withColumn("_slice", F.coalesce(F.col("_from") + before(F.slice("_cuts", F.col("_from") + 1, F.col("_step"))), F.lit(0)))
        .drop("_cuts", "_coarse", "_from", "_step", *[f"_k_{k}" for k in keys])
    )


def _with_summary(sliced: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    side = _renamed(summary, [*keys, "_slice"])
    on = _same(sliced, side, [*keys, "_slice"])
    return sliced.join(side, on, "left").drop(*[f"_k_{k}" for k in [*keys, "_slice"]])


def next_in_key(
    df: DataFrame, keys: list[str], order: str, values: list[str], out: str, hot: DataFrame | None
) -> DataFrame:
    """Adds ``out``: the following row's ``values`` as a struct, NULL on the last row of a key."""
    row = F.struct(*values)
    if hot is None:
        return df.withColumn(out, F.lead(row).over(Window.partitionBy(*keys).orderBy(order)))
    sliced = _slice(df, hot, keys, [order])
    inside = Window.partitionBy(*keys, "_slice").orderBy(order)
    firsts = sliced.filter("_hot").groupBy(*keys, "_slice").agg(F.min_by(row, F.col(order)).alias("_first"))
    carry = firsts.select(
        *keys, "_slice", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carry")
    )
    joined = _with_summary(sliced.withColumn(out, F.lead(row).over(inside)), carry, keys)
    return joined.withColumn(out, F.coalesce(out, "_carry")).drop("_carry", "_slice", "_hot")


def newest_rank(
    df: DataFrame, keys: list[str], order: str, ties: list[str], out: str, hot: DataFrame | None
) -> DataFrame:
    """Adds ``out``: 1 for the newest row of a key, 2 for the one before, and so on.

    ``hot`` comes from ``find_hot_keys`` with the same ``ties`` and ``newest_first``.
    """
    ordering = [F.col(order).desc_nulls_last(), *ties]
    if hot is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    sliced = _slice(df, hot, keys, [order, *ties], newest_first=True)
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*ordering))
    later = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.filter("_hot").groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    newer = sizes.select(*keys, "_slice", F.sum("_n").over(later).alias("_newer"))
    joined = _with_summary(sliced.withColumn(out, inside), newer, keys)
    total = F.col(out) + F.coalesce("_newer", F.lit(0))
    return joined.withColumn(out, total.cast("int")).drop("_newer", "_slice", "_hot")


def last_known(
    df: DataFrame, keys: list[str], order: str, ties: list[str], value: str, out: str, hot: DataFrame | None
) -> DataFrame:
    """Adds ``out``: the latest non-NULL ``value`` of the key up to and including this row."""
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(order, *ties).rowsBetween(*so_far)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(window))
    sliced = _slice(df, hot, keys, [order, *ties])
    inside = Window.partitionBy(*keys, "_slice").orderBy(order, *ties).rowsBetween(*so_far)
    ends = (
        sliced.filter(F.col("_hot"))
        .groupBy(*keys, "_slice")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(order, *ties))).alias("_end"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    joined = _with_summary(sliced.withColumn(out, F.last(value, ignorenulls=True).over(inside)), carry, keys)
    return joined.withColumn(out, F.coalesce(out, "_carry")).drop("_carry", "_slice", "_hot")

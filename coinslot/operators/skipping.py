"""Tables that lookups on several keys can skip through: Morton order over ranks, and bloom filters.

A range order serves its first key only. Here each key becomes a rank among sampled quantiles, the bits of
all ranks are interleaved, and the table is range-partitioned and sorted by that number: a row group then
covers a narrow range of every key, and its statistics skip it for any of them. Keys that lie anywhere
within a group's range still meet its bloom filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks are searched in two steps of this width, so a key has STEP * STEP ranks.
STEP = 32
#: Rows sampled for the quantiles, whatever the size of the table. They decide the layout, never the content.
SAMPLE = 100_000
ROW_GROUP_ROWS = 1_000_000


def quantiles(df: DataFrame, keys: list[str]) -> dict[str, list]:
    """At most STEP * STEP ascending bounds per key, of any orderable type, from a bounded sample of rows."""
    rows = df.count()
    share = min(1.0, 2 * SAMPLE / rows) if rows else 1.0
    sample = (df if share == 1.0 else df.sample(share, seed=7)).select(*keys).limit(2 * SAMPLE)
    bounds = {}
    for key, column in zip(keys, zip(*[tuple(r) for r in sample.collect()]) if rows else [()] * len(keys)):
        values = sorted(v for v in column if v is not None and v == v)
        at = sorted({len(values) * i // (STEP * STEP) for i in range(1, STEP * STEP)})
        bounds[key] = [values[i] for i in at] if values else []
    return bounds


def rank(key: str, bounds: list, kind: str) -> Column:
    """How many bounds are not above the key, found in two steps; null and NaN have their own places: first and last."""
    if not bounds:
        return F.lit(0)
    blocks = [bounds[i : i + STEP] for i in range(0, len(bounds), STEP)]
    value = F.col(key)

    def listed(values: list) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values])

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    block = F.greatest(below(listed([b[0] for b in blocks])), F.lit(1))
    found = (block - 1) * STEP + below(F.element_at(F.array(*[listed(b) for b in blocks]), block))
    return F.when(value.isNull(), 0).otherwise(found).cast("long")


def morton(ranks: list[Column]) -> Column:
    """The bits of all ranks interleaved, highest first."""
    bits = int(math.log2(STEP * STEP))
    code = F.lit(0).cast("long")
    for bit in range(bits):
        for place, r in enumerate(reversed(ranks)):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)), bit * len(ranks) + place))
    return code


def skipping_write(
    df: DataFrame, path: str, keys: list[str], bloom: list[str] | None = None, files: int | None = None,
    row_group_rows: int = ROW_GROUP_ROWS,
) -> None:
    """Writes ``df`` in Morton order of ``keys`` (up to six) with bloom filters on the ``bloom`` columns.

    ``df`` is read three times (count, quantiles, rows): pass a stored table. Rows that share all keys are
    cut over files by a hash of the row, so a hot key does not fill one file. A row group's filter is sized
    for as many values as the group has rows.
    """
    if not 1 <= len(keys) <= 6:
        raise ValueError("one to six keys")
    kinds, bounds = dict(df.dtypes), quantiles(df, keys)
    code, spread = "_morton", F.xxhash64(*df.columns)
    while code in df.columns:
        code += "_"
    coded = df.withColumn(code, morton([rank(k, bounds[k], kinds[k]) for k in keys]))
    placed = coded.repartitionByRange(*([files] if files else []), F.col(code), *[F.col(k) for k in keys], spread)
    writer = placed.sortWithinPartitions(code, *keys).drop(code).write.mode("errorifexists")
    writer = writer.option("compression", "zstd").option("parquet.block.row.count.limit", row_group_rows)
    for column in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", row_group_rows)
        # Otherwise the writer leaves the filter out where a dictionary holds all values of the group.
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def rows_scanned(df: DataFrame) -> tuple[list, int]:
    """The rows of a point lookup and how many rows its scans handed on after skipping row groups and pages."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return rows, _scanned(plan)


def _scanned(plan) -> int:
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _scanned(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _scanned(plan.plan())
    if name.startswith("Scan"):
        return plan.metrics().apply("numOutputRows").value()
    children = plan.children()
    return sum(_scanned(children.apply(i)) for i in range(children.size()))

"""Connected components of an edge list that may be larger than any machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.session import materialise


def contracted(edges: DataFrame) -> DataFrame:
    """The edges of each task as stars around the smallest id: fewer edges, the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
                parent.setdefault(min(a, b), min(a, b))
        rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], names=["u", "v"]
        )

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a vertex moves to the least of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reached) of every vertex that is not its own component.

    ``edges`` (u, v): order, repeats and loops do not matter; rows with a null end are left out. Every step
    reduces to one row per vertex before rows meet and is stored, so a vertex may have any number of
    neighbours and a lost executor costs one step.
    """
    state = materialise(contracted(edges.filter("u <> v")), "components")
    before = None
    while True:
        seen = state.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if seen == before or seen[0] == 0:
            return state.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = seen
        state = materialise(_small_star(_large_star(state)), "components")

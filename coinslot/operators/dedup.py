"""One row per key, chosen by a total order.

``max_by`` keeps one candidate per key and map task before the shuffle, so a key with very many
copies costs the shuffle one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The row with the greatest ``order`` per key (NULL is smallest). Give a full tie-break."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def append_dedup(target: DataFrame, incoming: DataFrame, key: str, cursor: str, since=None) -> DataFrame:
    """Current-state table: rows past the cursor are merged, the greatest cursor per key wins.

    On equal cursors the incoming row wins, so a corrected reload replaces what it corrects.
    """
    fresh = incoming if since is None else incoming.filter(F.col(cursor) > F.lit(since))
    both = target.withColumn("_origin", F.lit(0)).unionByName(
        fresh.withColumn("_origin", F.lit(1)), allowMissingColumns=True
    )
    rest = [c for c in both.columns if c not in (key, cursor, "_origin")]
    return best_row(both, [key], cursor, "_origin", *rest).drop("_origin")

"""Recommender: training set with dense ids, implicit matrix factorisation, recall."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinslot.session import collecting, materialise, settings

#: Players and titles scored by one task at a time, and by one matrix product, whose scores fit a processor's cache.
PLAYER_BLOCK, ITEM_BLOCK = 65_536, 131_072
TILE_USERS, TILE_ITEMS = 256, 2048
#: Bytes of the Arrow batches of blocks: a batch is not much more than one row.
BATCH_BYTES = 16_000_000
_FOUND = pa.list_(pa.struct([("prediction", pa.float32()), ("item_code", pa.int32())]))


def dense_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """``column`` with codes 0..n-1, in the order of the MD5 of the id; a null has none.

    The hash spreads any id set over 4096 even buckets: each bucket is numbered by itself and
    shifted by the sizes of the buckets before it, so no task sees all ids.
    """
    ids = df.select(column).dropna().distinct().withColumn("_h", F.md5(column)).withColumn("_b", F.substring("_h", 1, 3))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ids.groupBy("_b").count().select("_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", column))
    return (
        ids.withColumn("_n", inside)
        .join(shifts, "_b")
        .select(column, (F.col("_shift") + F.col("_n") - 1).cast("long").alias(out))
    )


def training_set(interactions: DataFrame, players: DataFrame) -> DataFrame:
    """Player code, item code, confidence and churn label per interaction.

    Players are coded before they meet the interactions, which are stored once joined, as their items are read apart.
    """
    pairs = interactions.select("player_id", "product_id", "confidence")
    met = players.select("player_id", "is_churned").join(pairs.select("player_id").distinct(), "player_id", "left_semi")
    known = materialise(met, "training-players")
    coded = known.join(dense_codes(known, "player_id", "player_code"), "player_id")
    labelled = materialise(pairs.join(coded, "player_id"), "training-pairs")
    return labelled.join(dense_codes(labelled, "product_id", "item_code"), "product_id").select(
        "player_id", "product_id", "player_code", "item_code", "confidence", "is_churned"
    )


def fit_recommender(training: DataFrame, rank: int = 16, iterations: int = 5) -> ALSModel:
    """Codes must fit an int, as the factoriser's ids do.

    Checkpoints cut the lineage in every iteration, so that the shuffle files of the iterations before can go.
    """
    als = ALS(
        userCol="player_code", itemCol="item_code", ratingCol="confidence", implicitPrefs=True,
        rank=rank, maxIter=iterations, seed=42, coldStartStrategy="nan", checkpointInterval=1,
    )
    ints = training.withColumns({c: F.col(c).cast("int") for c in ("player_code", "item_code")})
    with collecting(training.sparkSession):
        return als.fit(ints)


def popular_items(interactions: DataFrame, by: str, k: int) -> DataFrame:
    """Top-k items by a summed column: the report a recommender has to beat."""
    totals = interactions.groupBy("product_id").agg(F.sum(F.col(by).cast("decimal(18,4)")).alias("total"))
    return totals.orderBy(F.desc("total"), "product_id").limit(k).select("product_id")


def _improve(
    users: np.ndarray, best: np.ndarray, at: np.ndarray, items: np.ndarray, codes: np.ndarray, had_user: np.ndarray, had_item: np.ndarray
) -> None:
    """Brings the best scores of each user (falling, -inf where there are fewer) and their titles ``at`` up to date with
    a block of titles, without the pairs ``had`` (positions of both).

    Exact: items come by falling length, and a tile of users ends early only where no item left can pass any
    user's last score, as a product is at most that of the lengths. Users who end alike share tiles.
    """
    k, all_best, all_at = best.shape[1], best, at
    reach = np.linalg.norm(users, axis=1) * np.float32(1.0001)
    with np.errstate(all="ignore"):
        turn = np.argsort(-best[:, -1] / reach, kind="stable")
    users, reach, best, at, spot = users[turn], reach[turn], best[turn], at[turn], np.empty(len(turn), "int64")
    spot[turn] = np.arange(len(turn))
    had_user = spot[had_user]
    lengths = np.linalg.norm(items, axis=1)
    order = np.argsort(-lengths, kind="stable")
    items, lengths, codes = np.ascontiguousarray(items[order].T), lengths[order], codes[order]
    place = np.empty(len(order), "int64")
    place[order] = np.arange(len(order))
    # The pairs to leave out, by tile of users, then by item.
    had_item = place[had_item]
    sort = np.lexsort((had_item, had_user // TILE_USERS))
    had_user, had_item = had_user[sort], had_item[sort]
    ends = np.searchsorted(had_user // TILE_USERS, np.arange(len(users) // TILE_USERS + 2))
    for tile, low in enumerate(range(0, len(users), TILE_USERS)):
        some, some_best, some_at = users[low : low + TILE_USERS], best[low : low + TILE_USERS], at[low : low + TILE_USERS]
        rows, columns = had_user[ends[tile] : ends[tile + 1]] - low, had_item[ends[tile] : ends[tile + 1]]
        for start in range(0, len(order), TILE_ITEMS):
            if (reach[low : low + TILE_USERS] * lengths[start] <= some_best[:, -1]).all():
                break
            scores = some @ items[:, start : start + TILE_ITEMS]
            a, b = np.searchsorted(columns, (start, start + TILE_ITEMS))
            scores[rows[a:b], columns[a:b] - start] = -np.inf
            if start == 0 and np.isneginf(some_best).all():
                width = min(k, scores.shape[1])
                top = np.argpartition(-scores, width - 1, axis=1)[:, :width]
                some_best[:, :width], some_at[:, :width] = np.take_along_axis(scores, top, 1), codes[top]
                sort = np.argsort(-some_best, axis=1, kind="stable")
                some_best[:], some_at[:] = np.take_along_axis(some_best, sort, 1), np.take_along_axis(some_at, sort, 1)
                continue
            hit, column = np.divmod(np.flatnonzero(scores > some_best[:, -1:]), scores.shape[1])
            if not len(hit):
                continue
            touched = np.unique(hit)
            owner = np.concatenate([np.repeat(touched, k), hit])
            value = np.concatenate([some_best[touched].ravel(), scores[hit, column]])
            where = np.concatenate([some_at[touched].ravel(), codes[column + start]])
            # Equal scores: those of earlier titles first.
            sort = np.lexsort((np.arange(len(owner)), -value, owner))
            first = np.searchsorted(owner[sort], touched)
            keep = sort[first[:, None] + np.arange(k)]
            some_best[touched], some_at[touched] = value[keep], where[keep]
    all_best[turn], all_at[turn] = best, at


def _positions(of: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each value of ``of`` stands in ``among``; -1 if nowhere."""
    order = np.argsort(among)
    at = order[np.minimum(np.searchsorted(among, of, sorter=order), len(among) - 1)]
    return np.where(among[at] == of, at, -1)


def _packed(pairs: DataFrame, n: int, **columns: str) -> DataFrame:
    """Two columns of numbers as bytes per batch and block, by the first one modulo ``n``: few rows to send."""
    (first, first_type), (second, second_type) = columns.items()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, others = batch.column(0).to_numpy(), batch.column(1)
            others = others.flatten().to_numpy().reshape(len(codes), -1) if pa.types.is_list(others.type) else others.to_numpy()
            blocks = codes % n
            for block in np.unique(blocks).tolist():
                some = blocks == block
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int32()), first: [codes[some].astype(first_type).tobytes()], second: [others[some].astype(second_type).tobytes()]}
                )

    return pairs.mapInArrow(run, f"block int, {first} binary, {second} binary")


def _blocks(packed: DataFrame, n: int) -> DataFrame:
    """One row per block, each in a partition of its own: the bytes of its rows one after another."""
    names = packed.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, block = {name: [] for name in names}, None
        for batch in batches:
            block = batch.column("block")[-1:] if batch.num_rows else block
            for name in names:
                found[name] += batch.column(name).drop_null().to_pylist()
        if block is not None:
            yield pa.RecordBatch.from_pydict({"block": block, **{name: [b"".join(found[name])] for name in names}})

    return packed.repartitionById(n, "block").mapInArrow(run, packed.schema)


def _best_in_stream(pairs: Iterator[pa.RecordBatch], k: int, across: int) -> Iterator[pa.RecordBatch]:
    """Blocks of players, each with the titles they have, against blocks of titles, which come one by one: a list per player."""
    state = {}
    for batch in pairs:
        for row in batch.to_pylist():
            codes = np.frombuffer(row["item_codes"], "<i4")
            items = np.frombuffer(row["item_vectors"], "<f4").reshape(len(codes), -1)
            if row["down"] not in state:
                names = np.frombuffer(row["codes"], "<i4")
                if not len(names):
                    continue
                users = np.frombuffer(row["vectors"], "<f4").reshape(len(names), -1)
                had_user, had_item = _positions(np.frombuffer(row["had_player"], "<i4"), names), np.frombuffer(row["had_item"], "<i4")
                sort = np.argsort(had_item % across, kind="stable")
                had_user, had_item = had_user[sort], had_item[sort]
                ends = np.searchsorted(had_item % across, np.arange(across + 1))
                best, at = np.full((len(names), k), -np.inf, "float32"), np.zeros((len(names), k), "int32")
                state[row["down"]] = names, users, had_user, had_item, ends, best, at
            names, users, had_user, had_item, ends, best, at = state[row["down"]]
            here = slice(*ends[row["across"] : row["across"] + 2])
            had_user, had_item = had_user[here], _positions(had_item[here], codes)
            known = (had_user >= 0) & (had_item >= 0)
            _improve(users, best, at, items, codes, had_user[known], had_item[known])
    for names, _, _, _, _, best, at in state.values():
        # Of equal scores the greater code comes first.
        sort = np.lexsort((-at, -best))
        best, at = np.take_along_axis(best, sort, 1), np.take_along_axis(at, sort, 1)
        real = np.isfinite(best)
        offsets = np.concatenate([[0], real.sum(axis=1).cumsum()]).astype("int32")
        found = pa.StructArray.from_arrays([pa.array(best[real]), pa.array(at[real])], fields=list(_FOUND.value_type))
        yield pa.RecordBatch.from_pydict({"player_code": pa.array(names), "found": pa.ListArray.from_arrays(offsets, found).cast(_FOUND)})


def best_items(
    training: DataFrame, model: ALSModel, k: int, player_block: int = PLAYER_BLOCK, item_block: int = ITEM_BLOCK
) -> DataFrame:
    """The ``k`` best of all titles per player, without what the player has: player, item, score, rank.

    Every player is scored against every title. A task holds a block of players, with the titles they have, and meets
    the blocks of titles one by one: nothing is stored per pair of blocks, and only the final lists leave the task.
    Fewer than ``k`` are left only where the catalog has no more. Factors and lists are stored, so that the lineage
    of the fit, with its shuffle files, can go before and behind the scoring.
    """
    spark = training.sparkSession
    users, items = materialise(model.userFactors, "player-factors"), materialise(model.itemFactors, "title-factors")
    del model
    n_players, n_items = users.count(), items.count()
    across = max(1, math.ceil(n_items / item_block))
    wanted = 4 * spark.sparkContext.defaultParallelism
    down = max(1, math.ceil(n_players / player_block), min(wanted, math.ceil(n_players / TILE_USERS)))

    none = F.lit(None).cast("binary")
    had = training.select(*[F.col(c).cast("int").alias(c) for c in ("player_code", "item_code")]).dropna()
    asking = _packed(users.select("id", "features"), down, codes="<i4", vectors="<f4").withColumns({"had_player": none, "had_item": none})
    known = _packed(had, down, had_player="<i4", had_item="<i4").withColumns({"codes": none, "vectors": none})
    offered = _packed(items.select("id", "features"), across, item_codes="<i4", item_vectors="<f4")
    # The left side of the product is read as a stream, the right side, a block of players, is held.
    left = _blocks(offered, across).withColumnRenamed("block", "across").coalesce(1).hint("shuffle_replicate_nl")
    right = _blocks(asking.unionByName(known), down).withColumnRenamed("block", "down")
    scored = left.crossJoin(right).mapInArrow(
        lambda pairs: _best_in_stream(pairs, k, across), "player_code int, found array<struct<prediction: float, item_code: int>>"
    )
    with collecting(spark), settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        best = materialise(scored, "lists")
    players, titles = (training.select(n, c).distinct() for n, c in (("player_id", "player_code"), ("product_id", "item_code")))
    listed = best.join(players, "player_code").select("player_id", F.posexplode("found").alias("at", "f")).select(
        "player_id", F.col("f.item_code").cast("long").alias("item_code"), F.col("f.prediction").alias("prediction"), (F.col("at") + 1).alias("rank")
    )
    return listed.join(titles, "item_code").select("player_id", "product_id", "prediction", "rank")

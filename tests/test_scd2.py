import itertools
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from coinslot.model.schemas import CDC_KEYS, envelope_schema, payload_schema, struct
from coinslot.operators import scd2

PAYLOAD = struct("order_id string, player_id string, order_status string")
BASE = 1_700_000_000_000


def envelope(order_id, status, op, lsn, with_after=True):
    row = (order_id, "P1", status)
    before, after = (None, row) if with_after else (row, None)
    return (before, after, op, BASE + lsn * 1000, (BASE + lsn * 1000, lsn, 1, "orders", "false"))


def batch(spark, *envelopes):
    return spark.createDataFrame(list(envelopes), envelope_schema(PAYLOAD))


def state(history):
    rows = history.orderBy("_pk", "_lsn").collect()
    return [(r._pk, r._lsn, r.order_status, r.is_current, r.is_deleted, r.valid_from, r.valid_to) for r in rows]


def test_update_closes_the_previous_version(spark):
    h = scd2.scd2_apply(None, batch(spark, envelope("O1", "PLACED", "c", 100)), "order_id")
    h = scd2.scd2_apply(h, batch(spark, envelope("O1", "SHIPPED", "u", 200)), "order_id")
    first, second = state(h)
    assert first[2:4] == ("PLACED", False) and first[6] == second[5]
    assert second[2:4] == ("SHIPPED", True) and second[6] is None


def test_replay_is_idempotent(spark):
    b = batch(spark, envelope("O2", "PLACED", "c", 300))
    once = scd2.scd2_apply(None, b, "order_id")
    assert state(scd2.scd2_apply(once, b, "order_id")) == state(once)


def test_delete_is_a_tombstone(spark):
    h = scd2.scd2_apply(None, batch(spark, envelope("O3", "PLACED", "c", 400)), "order_id")
    h = scd2.scd2_apply(h, batch(spark, envelope("O3", "CANCELLED", "d", 500, with_after=False)), "order_id")
    current = h.filter("is_current").collect()
    assert len(current) == 1 and current[0].is_deleted and current[0].order_id == "O3"
    assert scd2.scd2_current(h).count() == 0


def test_change_after_delete_reopens(spark):
    h = scd2.scd2_apply(None, batch(spark, envelope("O3", "X", "d", 500, with_after=False)), "order_id")
    h = scd2.scd2_apply(h, batch(spark, envelope("O3", "BACK", "c", 600)), "order_id")
    assert [r.order_status for r in scd2.scd2_current(h).collect()] == ["BACK"]


def test_late_lower_lsn_lands_closed(spark):
    h = scd2.scd2_apply(None, batch(spark, envelope("O4", "NEW", "u", 900)), "order_id")
    h = scd2.scd2_apply(h, batch(spark, envelope("O4", "OLD", "c", 100)), "order_id")
    assert [(s[2], s[3]) for s in state(h)] == [("OLD", False), ("NEW", True)]


def test_batch_collapse_keeps_the_last_writer_only(spark):
    b = batch(spark, envelope("O5", "A", "c", 1), envelope("O5", "B", "u", 2))
    assert len(state(scd2.scd2_apply(None, b, "order_id"))) == 1
    assert len(state(scd2.scd2_apply(None, b, "order_id", collapse_within_batch=False))) == 2


CHANGES = [
    envelope("A", "1", "c", 10), envelope("A", "2", "u", 20), envelope("B", "1", "c", 15),
    envelope("A", "3", "d", 30, with_after=False), envelope("A", "4", "c", 40),
]


def test_any_order_and_batching_gives_the_same_history(spark):
    expected = state(scd2.scd2_history(scd2.flatten_envelope(batch(spark, *CHANGES), "order_id")))
    rng = random.Random(7)
    for _ in range(3):
        shuffled = rng.sample(CHANGES, len(CHANGES))
        cut = rng.randint(1, 4)
        h = scd2.scd2_apply(None, batch(spark, *shuffled[:cut]), "order_id", collapse_within_batch=False)
        replay = shuffled[cut - 1 :]
        h = scd2.scd2_apply(h, batch(spark, *replay), "order_id", collapse_within_batch=False)
        assert state(h) == expected


@pytest.mark.parametrize("limit", [1, 3, 10**6])
def test_hot_keys_give_the_same_history(spark, limit):
    rng = random.Random(1)
    lsns = rng.sample(range(1000), 120)
    changes = [envelope("HOT" if i % 3 else f"K{i}", str(l), "u", l) for i, l in enumerate(lsns)]
    flat = scd2.flatten_envelope(batch(spark, *changes, *changes[:20]), "order_id")
    assert state(scd2.scd2_history(flat, max_group_rows=limit)) == state(scd2.scd2_history(flat))


def test_as_of_is_half_open(spark):
    h = scd2.scd2_history(scd2.flatten_envelope(batch(spark, *CHANGES), "order_id"))

    def at(lsn):
        moment = datetime.fromtimestamp((BASE + lsn * 1000) / 1000, tz=timezone.utc)
        return sorted((r._pk, r.order_status) for r in scd2.scd2_as_of(h, F.lit(moment)).collect())

    assert at(9) == []
    assert at(10) == [("A", "1")]
    assert at(20) == [("A", "2"), ("B", "1")]
    assert at(30) == [("B", "1")]
    assert at(41) == [("A", "4"), ("B", "1")]


@pytest.mark.parametrize("limit", [2, 10**6])
def test_point_in_time_join_matches_the_range_join(spark, limit):
    rng = random.Random(3)
    lsns = rng.sample(range(500), 60)
    changes = [
        envelope(rng.choice(["A", "A", "A", "B", "C"]), str(l), "d" if l % 7 == 0 else "u", l, with_after=l % 7 != 0)
        for l in lsns
    ]
    h = scd2.scd2_history(scd2.flatten_envelope(batch(spark, *changes), "order_id"))
    facts = [(i, rng.choice(["A", "A", "B", "Z"]), rng.randrange(-5, 505)) for i in range(200)]
    facts = facts + [(1000 + l, "A", l) for l in lsns]
    df = spark.createDataFrame(facts, "fact int, k string, l int").withColumn(
        "at", F.timestamp_millis(F.lit(BASE) + F.col("l").cast("long") * 1000)
    )
    got = scd2.point_in_time_join(df, h, "k", "at", ["order_status"], max_group_rows=limit)
    naive = df.join(
        h, (df.k == h._pk) & (h.valid_from <= df.at) & (h.valid_to.isNull() | (df.at < h.valid_to)) & ~h.is_deleted, "left"
    )
    pick = lambda d: sorted((r.fact, r.order_status or "") for r in d.select("fact", "order_status").collect())
    assert pick(got) == pick(naive)


def test_text_envelopes_and_payload_schemas(spark):
    b = batch(spark, envelope("O9", "PLACED", "c", 5))
    text = b.select(F.to_json(F.struct(*b.columns)).alias("value"))
    flat = scd2.flatten_envelope(scd2.parse_envelopes(text, PAYLOAD), "order_id").collect()
    assert [(r._pk, r._lsn, r.order_status) for r in flat] == [("O9", 5, "PLACED")]
    assert CDC_KEYS == {"orders": "order_id", "subscriptions": "subscription_id", "customers": "player_id"}
    assert all(payload_schema(e).names[0] == k for e, k in CDC_KEYS.items())


def test_every_permutation_of_three_changes(spark):
    three = CHANGES[:2] + CHANGES[3:4]
    results = set()
    for order in itertools.permutations(three):
        h = None
        for e in order:
            h = scd2.scd2_apply(h, batch(spark, e), "order_id")
        results.add(str(state(h)))
    assert len(results) == 1


def test_log_replay_overwrites_its_own_batch(spark, folder):
    b = batch(spark, *CHANGES)
    for n in (0, 1, 1):
        scd2.append_changes(b, n, "order_id", folder)
    log = spark.read.parquet(folder)
    assert log.count() == 2 * len(CHANGES)
    direct = scd2.scd2_history(scd2.flatten_envelope(b, "order_id"))
    assert state(scd2.scd2_history(log, batch="batch_id")) == state(direct)

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from coinslot.model.schemas import BRONZE_EVENT
from coinslot.operators import layout
from coinslot.sources.brokers import file_messages
from coinslot.streaming import backfill, early_panes, events, monitor, runs, windows

T0 = datetime(2024, 1, 1)


def message(n, seconds=0, **change):
    event = {
        "event_id": f"E{n}", "event_type": "PURCHASE", "player_id": "P1", "platform": "PS5",
        "occurred_at": (T0 + timedelta(seconds=seconds)).isoformat() + "Z", "channel_code": "digital_store",
        "product_id": "T1", "product_type": "GAME", "quantity": 1, "unit_price": 10.0, "discount_pct": None,
        "currency": "EUR", "producer_version": "1",
    }
    event.update(change)
    return json.dumps({k: v for k, v in event.items() if v is not None})


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    time.sleep(0.05)


def test_dead_letters_by_reason(spark):
    lines = [
        message(1), message(2)[:40], "[]", "", message(3, event_id=""), message(4, player_id=None),
        message(5, unit_price=None), message(6, quantity="two"), message(7, discount_pct=0.25, quantity=2),
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    ok, dlq = events.parse_with_dlq(raw)
    assert {r.event_id: r.net_revenue for r in ok.collect()} == {"E1": 10.0, "E7": 15.0}
    reasons = sorted(r.error for r in dlq.collect())
    assert reasons == ["missing mandatory keys"] * 2 + ["missing unit_price"] + ["unparseable"] * 4
    assert all(json.loads(r.letter)["raw"] == r.raw for r in dlq.collect())


def test_filters_do_not_copy_the_parser(spark):
    raw = spark.createDataFrame([(message(1),)], "value string")
    ok, _ = events.parse_with_dlq(raw)
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_bronze_dedups_and_restarts(spark, folder):
    land(f"{folder}/in", "a.json", [message(1), message(1), message(2), "broken"])

    def run():
        bronze = events.bronze_events(file_messages(spark, f"{folder}/in"))
        runs.finish(runs.append_files(bronze, f"{folder}/out", f"{folder}/cp"))
        return spark.read.parquet(f"{folder}/out")

    assert sorted(r.event_id for r in run().collect()) == ["E1", "E2"]
    land(f"{folder}/in", "b.json", [message(2), message(3, 10)])
    rows = run().collect()
    assert sorted(r.event_id for r in rows) == ["E1", "E2", "E3"]
    assert rows[0].event_date is not None and rows[0]._ingested_at is not None and rows[0].broker_ts is not None


def revenue_updates(spark, folder, files):
    for i, lines in enumerate(files):
        land(f"{folder}/in", f"{i}.json", lines)
    good, _ = events.parse_with_dlq(file_messages(spark, f"{folder}/in", max_files=1))
    query = runs.each_batch(
        windows.sliding_revenue(good), runs.folder_per_batch(f"{folder}/updates"), f"{folder}/cp", mode="update"
    )
    runs.finish(query)
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    final = windows.latest_per_window(spark.read.parquet(f"{folder}/updates"))
    return final, dropped


def test_late_rows_within_and_beyond_the_lateness(spark, folder):
    files = [
        [message(1, 1000)],
        [message(2, 1001)],
        [message(3, 800), message(4, 100)],
    ]
    final, dropped = revenue_updates(spark, folder, files)
    total = final.agg(F.sum("net_revenue")).first()[0]
    assert total == 3 * 4 * 10.0
    assert dropped == 4
    assert final.filter(F.col("window_start") < F.lit(T0 + timedelta(seconds=500))).count() == 0


@pytest.mark.parametrize("replay", [False, True])
def test_discarding_panes_add_up_to_the_windows(spark, folder, replay):
    files = [[message(1, 0), message(2, 20)], [message(3, 5)], [message(4, 40, platform="XS"), message(5, 41)]]
    for i, lines in enumerate(files):
        land(f"{folder}/in", f"{i}.json", lines)
    good, _ = events.parse_with_dlq(file_messages(spark, f"{folder}/in", max_files=1))
    sink = windows.PaneSink(spark, f"{folder}/panes")

    def body(batch, n):
        sink(batch, n)
        if replay:
            sink(batch, n)

    runs.finish(runs.each_batch(good, body, f"{folder}/cp"))
    all_lines = [(line,) for lines in files for line in lines]
    batch_good, _ = events.parse_with_dlq(spark.createDataFrame(all_lines, "value string"))
    expected = windows.sliding_revenue(batch_good)
    got = windows.panes_total(sink.panes())
    assert sorted(got.collect()) == sorted(expected.select(got.columns).collect())
    first = sink.panes().filter("batch_id = 0").agg(F.sum("pane")).first()[0]
    assert float(first) == 2 * 4 * 10.0


def test_panes_drop_only_past_window_end_plus_lateness(spark, folder):
    files = [[message(1, 1000)], [message(2, 690), message(3, 600)]]
    for i, lines in enumerate(files):
        land(f"{folder}/in", f"{i}.json", lines)
    good, _ = events.parse_with_dlq(file_messages(spark, f"{folder}/in", max_files=1))
    sink = windows.PaneSink(spark, f"{folder}/panes")
    runs.finish(runs.each_batch(good, sink, f"{folder}/cp"))
    late = sink.panes().filter("batch_id = 1").collect()
    assert late and all(r.window_end > T0 + timedelta(seconds=700) for r in late)
    assert {float(r.pane) for r in late} == {10.0}
    # What was too late is kept aside: three events in four windows each are accounted for.
    counted = [d.agg(F.sum("events")).first()[0] for d in (sink.panes(), sink.late())]
    assert sum(counted) == 12 and counted[1] > 0
    assert {r.mark for r in sink.late().collect()} == {T0 + timedelta(seconds=1000)}


@pytest.mark.parametrize("files", [1, 3, 12])
def test_stored_input_gives_the_same_result_for_any_files(spark, folder, files):
    """Days apart, in no order, each event twice in different files, and one batch replayed."""
    lines = [message(i % 40, 90_000 * ((i * 7) % 40)) for i in range(80)]
    for k in range(files):
        land(f"{folder}/in", f"{k}.json", lines[k::files])
    good = events.good_events(events.parse_messages(file_messages(spark, f"{folder}/in", max_files=1)))
    totals = backfill.WindowTotals(spark, f"{folder}/totals")
    first = runs.folder_per_batch(f"{folder}/once")

    def twice(body):
        def run(batch, n):
            for _ in range(2 if n == 1 else 1):
                body(batch, n)

        return run

    runs.finish(runs.each_batch(backfill.first_arrivals(good), twice(first), f"{folder}/cp-once"))
    priced = good.withColumn("net_revenue", F.col("unit_price"))
    runs.finish(runs.each_batch(priced, twice(totals), f"{folder}/cp"))
    once = spark.read.parquet(f"{folder}/once")
    assert sorted(r.event_id for r in once.collect()) == sorted(f"E{i}" for i in range(40))
    sums = totals.totals().collect()
    assert sum(r.net_revenue for r in sums) == 80 * 4 * 10.0 and len(sums) == 160


def test_split_outputs_writes_both_sides(spark, folder):
    land(f"{folder}/in", "a.json", [message(1), "broken", message(2, player_id="")])
    tagged = events.tag_messages(file_messages(spark, f"{folder}/in"))
    runs.finish(runs.each_batch(tagged, runs.split_outputs(f"{folder}/ok", f"{folder}/dead"), f"{folder}/cp"))
    assert spark.read.parquet(f"{folder}/ok").count() == 1
    dead = spark.read.json(f"{folder}/dead")
    assert sorted(r.error for r in dead.collect()) == ["missing mandatory keys", "unparseable"]


def test_lag_report(spark):
    df = spark.createDataFrame([("a", T0), ("a", T0 - timedelta(hours=2)), ("b", T0 - timedelta(hours=1))], "s string, t timestamp")
    seen = F.lit(T0 + timedelta(seconds=300))
    got = {r.s: (r.lag_seconds, r.breached) for r in monitor.lag_report(df, "s", "t", seen, "prod").collect()}
    assert got == {"a": (300, False), "b": (3900, True)}


def test_stream_into_a_declared_table(spark, folder):
    layout.declare(spark, "bronze_events", BRONZE_EVENT)
    layout.declare(spark, "bronze_events", BRONZE_EVENT)
    land(f"{folder}/in", "a.json", [message(1), message(2, 5)])
    bronze = events.bronze_events(file_messages(spark, f"{folder}/in")).select(*BRONZE_EVENT.names)
    runs.finish(runs.append_table(bronze, "bronze_events", f"{folder}/cp", interval=None))
    spark.catalog.refreshTable("bronze_events")
    table = spark.table("bronze_events")
    assert table.columns == BRONZE_EVENT.names
    assert sorted(r.event_id for r in table.collect()) == ["E1", "E2"]


def test_continuous_trigger_stops_on_request(spark, folder):
    land(f"{folder}/in", "a.json", [message(1)])
    bronze = events.bronze_events(file_messages(spark, f"{folder}/in"))
    query = runs.append_files(bronze, f"{folder}/out", f"{folder}/cp", interval="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(f"{folder}/out").count() == 1


def early_run(spark, folder, drain, delay_ms=500, slices=3):
    good, _ = events.parse_with_dlq(file_messages(spark, f"{folder}/in", max_files=1))
    panes = early_panes.early_panes(good, delay_ms=delay_ms, slices=slices)
    body = runs.folder_per_batch(f"{folder}/panes")
    if drain:
        return early_panes.finish_when_drained(runs.each_batch(panes, body, f"{folder}/cp", interval="2 seconds"), timeout=120)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        return runs.finish(runs.each_batch(panes, body, f"{folder}/cp"))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_early_panes_survive_a_restart_and_add_up(spark, folder):
    land(f"{folder}/in", "a.json", [message(n, 10 * n) for n in range(6)] + ["broken"])
    stopped = early_run(spark, folder, drain=False, delay_ms=2000)
    assert spark.read.parquet(f"{folder}/panes").count() == 0
    assert stopped.lastProgress["stateOperators"][0]["numRowsTotal"] > 0
    # Other rows of the same windows, a copy of a row, an event far in the past, and nothing else.
    land(f"{folder}/in", "b.json", [message(0), message(9, 5, quantity=3), message(10, -86400), message(11, 1, unit_price=0.0001)])
    early_run(spark, folder, drain=False, delay_ms=2000)
    land(f"{folder}/in", "c.json", [message(12, 3)])
    early_run(spark, folder, drain=True)
    rows = spark.read.parquet(f"{folder}/panes").collect()
    got = {}
    for r in rows:
        assert r.events > 0 and r.window_end - r.window_start == timedelta(seconds=60)
        total, n = got.get(r.window_start, (0, 0))
        got[r.window_start] = (total + r.pane, n + r.events)
    want = {}
    for at, price, n in [(10 * i, 10, 1) for i in range(6)] + [(0, 10, 1), (5, 30, 3), (-86400, 10, 1), (1, 0, 1), (3, 10, 1)]:
        for i in range(4):
            start = T0 + timedelta(seconds=at // 15 * 15 - 15 * i)
            total, count = want.get(start, (0, 0))
            want[start] = (total + price, count + 1)
    assert {k: (round(float(t), 3), n) for k, (t, n) in got.items()} == {k: (round(float(t), 3), n) for k, (t, n) in want.items()}


def test_early_panes_of_an_empty_source(spark, folder):
    land(f"{folder}/in", "a.json", ["broken"])
    early_run(spark, folder, drain=True)
    assert spark.read.schema("events bigint").parquet(f"{folder}/panes").count() == 0


def test_first_arrivals_repeat_an_uncommitted_batch(spark, folder):
    """The last batch's commit is lost: it runs again on the state before it and replaces its folder. Null keys and
    null times are keys too, the same key on another day is another event, and a column named _day stays."""
    schema = "event_id string, occurred_at timestamp, _day string"
    day = [T0, T0 + timedelta(days=1), None]
    batches = [
        [("a", day[0], "x"), ("a", day[0], "x"), (None, day[0], "x"), ("b", None, "x")],
        [("a", day[1], "y"), ("b", None, "x"), (None, day[0], "x"), ("c", day[0], "z")],
    ]

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
        body = runs.folder_per_batch(f"{folder}/out")
        runs.finish(runs.each_batch(backfill.first_arrivals(source), body, f"{folder}/cp"))
        rows = spark.read.parquet(f"{folder}/out").select("event_id", "occurred_at", "_day").collect()
        return sorted(map(str, rows))

    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{folder}/in/part={n}")
        time.sleep(0.05)
        got = run()
    want = {str(r) for r in spark.createDataFrame(batches[0] + batches[1], schema).collect()}
    assert got == sorted(want) and len(got) == 5
    last = max(int(f) for f in os.listdir(f"{folder}/cp/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{folder}/cp/commits/{name}"):
            os.remove(f"{folder}/cp/commits/{name}")
    assert run() == got


def test_early_panes_end_when_batches_outlast_their_interval(spark, folder):
    """A batch is always under way, as each takes longer than the trigger interval."""
    land(f"{folder}/in", "a.json", [message(1)])
    land(f"{folder}/in", "b.json", [message(2)])
    good, _ = events.parse_with_dlq(file_messages(spark, f"{folder}/in", max_files=1))
    write = runs.folder_per_batch(f"{folder}/panes")

    def slow(batch, n):
        write(batch, n)
        time.sleep(1.5)

    panes = early_panes.early_panes(good, delay_ms=100, slices=1)
    query = runs.each_batch(panes, slow, f"{folder}/cp", interval="100 milliseconds")
    early_panes.finish_when_drained(query, timeout=90)
    assert not query.isActive and query.exception() is None
    assert spark.read.parquet(f"{folder}/panes").agg(F.sum("events")).first()[0] == 8


def test_stream_files_grow_with_the_table(spark, folder):
    """A table that several tasks read makes as many files a batch, in the same number of batches."""
    from coinslot.checks import queries

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/events.parquet")
    with queries.setting(spark, "spark.sql.files.maxPartitionBytes", "4096"):
        wide = queries.splits(spark.read.parquet(f"{sf}/events.parquet"))
        stream = queries.scattered(spark, sf, folder, copies=2)
    assert wide > 1 and len([f for f in os.listdir(f"{folder}/source") if f.endswith(".parquet")]) == 4 * wide
    query = runs.finish(runs.each_batch(stream, runs.folder_per_batch(f"{folder}/out"), f"{folder}/cp"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(f"{folder}/out").count() == 2 * rows.count()

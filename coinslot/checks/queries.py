"""One entry per operator: each reads the whole tables of a scale-factor folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinslot.functions.expr import net_revenue, ratio, release_era
from coinslot.ml import cells, churn, forecast, metrics, recommend, similarity
from coinslot.model import schemas, views
from coinslot.model.dims import dim_channel, dim_console
from coinslot.model.views import purchases, read
from coinslot.operators import changes, layout, quality, scd2, skipping
from coinslot.operators.dedup import append_dedup, best_row
from coinslot.plans import catalog, features, gold, lookups, refresh, silver
from coinslot.session import discard, materialise, shared_dir, tune
from coinslot.sources import files
from coinslot.streaming import backfill, early_panes, monitor, runs, windows
from coinslot.streaming import events as stream_events

AS_OF = "DATE '2001-12-31'"
AS_OF_TS = "TIMESTAMP '2001-12-31 00:00:00'"
LSH_NEAR, LSH_RECALL = 0.05, 0.9
WEIGHTS = churn.LogisticWeights(intercept=0.4, recency_days=0.01, tenure_days=-0.0002, log_ltv=-0.1)

EVENT_FIELDS = (
    "event_id occurred_at player_id platform channel_code product_id product_type title quantity "
    "unit_price discount_pct is_preowned membership_tier"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def named(name: str):
    return partial(query, name=name)


def query(fn: Callable[[SparkSession, str], DataFrame], name: str | None = None):
    """Registers a query. Timestamps leave without a zone, as the parquet tables hold them; dates as
    midnight, so both engines hand out the same Python type."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(tune(spark), sf_dir)
        return df.select(
            *[F.col(c).cast("timestamp_ntz").alias(c) if t in ("timestamp", "date") else F.col(c) for c, t in df.dtypes]
        )

    QUERIES[name or fn.__name__] = run
    return run


# ---- building blocks -------------------------------------------------------------------------


def conformed_events(spark, sf, dirty=False):
    raw = purchases(spark, sf, *EVENT_FIELDS, dirty=dirty)
    return silver.purchase_events(raw, dim_channel(spark), dim_console(spark))


def silver_events(spark, sf):
    return quality.apply_expectations(conformed_events(spark, sf), quality.event_rules(AS_OF_TS)).valid


def conformed_sales(spark, sf):
    return silver.game_sales(views.raw_sales(spark, sf), views.raw_ratings(spark, sf), dim_console(spark))


def silver_sales(spark, sf):
    return quality.apply_expectations(conformed_sales(spark, sf), quality.sales_rules(AS_OF)).valid


def dirty_result(spark, sf):
    return quality.apply_expectations(conformed_events(spark, sf, dirty=True), quality.event_rules(AS_OF_TS))


def flat_changes(spark, sf, keep=()):
    envelopes = views.subscription_changes(read(spark, sf, "orders"))
    return scd2.flatten_envelope(envelopes, "subscription_id", keep)


def history(spark, sf):
    return scd2.scd2_history(flat_changes(spark, sf))


def player_360(spark, sf):
    return gold.player_360(silver_events(spark, sf), history(spark, sf), F.expr(AS_OF))


def published(spark, mart, name, row_group_rows=skipping.ROW_GROUP_ROWS):
    """The mart as a clustered table under a name of its own: lookups read what is stored, not the plan."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    layout.publish(mart, table, refresh.CLUSTERING[name], refresh.BLOOM.get(name), row_group_rows)
    return spark.table(table)


def series_split(spark, sf):
    return features.chronological_split(features.sales_timeseries(silver_events(spark, sf)))


def event_stream(spark, sf):
    return runs.parquet_stream(spark, f"{sf.rstrip('/')}/events.parquet")


# ---- scalars, dims, silver -------------------------------------------------------------------


@query
def era_binning(spark, sf):
    li = purchases(spark, sf, "event_id", "occurred_at")
    return li.select("event_id", release_era(F.year("occurred_at")).alias("era"))


@named("net_revenue")
def revenue_per_event(spark, sf):
    ev = purchases(spark, sf, "event_id", "unit_price", "quantity", "discount_pct")
    return ev.select("event_id", net_revenue("unit_price", "quantity", "discount_pct").alias("net_revenue"))


@named("dim_console")
def dim_console_usage(spark, sf):
    """The console dim with the number of purchases that match it."""
    used = purchases(spark, sf, "platform").groupBy(F.upper("platform").alias("code")).count()
    dim = dim_console(spark)
    return dim.join(used, F.upper("platform_code") == F.col("code"), "left").select(
        *dim.columns, F.coalesce("count", F.lit(0)).alias("purchases")
    )


@named("dim_channel")
def dim_channel_usage(spark, sf):
    used = purchases(spark, sf, "channel_code").groupBy("channel_code").agg(F.count("*").alias("purchases"))
    return dim_channel(spark).join(used, "channel_code", "left").fillna({"purchases": 0})


@query
def dedup_natural_key(spark, sf):
    li = read(spark, sf, "lineitem")
    return best_row(
        li, ["l_orderkey", "l_linenumber"], "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


@query
def silver_game_sales(spark, sf):
    return silver_sales(spark, sf)


@query
def silver_purchase_events(spark, sf):
    return silver_events(spark, sf).drop("platform", "product_id")


# ---- data quality ----------------------------------------------------------------------------


@query
def dq_sales_rules(spark, sf):
    result = quality.apply_expectations(conformed_sales(spark, sf), quality.sales_rules(AS_OF))
    return result.quarantine.select(
        "title", "platform_code", "release_year", F.concat_ws(",", quality.FAILED).alias("failed_rules")
    )


@query
def dq_event_rules(spark, sf):
    return dirty_result(spark, sf).flagged.select(
        "event_id",
        (F.col(quality.MASK) == 0).alias("is_valid"),
        F.bit_count(quality.MASK).alias("failures"),
    )


@query
def dq_quarantine(spark, sf):
    """The stored path: one evaluation, quarantine written and read back."""
    path = shared_dir(spark, "quarantine")
    quality.run_expectations(
        conformed_events(spark, sf, dirty=True), quality.event_rules(AS_OF_TS), path, run_id="1"
    )
    return spark.read.parquet(path).select("event_id", F.concat_ws(",", quality.FAILED).alias("failed_rules"))


@query
def dq_drop(spark, sf):
    return dirty_result(spark, sf).valid.select("event_id", "net_revenue")


@query
def dq_drop_per_rule(spark, sf):
    ev = conformed_events(spark, sf, dirty=True)
    result = quality.apply_expectations(ev, quality.event_rules(AS_OF_TS), mode="per_rule")
    return result.valid.select("event_id", "net_revenue")


@query
def dq_summary(spark, sf):
    return quality.rule_counts(dirty_result(spark, sf), quality.event_rules(AS_OF_TS))


@query
def freshness_gate(spark, sf):
    tables = {t: read(spark, sf, t) for t in ("orders", "lineitem", "customer", "part", "events")}
    tables["returned_orders"] = tables["orders"].filter("o_orderstatus = 'R'")
    return quality.empty_tables(tables)


@query
def quarantine_report(spark, sf):
    bad = dirty_result(spark, sf).quarantine
    return quality.recent_failures(bad, "occurred_at", "TIMESTAMP '2001-06-30 00:00:00'", days=365)


# ---- gold ------------------------------------------------------------------------------------


@query
def gold_sales_by_era_platform(spark, sf):
    return gold.sales_by_era_platform(silver_sales(spark, sf), silver_events(spark, sf))


@query
def gold_console_lifecycle(spark, sf):
    return gold.console_lifecycle(silver_sales(spark, sf))


@query
def gold_player_360(spark, sf):
    return player_360(spark, sf).withColumn("console_families", F.concat_ws(",", "console_families"))


@query
def gold_title_performance(spark, sf):
    return gold.title_performance(silver_sales(spark, sf), silver_events(spark, sf))


@query
def lookup_sales_by_era(spark, sf):
    mart = gold.sales_by_era_platform(silver_sales(spark, sf), silver_events(spark, sf))
    return lookups.lookup_sales_by_era(published(spark, mart, "gold_sales_by_era_platform"), "Xbox")


# ---- change data capture ---------------------------------------------------------------------


@query
def cdc_envelope_flatten(spark, sf):
    return flat_changes(spark, sf)


@query
def cdc_last_writer(spark, sf):
    return scd2.last_writer(flat_changes(spark, sf, ("batch",)), "batch").select(
        "_pk", "batch", "_lsn", "_op", "status", "mrr"
    )


@query
def scd2_history(spark, sf):
    return history(spark, sf)


@query
def scd2_history_collapsed(spark, sf):
    """Reference behaviour: one version per key and micro-batch."""
    return scd2.scd2_history(flat_changes(spark, sf, ("batch",)), "batch", collapse_within_batch=True)


@query
def scd2_stream(spark, sf):
    root = shared_dir(spark, "scd2")
    envelopes = views.subscription_changes(runs.parquet_stream(spark, f"{sf.rstrip('/')}/orders.parquet"))
    body = lambda batch, n: scd2.append_changes(batch, n, "subscription_id", f"{root}/log")
    runs.finish(runs.each_batch(envelopes, body, f"{root}/checkpoint"))
    return scd2.scd2_history(spark.read.parquet(f"{root}/log"), batch="batch_id")


def entity_history(spark, sf, entity, changes):
    """The history of an entity through a change log written per batch, each batch delivered twice."""
    root = shared_dir(spark, f"scd2-{entity}")
    rows = read(spark, sf, "orders")
    wide = splits(rows)
    changes(rows).repartition(4 * wide, "op", "ts_ms").write.parquet(f"{root}/source")
    key = schemas.CDC_KEYS[entity]

    def body(batch, n):
        for _ in range(2):
            scd2.append_changes(batch, n, key, f"{root}/log")

    stream = runs.parquet_stream(spark, f"{root}/source", max_files=2 * wide)
    runs.finish(runs.each_batch(stream, body, f"{root}/checkpoint"))
    return scd2.scd2_history(spark.read.parquet(f"{root}/log"), batch="batch_id")


@query
def scd2_orders(spark, sf):
    return entity_history(spark, sf, "orders", views.order_changes)


@query
def scd2_customers(spark, sf):
    return entity_history(spark, sf, "customers", views.customer_changes)


@query
def scd2_current(spark, sf):
    return scd2.scd2_current(history(spark, sf)).select("_pk", "_lsn", "membership_tier", "status", "mrr")


@query
def scd2_as_of(spark, sf):
    at = F.expr("TIMESTAMP '1999-06-30 00:00:00'")
    return scd2.scd2_as_of(history(spark, sf), at).select("_pk", "_lsn", "status", "valid_from", "valid_to")


@query
def scd2_point_in_time_join(spark, sf):
    facts = purchases(spark, sf, "event_id", "player_id", "occurred_at").withColumn(
        "subscription_id", F.concat(F.lit("S"), "player_id")
    )
    stored = materialise(facts, "facts")
    return scd2.point_in_time_join(
        stored, materialise(history(spark, sf), "history"), "subscription_id", "occurred_at", ["_lsn", "membership_tier", "status"]
    ).drop("player_id")


@query
def gold_membership_mrr(spark, sf):
    return gold.membership_mrr(history(spark, sf))


@query
def gold_membership_movements(spark, sf):
    return gold.membership_movements(history(spark, sf), log=flat_changes(spark, sf))


@named("append_dedup")
def append_dedup_by_cursor(spark, sf):
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    cutoff = F.expr("TIMESTAMP_NTZ '1998-12-31 00:00:00'")
    target = orders.filter(F.col("o_orderdate") <= cutoff)
    return append_dedup(target, orders, "o_custkey", "o_orderdate", since=cutoff)


# ---- incremental, evolution, files -----------------------------------------------------------


@query
def change_feed(spark, sf):
    columns = ["subscription_id", "membership_tier", "status", "mrr"]
    versions = history(spark, sf)
    old = scd2.scd2_as_of(versions, F.expr("TIMESTAMP '1998-06-30 00:00:00'")).select(*columns)
    new = scd2.scd2_as_of(versions, F.expr("TIMESTAMP '1998-12-31 00:00:00'")).select(*columns)
    return changes.change_feed(old, new, ["subscription_id"])


@query
def incremental_high_water(spark, sf):
    """Two runs over a growing source: what was there at the end of 1998, then everything."""
    root = shared_dir(spark, "increment")
    orders = read(spark, sf, "orders").withColumn("version", F.unix_date(F.to_date("o_orderdate")).cast("long"))
    positions = changes.Positions(spark, f"{root}/positions")
    for run, source in enumerate((orders.filter(F.year("o_orderdate") <= 1998), orders), start=1):

        def write(fresh, upto, run=run):
            fresh.write.mode("overwrite").parquet(f"{root}/target/run={run}")

        changes.process_increment(positions, "orders", source, "version", write)
    return spark.read.parquet(f"{root}/target").select("o_orderkey", "version", "run")


@query
def schema_evolution_union(spark, sf):
    """Older files lack the discount and pre-owned columns of the newer generation."""
    old = purchases(spark, sf, "event_id", "occurred_at", "quantity").filter(F.year("occurred_at") < 1998)
    new = purchases(spark, sf, "event_id", "occurred_at", "quantity", "discount_pct", "is_preowned").filter(
        F.year("occurred_at") >= 1998
    )
    return changes.union_evolving(old, new)


@query
def rescued_data(spark, sf):
    schema = StructType.fromDDL(
        "Name string, Platform string, Year int, Genre string, Publisher string, Global_Sales double"
    )
    raw = views.raw_sales(spark, sf).select(*schema.names)
    return files.rescue(raw, schema)


@query
def ingest_csv_incremental(spark, sf):
    """Three generations of customer files: as the table is, in another column order with a column more, and
    with text among the nation keys. Each run takes in what is new."""
    root = shared_dir(spark, "landing")
    rows = read(spark, sf, "customer")
    nation = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("N"), "c_nationkey")).otherwise(F.col("c_nationkey").cast("string"))
    generations = {
        "2024-01-01": rows,
        "2024-01-02": rows.withColumn("c_code", F.substring("c_mktsegment", 1, 2)).select("c_code", *reversed(rows.columns)),
        "2024-01-03": rows.withColumn("c_nationkey", nation),
    }
    for n, (day, part) in enumerate(generations.items()):
        files.land(part.filter(F.col("c_custkey") % 3 == n), f"{root}/files", day)
        bronze = files.ingest_csv(
            spark, f"{root}/files/*", f"{root}/bronze", f"{root}/checkpoint", f"{root}/schemas", "customers", rows.schema
        )
    landed = F.regexp_extract("_source_file", "ingest_date=([0-9-]+)", 1)
    return bronze.select(*rows.columns, "c_code", files.RESCUED, "_dataset_key", landed.alias("landed"))


@query
def landing_checksum(spark, sf):
    return files.folder_digest(files.folder_manifest(spark, sf, "*.parquet"))


@query
def publish_mart(spark, sf):
    table = f"mart_{uuid.uuid4().hex[:12]}"
    mart = gold.console_lifecycle(silver_sales(spark, sf))
    layout.publish(mart, table, ["console_family"])
    return spark.table(table)


@query
def clustered_write(spark, sf):
    path = shared_dir(spark, "clustered")
    layout.clustered_write(silver_sales(spark, sf), path, ["era", "console_family", "platform_code"])
    return spark.read.parquet(path)


@query
def compact_table(spark, sf):
    root = shared_dir(spark, "compact")
    read(spark, sf, "orders").repartition(32).write.parquet(f"{root}/small")
    layout.compact(spark, f"{root}/small", f"{root}/compacted")
    return spark.read.parquet(f"{root}/compacted")


# ---- streaming -------------------------------------------------------------------------------


def splits(rows):
    """How many tasks read a stored table: so many files a batch, or one file's few tasks would do a batch's work."""
    return max(1, rows.rdd.getNumPartitions())


@contextmanager
def setting(spark, name, value):
    """A setting that streams started meanwhile keep."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def scattered(spark, sf, root, copies=1, batches=4):
    """The events as a stream of several batches of files in no order of time, copies in other files."""
    rows = read(spark, sf, "events").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    wide = splits(rows)
    rows.repartition(batches * wide, F.xxhash64("event_id", "_copy")).drop("_copy").write.parquet(f"{root}/source")
    return runs.parquet_stream(spark, f"{root}/source", max_files=wide)


@query
def stream_events_bronze(spark, sf):
    root = shared_dir(spark, "bronze")
    raw = views.purchase_messages(scattered(spark, sf, root, copies=2)).drop("src_id")
    good = stream_events.good_events(stream_events.parse_messages(raw)).withColumn("event_date", F.to_date("occurred_at"))
    once = backfill.first_arrivals(good)
    runs.finish(runs.each_batch(once, runs.folder_per_batch(f"{root}/table"), f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table").select(
        "event_id", "player_id", "platform", "channel_code", "occurred_at", "quantity", "unit_price",
        "discount_pct", "event_date",
    )


@query
def stream_dedup(spark, sf):
    root = shared_dir(spark, "dedup")
    twice = scattered(spark, sf, root, copies=2)
    once = backfill.first_arrivals(twice, at="ts")
    runs.finish(runs.each_batch(once, runs.folder_per_batch(f"{root}/table"), f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table").drop("batch_id")


@query
def stream_restart(spark, sf):
    """The stream stops after the first landing and resumes from its checkpoint after the second, which
    brings the first half again, in other files."""
    root = shared_dir(spark, "restart")
    rows = read(spark, sf, "events")
    sink, wide = runs.folder_per_batch(f"{root}/table"), splits(rows)
    for landing, part in enumerate((F.dayofmonth("ts") <= 15, F.lit(True))):
        rows.filter(part).repartition(3 * wide, "event_id").write.parquet(f"{root}/landing/part={landing}")
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", wide).parquet(f"{root}/landing/*")
        once = backfill.first_arrivals(source, at="ts")
        runs.finish(runs.each_batch(once, sink, f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table").drop("batch_id")


@query
def rt_revenue(spark, sf):
    root = shared_dir(spark, "revenue")
    good, _ = stream_events.parse_with_dlq(views.purchase_messages(scattered(spark, sf, root)))
    sink = backfill.WindowTotals(spark, f"{root}/parts")
    runs.finish(runs.each_batch(good, sink, f"{root}/checkpoint"))
    return sink.totals()


@query
def rt_revenue_panes(spark, sf):
    root = shared_dir(spark, "panes")
    good, _ = stream_events.parse_with_dlq(views.purchase_messages(scattered(spark, sf, root)))
    sink = windows.PaneSink(spark, f"{root}/panes", lateness=None)
    runs.finish(runs.each_batch(good, sink, f"{root}/checkpoint"))
    return windows.panes_total(sink.panes())


@query
def stream_early_panes(spark, sf):
    """Panes fired by processing time from keyed state. The stream stops after its first landing with panes still
    unfired and resumes from its checkpoint after the second: the panes add up to the windows, none comes twice."""
    root = shared_dir(spark, "early")
    rows = read(spark, sf, "events")
    sink, wide = runs.folder_per_batch(f"{root}/panes"), splits(rows)
    # Keys are few: a state partition costs a Python worker in every batch, however empty it is.
    shuffles = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    for landing, part in enumerate((F.dayofmonth("ts") <= 15, F.dayofmonth("ts") > 15)):
        rows.filter(part).repartition(3 * wide, "event_id").write.parquet(f"{root}/landing/part={landing}")
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", wide).parquet(f"{root}/landing/*")
        good, _ = stream_events.parse_with_dlq(views.purchase_messages(source))
        panes = early_panes.early_panes(good, delay_ms=1000)
        if landing == 0:
            # Without batches for timers alone, the run ends with its input and leaves the last panes in state.
            quiet = setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")
            with quiet, setting(spark, "spark.sql.shuffle.partitions", str(shuffles)):
                runs.finish(runs.each_batch(panes, sink, f"{root}/checkpoint"))
        else:
            early_panes.finish_when_drained(runs.each_batch(panes, sink, f"{root}/checkpoint", interval="2 seconds"))
    fired = spark.read.parquet(f"{root}/panes")
    return fired.groupBy(*windows.CELL).agg(F.sum("pane").cast("double").alias("net_revenue"), F.sum("events").alias("events"))


def two_landings(spark, sf):
    """Every tenth event arrives in a second landing; panes so far, and the tagged messages."""
    root = shared_dir(spark, "late")
    rows, sink = read(spark, sf, "events"), windows.PaneSink(spark, f"{root}/panes")
    for landing, part in enumerate((F.col("event_id") % 10 != 9, F.col("event_id") % 10 == 9)):
        rows.filter(part).write.parquet(f"{root}/landing/part={landing}")
        source = spark.readStream.schema(rows.schema).parquet(f"{root}/landing/*")
        good, _ = stream_events.parse_with_dlq(views.purchase_messages(source))
        runs.finish(runs.each_batch(good, sink, f"{root}/checkpoint"))
    return sink, stream_events.tag_messages(views.purchase_messages(rows))


@query
def stream_late_rows(spark, sf):
    """Nothing is lost: events counted in their windows, events whose windows had closed, dead letters."""
    sink, tagged = two_landings(spark, sf)
    late = sink.late().agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n")).select(F.lit("late").alias("outcome"), "n")
    kept = sink.panes().agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n")).select(F.lit("kept").alias("outcome"), "n")
    dead = stream_events.dead_letters(tagged).agg(F.count("*").alias("n")).select(F.lit("dead").alias("outcome"), "n")
    return kept.unionByName(late).unionByName(dead)


@query
def late_data(spark, sf):
    """A second landing still counts in windows that closed less than the allowed lateness before the newest
    event of the first, and goes to the late panes otherwise."""
    sink, _ = two_landings(spark, sf)
    return windows.panes_total(sink.panes())


@query
def parse_with_dlq(spark, sf):
    """Both outputs of the split, written per batch from one evaluation and read back."""
    root = shared_dir(spark, "dlq")
    tagged = stream_events.tag_messages(views.purchase_messages(event_stream(spark, sf)).drop("src_id"))
    runs.finish(runs.each_batch(tagged, runs.split_outputs(f"{root}/ok", f"{root}/dead"), f"{root}/checkpoint"))
    ok = spark.read.parquet(f"{root}/ok").select("event_id", "net_revenue", F.lit(None).cast("string").alias("error"))
    dead = spark.read.schema("raw string, error string").json(f"{root}/dead").select(
        F.lit(None).cast("string").alias("event_id"), F.lit(None).cast("double").alias("net_revenue"), "error"
    )
    return ok.unionByName(dead)


@query
def json_props_extract(spark, sf):
    props = F.from_json("props", "k int")
    return read(spark, sf, "events").select("event_id", props["k"].alias("k"))


@query
def stream_lag_report(spark, sf):
    seen = F.expr("TIMESTAMP '2024-01-31 00:00:00'")
    ev = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return monitor.lag_report(ev, "event_type", "ts", seen, "qa")


# ---- features and models ---------------------------------------------------------------------


@query
def feat_player(spark, sf):
    return features.player_features(player_360(spark, sf))


@query
def feat_interactions(spark, sf):
    return features.interaction_features(silver_events(spark, sf))


@query
def feat_sales_ts(spark, sf):
    return features.sales_timeseries(silver_events(spark, sf))


@query
def sequence_windows(spark, sf):
    cut = features.sequence_windows(features.sales_timeseries(silver_events(spark, sf)))

    def at(c, i):
        return F.element_at(c, i).cast("double")

    total = F.aggregate("x_revenue", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return cut.select(
        "platform_code", "channel_type", "last_ds",
        F.size("x_dow").alias("steps"), F.size("y").alias("targets"),
        at("x_revenue", 1).alias("x_first"), at("x_revenue", -1).alias("x_last"),
        at("y", 1).alias("y_first"), at("y", -1).alias("y_last"),
        F.round(total, 2).alias("x_total"),
    )


@query
def chronological_split(spark, sf):
    return series_split(spark, sf).select("platform_code", "channel_type", "ds", "revenue", "split")


@query
def recsys_training_set(spark, sf):
    reduced = features.interactions_by_type(silver_events(spark, sf)).withColumnRenamed("last_seen", "occurred_at")
    stored = materialise(reduced.select("player_id", "product_id", "product_type", "confidence", "occurred_at"), "pairs")
    return recommend.training_set(stored.filter("product_type = 'GAME'"), gold.churn_labels(stored, F.expr(AS_OF)))


@query
def churn_score_bands(spark, sf):
    scored = churn.score_churn(features.player_features(player_360(spark, sf)), WEIGHTS)
    return scored.select("player_id", "churn_probability", "risk_band")


@query
def lookup_player_churn(spark, sf):
    scored = churn.score_churn(features.player_features(player_360(spark, sf)), WEIGHTS)
    return lookups.lookup_player_churn(published(spark, scored, "gold_player_churn_scores"), "1")


@query
def lookup_pruned(spark, sf):
    """Lookups on either key of the published scores, cut into about 1024 row groups: rows found, and whether the scan
    handed on at most a tenth of the table."""
    scored = materialise(churn.score_churn(features.player_features(player_360(spark, sf)), WEIGHTS), "scored")
    players, top = scored.agg(F.count("*"), F.expr("percentile_disc(0.98) WITHIN GROUP (ORDER BY churn_probability)")).first()
    scores = published(spark, scored, "gold_player_churn_scores", max(1, players // 1024))
    looked_up = {"player": lookups.lookup_player_churn(scores, "1"), "at_risk": lookups.lookup_players_at_risk(scores, top)}
    read_rows = {name: skipping.rows_scanned(df) for name, df in looked_up.items()}
    outcome = [(name, len(rows), scanned <= players / 10) for name, (rows, scanned) in read_rows.items()]
    return spark.createDataFrame(outcome, "lookup string, found bigint, at_most_a_tenth_read boolean")


@query
def churn_model(spark, sf):
    """Trained on older players, applied to all: every player has a chance between 0 and 1, whatever is missing."""
    rows = materialise(features.player_features(player_360(spark, sf)), "players")
    training, _ = churn.holdout(rows)
    scored = churn.apply_churn(churn.fit_churn(training), rows)
    return scored.select("player_id", F.col("churn_probability").between(0, 1).alias("scored"))


@query
def churn_auc(spark, sf):
    """Area under the curve of the stored scores against the churn label, over all players."""
    scored = materialise(churn.score_churn(features.player_features(player_360(spark, sf)), WEIGHTS), "scored")
    return metrics.auc(scored, "churn_probability", "is_churned")


@query
def churn_holdout_auc(spark, sf):
    """The fitted model on the players held out by time, whom it has not seen."""
    training, held = churn.holdout(materialise(features.player_features(player_360(spark, sf)), "players"))
    scored = materialise(churn.apply_churn(churn.fit_churn(training), held), "scored")
    return metrics.auc(scored, "churn_probability", "is_churned")


def unlabelled_training(pairs):
    """Training set of all players, stored; what it was made from goes."""
    labels = pairs.select("player_id", F.lit(0).alias("is_churned")).distinct()
    made = recommend.training_set(pairs, labels)
    training = materialise(made, "training")
    discard(made)
    return training


@query
def recommend_als(spark, sf):
    """Ten titles per player out of all that the player does not have; how many each got."""
    pairs = materialise(features.interactions(silver_events(spark, sf)).select("player_id", "product_id", "confidence"), "pairs")
    training = unlabelled_training(pairs)
    discard(pairs)
    top = recommend.best_items(training, recommend.fit_recommender(training), 10)
    return top.groupBy("player_id").agg(
        F.count("*").alias("items"), F.max("rank").cast("long").alias("last_rank"), F.countDistinct("product_id").alias("titles")
    )


@query
def recall_at_k(spark, sf):
    ranked = features.interaction_features(silver_events(spark, sf))
    relevant = ranked.filter("_rank_desc = 1").select("player_id", "product_id")
    seen = ranked.filter("_rank_desc > 1")
    return metrics.recall_at_k(recommend.popular_items(seen, "purchases", 10), relevant, ["product_id"])


@query
def promotion_gate(spark, sf):
    ranked = features.interaction_features(silver_events(spark, sf))
    relevant = ranked.filter("_rank_desc = 1").select("player_id", "product_id")
    seen = ranked.filter("_rank_desc > 1")

    def result(by):
        return metrics.recall_at_k(recommend.popular_items(seen, by, 10), relevant, ["product_id"])

    return metrics.promotion_gate(result("purchases"), result("spend"), "recall")


def model_recall(ranked):
    """Recall of the model's ten titles per player for the newest title, which the model has not seen.

    A player without other titles is unknown to the model and counts as missed.
    """
    relevant = ranked.filter("_rank_desc = 1").select("player_id", "product_id")
    training = unlabelled_training(ranked.filter("_rank_desc > 1"))
    top = recommend.best_items(training, recommend.fit_recommender(training), 10)
    return metrics.recall_at_k(top, relevant, ["player_id", "product_id"])


def ranked_pairs(spark, sf):
    """Interactions with their recency rank, in the columns that the model and its measure need."""
    needed = features.interactions(silver_events(spark, sf)).select("player_id", "product_id", "last_seen", "confidence", "purchases")
    pairs = materialise(needed, "interactions")
    ranked = materialise(features.ranked_interactions(pairs).drop("last_seen"), "ranked")
    discard(pairs)
    return ranked


@query
def recommend_recall(spark, sf):
    return model_recall(ranked_pairs(spark, sf))


@query
def recommend_gate(spark, sf):
    """The model against the ten most bought titles, which is the report it has to beat."""
    ranked = ranked_pairs(spark, sf)
    relevant = ranked.filter("_rank_desc = 1").select("player_id", "product_id")
    popular = recommend.popular_items(ranked.filter("_rank_desc > 1"), "purchases", 10)
    return metrics.promotion_gate(metrics.recall_at_k(popular, relevant, ["product_id"]), model_recall(ranked), "recall")


@query
def forecast_baseline(spark, sf):
    return forecast.seasonal_baseline(series_split(spark, sf))


@query
def forecast_errors(spark, sf):
    return metrics.forecast_errors(
        forecast.seasonal_baseline(series_split(spark, sf)), "revenue", "forecast", features.SERIES
    )


@query
def forecast_model(spark, sf):
    """A forecast for every validation day, from what is known a horizon ahead."""
    split = materialise(series_split(spark, sf), "split")
    made = forecast.apply_forecast(forecast.fit_forecast(split), split)
    return made.select("platform_code", "channel_type", "ds", "revenue", (F.col("forecast").isNotNull() & ~F.isnan("forecast")).alias("made"))


# ---- catalog and vectors ---------------------------------------------------------------------


def todo(spark, sf):
    sales = silver_sales(spark, sf)
    return catalog.enrichment_todo(sales, sales.filter("generation <= 7"))


def stub_completions(prompts: list[str], instruction: str) -> list[str]:
    """Stands in for a model client: an answer depends on the title's length only."""
    return [stub_completion(json.loads(p)["title"]) for p in prompts]


def stub_completion(prompt: str) -> str:
    appeal = ["LOW", "MEDIUM", "HIGH", "NONE"][len(prompt) % 4]
    text = json.dumps({"sub_genre": f"g{len(prompt) % 5}", "retro_appeal": appeal, "themes": ["a"]})
    return text if len(prompt) % 7 else text[:10]


def stub_vectors(texts: list[str]) -> np.ndarray:
    return np.array([[t.count(letter) for letter in "aeiou "] for t in texts], dtype="float32")


@query
def enrichment_todo(spark, sf):
    return todo(spark, sf)


@query
def catalog_enrich(spark, sf):
    """Two runs into stored tables: all titles, then again those that were rejected."""
    root = shared_dir(spark, "catalog")
    sales = materialise(todo(spark, sf), "catalog-source")
    catalog.enrich_into(spark, sales, stub_completions, root, "a", pause=0.0)
    catalog.enrich_into(spark, sales, stub_completions, root, "b", pause=0.0)
    none = F.lit(None).cast("string")
    good = catalog.stored_enrichment(spark, root).select(*catalog.PROMPT_FIELDS, none.alias("reject_reason"), "sub_genre", "retro_appeal")
    bad = spark.read.parquet(f"{root}/rejected/run=b")
    return good.unionByName(
        bad.select(*catalog.PROMPT_FIELDS, "reject_reason", none.alias("sub_genre"), none.alias("retro_appeal"))
    )


@query
def llm_json_validate(spark, sf):
    part = read(spark, sf, "part")
    appeal = views.pick(["LOW", "MEDIUM", "HIGH", "UNKNOWN"], F.col("p_size") % 4)
    text = F.to_json(F.struct(F.col("p_type").alias("sub_genre"), appeal.alias("retro_appeal")))
    raw = F.when(F.col("p_size") % 10 == 0, F.substring(text, 1, 12)).when(F.col("p_size") % 10 != 1, text)
    checked = catalog.validate_completions(part.select("p_partkey", raw.alias("raw")))
    return checked.select(
        "p_partkey", "reject_reason", F.col("enrichment.sub_genre").alias("sub_genre"),
        F.col("enrichment.retro_appeal").alias("retro_appeal"),
    )


def part_catalog(spark, sf):
    part = read(spark, sf, "part")
    return part.select(
        "p_partkey",
        F.col("p_name").alias("title"),
        views.pick(views.PLATFORM_CODES, F.col("p_size") % 12).alias("platform_code"),
        F.col("p_type").alias("genre"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("sub_genre"),
    )


@query
def catalog_document_text(spark, sf):
    text = catalog.document_text("title", "platform_code", "genre", "sub_genre")
    return part_catalog(spark, sf).select("p_partkey", text.alias("document"))


@query
def catalog_embed(spark, sf):
    vectors = materialise(catalog.embed(catalog.catalog_documents(part_catalog(spark, sf)), stub_vectors), "catalog-vectors")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return vectors.select("title", "platform_code", F.size("embedding").alias("dims"), total.alias("total"))


@query
def catalog_term_vectors(spark, sf):
    """The default embedder: dimensions, length of the vector, number of terms."""
    documents = materialise(catalog.catalog_documents(part_catalog(spark, sf)), "catalog-documents")
    vectors = materialise(catalog.term_vectors(documents), "catalog-terms")
    squares = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    return vectors.select(
        "title", "platform_code", F.size("embedding").alias("dims"), F.round(F.sqrt(squares), 4).alias("norm"), "n_terms"
    )


def label_centroids(spark, sf):
    return similarity.centroids(read(spark, sf, "embeddings"), "label", "embedding")


@query
def embedding_topk(spark, sf):
    return similarity.cosine_topk(read(spark, sf, "embeddings"), label_centroids(spark, sf), 10, "vec_id")


def lsh_search(rows, asked, tables=6):
    """Exact squared distances of all pairs with the approximate ``distance`` where found, and the reach.

    The reach is the distance below which one pair in twenty lies, so it tells rows apart on any data.
    """
    exact = materialise(similarity.squared_distances(rows, asked, "vec_id"), "distances")
    reach = float(np.sqrt((exact.approxQuantile("squared", [LSH_NEAR], 0.001) or [0.0])[0]))
    found = similarity.lsh_matches(rows, asked, reach, "vec_id", bucket_length=1.0, tables=tables)
    return exact.join(materialise(found, "lsh"), ["query_id", "vec_id"], "left"), reach


def lsh_recall(both, reach):
    """Per query: how many rows lie within the reach, and which share of them was found."""
    near = F.col("squared") < reach**2
    return both.groupBy("query_id").agg(
        F.count_if(near).alias("near"), F.coalesce(ratio(F.count_if(near & F.col("distance").isNotNull()), F.count_if(near)), F.lit(1.0)).alias("recall")
    )


@query
def embedding_lsh(spark, sf):
    """Per query, the approximate matches against the exact distances: right, and nine in ten of those within the reach."""
    both, reach = lsh_search(read(spark, sf, "embeddings"), label_centroids(spark, sf))
    right = both.groupBy("query_id").agg(
        F.coalesce(F.bool_and(F.when(F.col("distance").isNotNull(), F.abs(F.col("distance") - F.sqrt("squared")) < 1e-4)), F.lit(True)).alias("exact")
    )
    return right.join(lsh_recall(both, reach), "query_id").select(
        F.col("query_id").cast("long").alias("query_id"), "exact", (F.col("recall") >= LSH_RECALL).alias("half_found")
    )


@query
def embedding_lsh_matches(spark, sf):
    """The matches themselves, each with its query's recall."""
    both, reach = lsh_search(read(spark, sf, "embeddings"), label_centroids(spark, sf))
    matches = both.filter("distance IS NOT NULL").select("query_id", "vec_id", "distance")
    return matches.join(lsh_recall(both, reach).select("query_id", "recall"), "query_id")


def cell_search(spark, sf):
    """Every fiftieth row asks for its ten nearest among all rows; as many cells as find nine in ten of them."""
    rows = read(spark, sf, "embeddings")
    index = cells.build(rows, shared_dir(spark, "cells"), "vec_id")
    asked = materialise(rows.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), "asked")
    exact = materialise(similarity.cosine_topk(rows, asked, 10, "vec_id"), "exact")
    return index, *cells.tune_probes(spark, index, asked, exact, 10, LSH_RECALL)


@query
def embedding_cells(spark, sf):
    """Per query of the inverted lists: how many matches, the nearest one, and whether recall over all queries is 0.9."""
    _, _, share, found = cell_search(spark, sf)
    best = F.max(F.when(F.col("rank") == 1, F.struct("vec_id", "similarity")))
    return found.groupBy("query_id").agg(F.count("*").alias("matches"), best.alias("b")).select(
        "query_id", "matches", F.col("b.vec_id").alias("nearest_id"), F.col("b.similarity").alias("similarity"),
        F.lit(share >= LSH_RECALL).alias("recall_reached"),
    )


@query
def embedding_cells_matches(spark, sf):
    """The matches, with the number of cells visited and the recall measured over all queries."""
    index, probes, share, found = cell_search(spark, sf)
    return found.select("*", F.lit(probes).alias("probes"), F.lit(len(index.centres)).alias("cells"), F.lit(share).alias("recall"))

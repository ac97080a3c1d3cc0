import hashlib
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinslot.operators import changes, layout
from coinslot.operators.dedup import append_dedup, best_row
from coinslot.sources import files


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_incremental_ingest_takes_each_file_once(spark, folder):
    schema = StructType.fromDDL("id int, price double")
    write(f"{folder}/in/a.csv", "id,price\n1,1.5\n2,oops\n")

    def run():
        return files.ingest_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/cp", schema, "prices")

    rows = run().orderBy("id").collect()
    assert [(r.id, r.price, r._rescued_data) for r in rows] == [(1, 1.5, None), (2, None, '{"price":"oops"}')]
    assert rows[0]._source_file.endswith("a.csv") and rows[0]._dataset_key == "prices" and rows[0]._ingested_at
    assert run().count() == 2
    write(f"{folder}/in/b.csv", "id,price\n3,2\n")
    assert run().count() == 3


def test_schema_tracking_adds_and_widens(spark, folder):
    write(f"{folder}/one/a.csv", "id,n\n1,2\n")
    write(f"{folder}/two/b.csv", "id,n,extra\n1,2.5,x\n")
    first = files.track_schema(spark, f"{folder}/one", f"{folder}/schema")
    assert first.simpleString() == "struct<id:int,n:int>"
    second = files.track_schema(spark, f"{folder}/two", f"{folder}/schema")
    assert second.simpleString() == "struct<id:int,n:double,extra:string>"
    assert files.load_schema(spark, f"{folder}/schema") == second
    assert files.track_schema(spark, f"{folder}/one", f"{folder}/schema") == second


def test_union_evolving_fills_missing_columns(spark):
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string")
    assert sorted(changes.union_evolving(old, new).collect()) == [(1, None), (2, "x")]


def test_checksum_sees_content_and_names_but_not_order(spark, folder):
    write(f"{folder}/x/a.bin", "hello")
    write(f"{folder}/x/sub/b.bin", "world" * 1000)
    manifest = files.folder_manifest(spark, f"{folder}/x")
    digests = {r.file_name: r.sha256 for r in manifest.collect()}
    assert digests["a.bin"] == hashlib.sha256(hashlib.sha256(b"hello").hexdigest().encode()).hexdigest()
    digest = files.folder_digest(manifest).first()
    assert (digest.files, digest.bytes) == (2, 5005)
    manifest.write.parquet(f"{folder}/manifest")
    stored = spark.read.parquet(f"{folder}/manifest")
    assert files.folder_digest(files.folder_manifest(spark, f"{folder}/x").repartition(3)).first() == digest
    assert files.changed_files(files.folder_manifest(spark, f"{folder}/x"), stored).isEmpty()
    write(f"{folder}/x/a.bin", "hellO")
    changed = files.changed_files(files.folder_manifest(spark, f"{folder}/x"), stored)
    assert [r.file_name for r in changed.collect()] == ["a.bin"]
    assert files.folder_digest(files.folder_manifest(spark, f"{folder}/x")).first().checksum != digest.checksum


def test_change_feed_is_null_safe(spark):
    schema = "k int, a string, b int"
    old = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 1), (5, None, None)], schema)
    new = spark.createDataFrame([(1, "x", None), (2, "y", None), (4, None, None), (5, None, None)], schema)
    feed = changes.change_feed(old, new, ["k"])
    assert sorted(map(tuple, feed.collect()), key=str) == sorted(
        [("update_preimage", 2, "y", 1), ("update_postimage", 2, "y", None), ("delete", 3, "z", 1), ("insert", 4, None, None)],
        key=str,
    )
    assert sorted(r.k for r in changes.effective_changes(feed).collect()) == [2, 4]


def test_position_moves_only_after_success(spark, folder):
    df = spark.range(10).withColumn("v", F.col("id"))
    positions = changes.Positions(spark, f"{folder}/pos")
    got = []

    def broken(fresh, upto):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        changes.process_increment(positions, "t", df, "v", broken)
    assert positions.last("t") is None
    keep = lambda fresh, upto: got.append((fresh.count(), upto))
    assert changes.process_increment(positions, "t", df, "v", keep) == 9
    assert changes.process_increment(positions, "t", df, "v", keep) == 9
    more = spark.range(12).withColumn("v", F.col("id"))
    assert changes.process_increment(positions, "t", more, "v", keep) == 11
    assert got == [(10, 9), (2, 11)]


def test_append_dedup(spark):
    schema = "id int, updated_at int, v string"
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "keep")], schema)
    incoming = spark.createDataFrame([(1, 7, "new"), (2, 3, "late"), (3, 6, "first"), (2, 5, "fixed")], schema)
    assert sorted(append_dedup(target, incoming, "id", "updated_at").collect()) == [
        (1, 7, "new"), (2, 5, "fixed"), (3, 6, "first"),
    ]
    assert sorted(append_dedup(target, incoming, "id", "updated_at", since=6).collect()) == [(1, 7, "new"), (2, 5, "keep")]


def test_best_row_puts_null_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2.0, 2), ("b", None, 3)], "k string, s double, i int")
    assert sorted(best_row(df, ["k"], "s", "i").collect()) == [("a", 2.0, 2), ("b", None, 3)]


def test_compaction_and_cluster_keep_rows(spark, folder):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50))
    df.repartition(20).write.parquet(f"{folder}/small")
    assert layout.compact(spark, f"{folder}/small", f"{folder}/big") == 1
    assert len([f for f in os.listdir(f"{folder}/big") if f.endswith(".parquet")]) == 1
    layout.clustered_write(df, f"{folder}/clustered", ["k"], files=6)
    back = spark.read.parquet(f"{folder}/clustered")
    assert sorted(back.collect()) == sorted(spark.read.parquet(f"{folder}/big").collect()) == sorted(df.collect())
    sizes = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes < 334


def test_publish_swaps_and_survives_a_schema_change(spark):
    one = spark.range(3)
    layout.publish(one, "pub_mart")
    layout.publish(spark.range(5), "pub_mart", ["id"])
    assert spark.table("pub_mart").count() == 5
    layout.publish(spark.range(2).withColumn("b", F.lit("x")), "pub_mart")
    assert spark.table("pub_mart").columns == ["id", "b"]
    with pytest.raises(ValueError, match="empty"):
        layout.publish(spark.range(0), "pub_mart")
    assert spark.table("pub_mart").count() == 2


def test_publish_existing_skips_missing_marts(spark, folder):
    layout.publish(spark.range(4), "pub_there")
    sent = []
    missing = layout.publish_existing(
        spark, ["pub_there", "pub_gone"],
        lambda name, df: (sent.append(name), layout.publish_external(df, "json", path=f"{folder}/{name}")),
    )
    assert (sent, missing) == (["pub_there"], ["pub_gone"])
    assert spark.read.json(f"{folder}/pub_there").count() == 4


def test_maintenance_isolates_failures(spark):
    layout.publish(spark.range(100).repartition(10), "maintained")
    outcome = layout.maintain(spark, ["no_such_table", "maintained"])
    assert outcome["maintained"] == "ok" and outcome["no_such_table"].startswith("failed")
    assert spark.table("maintained").count() == 100


def test_append_is_strict_unless_told(spark, folder):
    path = f"{folder}/t"
    layout.append(spark.createDataFrame([(1,)], "a int"), path)
    layout.append(spark.createDataFrame([(2,)], "a int"), path)
    wider = spark.createDataFrame([(3, "x")], "a int, b string")
    with pytest.raises(ValueError, match="schema mismatch"):
        layout.append(wider, path)
    with pytest.raises(ValueError, match="schema mismatch"):
        layout.append(spark.createDataFrame([("x",)], "a string"), path, evolve=True)
    layout.append(wider, path, evolve=True)
    assert sorted(map(tuple, layout.read_evolved(spark, path).collect())) == [(1, None), (2, None), (3, "x")]


def test_missing_broker_connector_is_reported(spark):
    from coinslot.sources import brokers

    with pytest.raises(Exception, match="kafka"):
        brokers.kafka_messages(spark, "localhost:9092", "t", security_protocol="SASL_SSL")
    with pytest.raises(Exception, match="pubsub"):
        brokers.pubsub_messages(spark, "p", "s")


def test_csv_columns_are_bound_by_header(spark, folder):
    from pyspark.sql.types import StructType

    import os

    os.makedirs(f"{folder}/in")
    hints = StructType.fromDDL("id int, name string, city string")

    def take(name, text, **options):
        with open(f"{folder}/in/{name}", "w") as f:
            f.write(text)
        return files.ingest_csv(spark, f"{folder}/in", f"{folder}/out", f"{folder}/cp", f"{folder}/schemas", "people", hints, **options)

    take("a.csv", "id,name,city\n1,ann,rome\n")
    take("b.csv", "city,id,name,extra\noslo,2,bob,keepme\n")
    take("c.csv", "name,id\ncid,x3\n\"dee, d\",4\n")
    table = take("d.csv", "id,later\n5,more\n", new_columns=False)
    assert table.columns[:4] == ["id", "name", "city", "extra"]
    rows = {r.name: r for r in table.collect()}
    assert (rows["bob"].id, rows["bob"].city, rows["bob"].extra, rows["bob"]._rescued_data) == (2, "oslo", "keepme", None)
    assert (rows["ann"].id, rows["ann"].extra) == (1, None)
    assert (rows["cid"].id, rows["cid"]._rescued_data) == (None, '{"id":"x3"}')
    assert rows["dee, d"].id == 4 and rows["dee, d"].city is None
    assert (rows[None].id, rows[None]._rescued_data) == (5, '{"later":"more"}')
    assert table.count() == 5 and {r._dataset_key for r in table.collect()} == {"people"}


def test_manifest_hashes_in_blocks(spark, folder):
    import hashlib
    import os

    os.makedirs(f"{folder}/m")
    for name, data in (("a.bin", b"0123456789"), ("b.bin", b""), ("c.bin", b"01234567")):
        with open(f"{folder}/m/{name}", "wb") as f:
            f.write(data)
    got = {r.file_name: r.sha256 for r in files.folder_manifest(spark, f"{folder}/m", block_bytes=4).collect()}

    def digest(data):
        parts = [hashlib.sha256(data[i : i + 4]).hexdigest() for i in range(0, len(data), 4)]
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    assert got == {"a.bin": digest(b"0123456789"), "c.bin": digest(b"01234567")}

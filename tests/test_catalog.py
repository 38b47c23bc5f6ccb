"""Catalog helpers (S8-S12, S15), message-log options (S6, S7) and the audit frame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fiscalflow.operators.audit import StageAudit, table_counts
from fiscalflow.plans import catalog
from fiscalflow.sources.messages import FileLog, KafkaLog, normalize_kafka


def test_save_table_overwrites_itself(spark):
    db = "cat_" + uuid.uuid4().hex[:6]
    catalog.ensure_database(spark, db)
    catalog.save_table(spark.range(5).withColumn("v", F.col("id") * 2), "t", db)
    src = catalog.read_table(spark, "t", db)
    catalog.save_table(src.withColumn("v", F.col("v") + 1), "t", db)        # reads its own target
    assert sorted(r.v for r in catalog.read_table(spark, "t", db).collect()) == [1, 3, 5, 7, 9]
    catalog.save_table(spark.range(2).withColumn("v", F.lit(0)), "t", db)   # plain overwrite
    assert catalog.read_table(spark, "t", db).count() == 2


def test_ctas_if_not_exists_and_drop(spark):
    db = "cat_" + uuid.uuid4().hex[:6]
    catalog.ensure_database(spark, db)
    catalog.create_table_as_select(spark, "c", "SELECT 1 AS x", db)
    catalog.create_table_as_select(spark, "c", "SELECT 2 AS x", db)          # exists: unchanged
    assert [r.x for r in catalog.read_table(spark, "c", db).collect()] == [1]
    catalog.drop_table(spark, "c", db)
    catalog.drop_table(spark, "c", db)                                        # if exists
    assert not spark.catalog.tableExists(f"{db}.c")


def test_databases_keep_their_own_tables(spark, tmp_path):
    """Locations, drops, CTAS after a drop, and frames that read the table's folder by path."""
    a, b = ("cat_" + uuid.uuid4().hex[:6] for _ in range(2))
    spark.sql(f"CREATE DATABASE `{a}` LOCATION '{tmp_path}/elsewhere'")
    catalog.ensure_database(spark, b)
    before = spark.catalog.currentDatabase()
    catalog.save_table(spark.range(3), "t", a)
    catalog.save_table(spark.range(7), "t", b)
    assert catalog.read_table(spark, "t", a).count() == 3
    assert (tmp_path / "elsewhere" / "t").is_dir()
    by_path = spark.read.parquet(str(tmp_path / "elsewhere" / "t"))
    catalog.save_table(by_path.selectExpr("id + 10 AS id"), "t", a)
    assert sorted(r.id for r in catalog.read_table(spark, "t", a).collect()) == [10, 11, 12]
    catalog.drop_table(spark, "t", a)
    assert not (tmp_path / "elsewhere" / "t").exists()
    catalog.create_table_as_select(spark, "t", "SELECT 5 AS id", a)
    assert [r.id for r in catalog.read_table(spark, "t", a).collect()] == [5]
    assert spark.catalog.currentDatabase() == before
    try:
        spark.catalog.setCurrentDatabase(b)
        catalog.save_table(spark.range(2), "t")                              # the current database
        assert catalog.read_table(spark, "t", b).count() == 2
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_counts_union(spark):
    db = "cat_" + uuid.uuid4().hex[:6]
    catalog.ensure_database(spark, db)
    catalog.save_table(spark.range(3), "a", db)
    catalog.save_table(spark.range(7), "b", db)
    got = {r.table_name: r.row_count for r in catalog.counts(spark, ["a", "b"], db).collect()}
    assert got == {"a": 3, "b": 7}
    frames = {"x": spark.range(4), "y": spark.range(0)}
    assert {r.table_name: r.row_count for r in table_counts(frames).collect()} == {"x": 4, "y": 0}


def test_kafka_options_and_normalization(spark):
    log = KafkaLog("k1:9092,k2:9092", "nfe-json")
    assert log.writer_options() == {"kafka.bootstrap.servers": "k1:9092,k2:9092", "topic": "nfe-json"}
    assert log.reader_options() == {"kafka.bootstrap.servers": "k1:9092,k2:9092", "subscribe": "nfe-json",
                                    "startingOffsets": "earliest", "endingOffsets": "latest"}
    raw = spark.createDataFrame([(bytearray(b"k"), bytearray('{"a":"é"}'.encode()), "nfe-json", 0, 5)],
                                "key binary, value binary, topic string, partition int, offset long")
    raw = raw.withColumn("timestamp", F.current_timestamp())
    row = normalize_kafka(raw).first()
    assert (row.key, row.value, row.offset) == ("k", '{"a":"é"}', 5)


def test_file_log_batches_and_replace(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=4)
    m = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    log.write(m, batch=1)
    log.write(m, batch=2)
    log.write(m, batch=2, replace_batch=True)                 # a retried batch replaces itself
    rows = log.read(spark).collect()
    assert sorted((r.batch, r.key) for r in rows) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    assert {r.topic for r in rows} == {"nfe-json"} and all(0 <= r.partition < 4 for r in rows)


def test_stage_audit(spark):
    audit = StageAudit()
    df = audit.observed(spark.range(10), "s1", F.sum("id").alias("total"))
    df.write.format("noop").mode("overwrite").save()
    audit.record("files", 3)
    got = {(s, m): v for s, m, v in audit.rows()}
    assert got == {("files", "rows"): 3, ("s1", "rows"): 10, ("s1", "total"): 45}
    assert audit.to_frame(spark).count() == 3

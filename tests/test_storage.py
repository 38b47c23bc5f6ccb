from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fiscalflow import registry
from fiscalflow.operators import normalize
from fiscalflow.plans import pipeline
from fiscalflow.sources.messages import FileLog
from fiscalflow.streaming.reconcile import place_in_file

ROWS = [("a", "1", 1, 0, 0), ("a", "2", 2, 0, 0), ("b", "1", 1, 0, 1), (None, "x", 1, 0, 2), (None, "x", 2, 0, 1), (" ", "y", 1, 0, 3),
        ("c", "1", 1, 1, 0), ("c", "2", 1, 1, 1), ("c", "3", 1, 0, 9)]


def messages(spark, rows):
    df = spark.createDataFrame(rows, "key string, value string, batch bigint, partition int, offset bigint")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("batch")))


@pytest.mark.parametrize("few", [True, False])
def test_newest_messages_are_the_same_by_both_joins(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(normalize, "fits", lambda df: False)
    got = normalize.latest_messages(messages(spark, ROWS)).select("key", "value").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", "2"), ("b", "1"), (None, "x"), (None, "x"), (" ", "y"), ("c", "2")]))


def test_text_of_messages_is_not_shuffled_for_few_repeated_keys(spark):
    plan = normalize.latest_messages(messages(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_messages_and_staged_frames_are_stored_compactly(spark, scratch):
    log = FileLog(f"{scratch}/log")
    log.write(messages(spark, ROWS).select("key", "value"), batch=1)
    stored = [f for _, _, fs in os.walk(log.path) for f in fs if f.endswith(".parquet")]
    assert stored and all("zstd" in f for f in stored)
    staged, _ = pipeline.stage(messages(spark, ROWS), "t")
    assert all("zstd" in f for f in staged.inputFiles()) and staged.count() == len(ROWS)


def test_kept_results_are_columns(spark):
    out = registry._kept(messages(spark, ROWS))
    assert out.inputFiles() and all(f.endswith(".zstd.parquet") for f in out.inputFiles())
    assert sorted(map(str, out.collect())) == sorted(map(str, messages(spark, ROWS).collect()))


def test_places_in_files_are_short(spark, scratch):
    for name in ("a", "b"):
        spark.range(3).coalesce(1).write.parquet(f"{scratch}/{name}")
    place = spark.read.parquet(f"{scratch}/a", f"{scratch}/b").select(place_in_file().alias("p")).select("p.*")
    assert place.distinct().count() == 6 and {len(r[0]) for r in place.collect()} == {16}


def test_single_files_lie_in_one_folder(spark, monkeypatch):
    seen = []
    ingest = pipeline.run_ingest

    def watched(spark, xml_dir, *args, **kw):
        seen.extend((d, len([f for f in fs if f.endswith(".txt")])) for d, _, fs in os.walk(xml_dir))
        return ingest(spark, xml_dir, *args, **kw)

    monkeypatch.setattr(pipeline, "run_ingest", watched)
    out = registry.q_xml_single_files(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and seen[0][1] == out.count()
    assert out.where("customer is null").isEmpty() and out.where("outcome = 'malformed'").count() > 0


def test_invoices_of_a_repeated_customer_share_a_file(spark, scratch):
    given = "/root/testdata/sf0.001"
    for name in ("nation", "orders", "lineitem", "customer"):
        df = spark.read.parquet(f"{given}/{name}.parquet")
        (df.union(df) if name == "customer" else df).write.parquet(f"{scratch}/{name}.parquet")
    buyers = spark.read.parquet(f"{given}/orders.parquet").select("o_custkey").distinct().count()
    assert registry.q_xml_single_files(spark, scratch).count() == buyers + spark.read.parquet(f"{given}/nation.parquet").count()

"""The file log's offsets: gapless in each partition, kept by snapshots, pruned by the index."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from fiscalflow.sources.messages import FileLog, KafkaLog


def messages(spark, lo, hi, hot=0):
    """Keys lo..hi-1, and ``hot`` messages of one key."""
    df = spark.range(lo, hi, 1, 4).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("m"), "id").alias("value"))
    return df.union(spark.range(0, hot, 1, 3).select(F.lit("hot").alias("key"), F.concat(F.lit("h"), "id").alias("value")))


def offsets(df):
    out: dict[int, list[int]] = {}
    for r in df.collect():
        out.setdefault(r.partition, []).append(r.offset)
    return {p: sorted(x) for p, x in out.items()}


def test_gapless_in_each_partition(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=5)
    assert log.end_offsets(spark) == dict.fromkeys(range(5), 0)
    for b, (lo, hi, hot) in enumerate([(0, 100, 60), (100, 101, 0), (200, 300, 10)]):
        log.write(messages(spark, lo, hi, hot), batch=10 - b)      # ids in any order
    got = offsets(log.read(spark))
    ends = log.end_offsets(spark)
    assert got == {p: list(range(n)) for p, n in ends.items() if n} and sum(ends.values()) == 271


def test_snapshots_stay_while_batches_are_added(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=3)
    log.write(messages(spark, 0, 50), batch=1)
    one = log.end_offsets(spark)
    log.write(messages(spark, 50, 90), batch=2)
    two = log.end_offsets(spark)
    first, second = log.read(spark, ending=one), log.read(spark, one, two)
    before = [sorted(r.value for r in x.collect()) for x in (first, second)]
    log.write(messages(spark, 90, 200), batch=3)
    after = [sorted(r.value for r in x.collect()) for x in (log.read(spark, ending=one), log.read(spark, one, two))]
    assert before == after == [sorted(f"m{i}" for i in range(50)), sorted(f"m{i}" for i in range(50, 90))]
    assert log.read(spark, starting=two).count() == 110 and log.read(spark, two, two).count() == 0


def test_bounds_inside_a_batch(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=2)
    log.write(messages(spark, 0, 60), batch=1)
    log.write(messages(spark, 60, 120), batch=2)
    ends = log.end_offsets(spark)
    low, high = {0: 5}, {0: ends[0] - 3, 1: 7}
    got = offsets(log.read(spark, low, high))
    assert got == {0: list(range(5, ends[0] - 3)), 1: list(range(7))}
    # the same offsets are the same messages however they are asked for
    every = {(r.partition, r.offset): r.value for r in log.read(spark).collect()}
    assert all(every[r.partition, r.offset] == r.value for r in log.read(spark, low, high).collect())


def test_batches_outside_are_not_read(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=2)
    for b in range(4):
        log.write(messages(spark, 100 * b, 100 * b + 100), batch=b)
        if b == 1:
            low = log.end_offsets(spark)
        if b == 2:
            high = log.end_offsets(spark)
    for b in (0, 1, 3):
        for f in glob.glob(f"{log.path}/batch={b}/*.parquet"):
            with open(f, "wb") as out:
                out.write(b"not a parquet file")
    assert sorted(r.value for r in log.read(spark, low, high).collect()) == sorted(f"m{i}" for i in range(200, 300))


def test_replaced_batches_keep_their_offsets(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), partitions=2)
    log.write(messages(spark, 0, 40), batch=1)
    log.write(messages(spark, 40, 70), batch=2)
    ends = log.end_offsets(spark)
    log.write(messages(spark, 40, 70), batch=2, replace_batch=True)
    assert log.end_offsets(spark) == ends
    log.write(messages(spark, 40, 90), batch=2, replace_batch=True)      # the last batch may grow
    assert offsets(log.read(spark)) == {p: list(range(n)) for p, n in log.end_offsets(spark).items()}
    log.write(messages(spark, 0, 40), batch=1, replace_batch=True)       # an earlier one only by as many
    with pytest.raises(ValueError, match="later batches"):
        log.write(messages(spark, 0, 39), batch=1, replace_batch=True)
    with pytest.raises(ValueError, match="replace_batch"):
        log.write(messages(spark, 0, 1), batch=2)


def test_a_batch_counts_from_its_index_on(spark, tmp_path):
    """A writer that died before the index leaves nothing that is read; the next write of the batch replaces it."""
    log = FileLog(str(tmp_path / "log"), partitions=2)
    log.write(messages(spark, 0, 10), batch=1)
    (messages(spark, 10, 30).selectExpr("key", "value", "0 AS partition", "monotonically_increasing_id() AS seq", "current_timestamp() AS timestamp", "2L AS batch")
     .write.partitionBy("batch").mode("append").parquet(log.path))
    assert log.read(spark).count() == 10
    log.write(messages(spark, 10, 30), batch=2)
    assert log.read(spark).count() == 30 and sum(log.end_offsets(spark).values()) == 30


def test_nulls_and_empty_batches(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    log.write(messages(spark, 0, 0), batch=1)
    assert log.read(spark).count() == 0
    log.write(spark.createDataFrame([(None, "v"), (None, None), ("k", None)], "key string, value string"), batch=2)
    assert sorted(map(repr, ((r.key, r.value) for r in log.read(spark).collect()))) == ["('k', None)", "(None, 'v')", "(None, None)"]


def test_kafka_bounds():
    log = KafkaLog("h:9092", "t")
    assert log.offsets(None, "latest") == "latest" and log.offsets({1: 7, 0: 3}, "latest") == '{"t": {"0": 3, "1": 7}}'
    with pytest.raises(ValueError, match="replace"):
        log.write(None, 1, replace_batch=True)

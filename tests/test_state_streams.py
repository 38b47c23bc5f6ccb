"""R3, R4 and R5 with keyed streaming state: newest messages, headers against items."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fiscalflow.operators import normalize, quality
from fiscalflow.sources.messages import FileLog
from fiscalflow.streaming.latest_state import PROVIDER, latest_available, latest_state
from fiscalflow.streaming.reconcile import items_without_header, joined_rows, reconcile_available, reconciled


@pytest.fixture(autouse=True)
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_newest_message_in_state(spark, tmp_path):
    log, ck = FileLog(str(tmp_path / "log")), str(tmp_path / "ck")
    provider = spark.conf.get(PROVIDER, None)
    assert latest_available(spark, log, ck) is None and latest_state(spark, ck).isEmpty()
    changed = []

    def check(ck):
        got = latest_state(spark, ck).select("key", "value", "batch")
        want = normalize.latest_messages(log.read(spark)).select("key", "value", "batch")
        assert rows_of(got) == rows_of(want)

    def run(ck):
        latest_available(spark, log, ck, on_change=lambda df, e: changed.append(df.count()))
        check(ck)

    first = [(f"k{n}", f"v{n}") for n in range(40)] + [(None, "lone"), ("", "blank"), (None, "lone"), ("k1", "again")]
    log.write(spark.createDataFrame(first, "key string, value string").coalesce(1), batch=1)
    run(ck)
    log.write(spark.createDataFrame([("k3", "new"), ("k4", None), ("hot", "x")] + [("hot", "y")] * 30, "key string, value string").coalesce(1), batch=2)
    run(ck)
    assert changed[-1] == 3                    # only what the batch touched comes out
    run(ck)                                    # nothing new
    log.write(spark.createDataFrame([("k3", "newer")], "key string, value string"), batch=3)
    run(str(tmp_path / "other"))               # a lost checkpoint: the log again
    run(ck)
    assert spark.conf.get(PROVIDER, None) == provider


HEADERS = "chNFe string, event_time timestamp, total_vProd double, total_vDesc double, total_vTotTrib double, total_vNF double"
ITEMS = "chNFe string, nItem int, event_time timestamp, vProd double, vDesc double, vTotTrib double"


def day(text):
    import datetime
    return datetime.datetime.fromisoformat(text)


def test_headers_and_items(spark, tmp_path):
    root, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    h_dir, i_dir = str(tmp_path / "headers"), str(tmp_path / "items")

    def header(key, when, total):
        return key, when and day(when), total, 0.0, 0.0, total

    def item(key, number, when, amount):
        return key, number, when and day(when), amount, 0.0, 0.0

    def run(heads, items, until=None):
        spark.createDataFrame(heads, HEADERS).write.mode("append").parquet(h_dir)
        spark.createDataFrame(items, ITEMS).write.mode("append").parquet(i_dir)
        reconcile_available(spark, spark.readStream.schema(HEADERS).parquet(h_dir), spark.readStream.schema(ITEMS).parquet(i_dir),
                            root, ck, until=until, slack="2 days")
        return {(r.chNFe, r.outcome) for r in joined_rows(spark, root).select("chNFe", "outcome").distinct().collect()}

    # hot: many items; far: a time far ahead, which must not close the others; wait: its items come later
    seen = run([header("hot", "2024-01-01", 50.0), header("wait", "2024-01-02", 9.0), header("far", "2290-01-01", 1.0),
                header("none", "2024-01-01", 3.0), header(None, "2024-01-01", 3.0)],
               [item("hot", n, "2024-01-01", 1.0) for n in range(50)] + [item("orphan", 1, "2024-01-01", 2.0)])
    assert seen == {("hot", "matched")}
    seen = run([header("notime", None, 4.0)], [item("wait", 1, "2024-01-02", 4.0), item("notime", 1, None, 4.0)])
    assert seen == {("hot", "matched"), ("wait", "matched"), ("notime", "late_header"), ("notime", "late_item")}
    seen = run([], [], until="2024-02-01")
    assert {("none", "header_only"), ("orphan", "item_only"), (None, "header_only")} <= seen
    assert ("far", "header_only") not in seen
    assert {r.chNFe for r in items_without_header(spark, root).collect()} == {"orphan"}
    # behind the last tick: kept, and the notes are right again; an earlier tick changes nothing
    seen = run([header("orphan", "2024-01-01", 2.0)], [item("wait", 2, "2024-01-02", 5.0), item("hot", 7, "2024-01-01", 1.0)], until="2023-01-01")
    assert {("orphan", "late_header"), ("wait", "late_item"), ("hot", "late_item")} <= seen
    assert items_without_header(spark, root).isEmpty()
    run([], [], until="2300-01-01")
    heads, items = spark.read.schema(HEADERS).parquet(h_dir), spark.read.schema(ITEMS).parquet(i_dir)
    want = quality.reconcile_totals(heads, items.dropDuplicates(["chNFe", "nItem"]))
    assert rows_of(reconciled(spark, root)) == rows_of(want)
    # a lost checkpoint: everything again, nothing twice
    ck = str(tmp_path / "ck2")
    run([], [])
    assert rows_of(reconciled(spark, root)) == rows_of(want)
    right = reconciled(spark, root).where("vprod_ok and chNFe is not null").select("chNFe")
    assert rows_of(right) == [("hot",), ("notime",), ("orphan",), ("wait",)]
    assert reconciled(spark, root).where(F.col("chNFe") == "none").first().n_itens == 0

"""What jobs leave on disk while they run and after: shuffle files, staged frames, state stores, single files."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F
from test_parts import SIZES, items
from test_report_state import frames, version
from test_storage import ROWS, messages

from fiscalflow import registry
from fiscalflow.operators import ranking
from fiscalflow.plans import pipeline
from fiscalflow.session import FREED, SMALL_FILES, checkpoint_dir, frees_shuffles
from fiscalflow.sources import xml as xml_source
from fiscalflow.sources.messages import FileLog
from fiscalflow.streaming.latest_state import COMPACT, latest_available
from fiscalflow.streaming.report_state import ReportState

GIVEN = "/root/testdata/sf0.001"


def shuffle_files(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    return tracker.shuffleStatuses().size()


def checkpoints(spark):
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith("rdd-")}


def test_jobs_leave_no_shuffles(spark, scratch):
    key, = FREED
    before = spark.conf.get(key, None)

    @frees_shuffles
    def job(spark):
        assert spark.conf.get(key) == "true"
        spark.range(1000).repartition(7, "id").write.parquet(f"{scratch}/a")

    n = shuffle_files(spark)
    job(spark)
    assert shuffle_files(spark) <= n and spark.conf.get(key, None) == before
    assert spark.read.parquet(f"{scratch}/a").count() == 1000


def test_report_state_leaves_neither_checkpoints_nor_staged_frames(spark, tmp_path):
    state, rng = ReportState(str(tmp_path / "state"), buckets=4), random.Random(3)
    stage = f"{checkpoint_dir(spark)}/fiscalflow-stage"
    before, staged = checkpoints(spark), set(os.listdir(stage)) if os.path.exists(stage) else set()
    state.update(*frames(spark, [version(rng, k, 1) for k in range(12)]))
    state.update(*frames(spark, [version(rng, k, 2) for k in range(6)]))
    assert checkpoints(spark) == before and set(os.listdir(stage)) == staged
    assert state.report(spark, "tributos_por_nota").count() == 12


def test_numbers_within_keys_are_saved_where_asked(spark, scratch):
    before = checkpoints(spark)
    got = ranking.numbered_within(items(spark, SIZES), "chNFe", folder=f"{scratch}/made").groupBy("chNFe").agg(F.max("number").alias("m"), F.count("*").alias("n"))
    assert {r["chNFe"]: (r["m"], r["n"]) for r in got.collect()} == {k: (n - 1, n) for k, n in SIZES}
    assert checkpoints(spark) == before
    saved = [f for _, _, fs in os.walk(f"{scratch}/made") for f in fs if f.endswith(".parquet")]
    assert saved and all("zstd" in f for f in saved)


def test_state_stores_take_no_space_ahead(spark, scratch):
    log, seen = FileLog(f"{scratch}/log"), {}

    def changed(df, epoch):
        df.count()
        seen.update({k: df.sparkSession.conf.get(k, None) for k in COMPACT})

    log.write(messages(spark, ROWS).select("key", "value"), batch=1)
    latest_available(spark, log, f"{scratch}/ck", on_change=changed)
    assert seen == COMPACT


def test_invoice_texts_are_written_compressed(spark, monkeypatch):
    seen, ingest = [], pipeline.run_ingest

    def watched(spark, xml_dir, *args, **kw):
        seen.extend(f for f in os.listdir(xml_dir) if f.startswith("part-"))
        return ingest(spark, xml_dir, *args, **kw)

    monkeypatch.setattr(pipeline, "run_ingest", watched)
    out = registry.q_xml_files_ingest(spark, GIVEN)
    assert seen and all(f.endswith(".txt.lz4") for f in seen)
    assert out.count() == spark.read.parquet(f"{GIVEN}/orders.parquet").count()


def test_single_files_are_written_by_the_tasks(spark, scratch):
    rows = [("a.txt", "<a>é</a>"), ("b.txt", ""), ("c.txt", None), ("d.txt", "x\ny")]
    for folder in (f"{scratch}/plain", f"file:{scratch}/uri"):
        xml_source.write_single_files(spark.createDataFrame(rows, "name string, value string").repartition(3), folder)
        path = folder.removeprefix("file:")
        # no checksum files and no names that Spark's writer gives
        assert {f: open(f"{path}/{f}", encoding="utf-8", newline="").read() for f in os.listdir(path)} == {n: (v or "") + "\n" for n, v in rows}


def test_small_files_are_packed_and_listed_once(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/x")
    for i in range(3):
        open(f"{scratch}/x/{i}.xml", "w").write("<nfeProc></nfeProc>" if i else "")
    key, = SMALL_FILES
    before, stage, seen = spark.conf.get(key, None), pipeline.stage, []
    monkeypatch.setattr(pipeline, "stage", lambda df, label: (seen.append(spark.conf.get(key)), stage(df, label))[1])
    res = pipeline.run_ingest(spark, f"{scratch}/x", FileLog(f"{scratch}/log"))
    assert seen == [SMALL_FILES[key]] and spark.conf.get(key, None) == before
    assert sorted((os.path.basename(r.file), r.reason) for r in res.rejects.collect()) == [("0.xml", "empty_file"), ("1.xml", "no_invoice"), ("2.xml", "no_invoice")]
    docs = xml_source.read_xml_documents(spark, f"{scratch}/x")
    listed = [xml_source.files_without_rows(spark, f"{scratch}/x", docs.select("file"), scan=scan).collect() for scan in (None, docs)]
    assert listed[0] == listed[1] and len(listed[0]) == 1
    none = docs.where("false").select("file")
    assert xml_source.files_without_rows(spark, f"{scratch}/x", none, glob="*.none").isEmpty()

"""Incremental reports equal a full computation of the newest versions after every run."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fiscalflow.operators import normalize, reports
from fiscalflow.streaming.report_state import FACTS, ITEM_FACTS, NOTE_FACTS, POSITION, ReportState

NOTES = FACTS["notas"].split(", run")[0]
ITEMS = FACTS["itens"].split(", run")[0]


def version(rng, key, batch):
    """A version of a note and its items."""
    at = ("2024-01-01 00:00:00", batch, 0, key)
    val = rng.choice([None, 0.0, 10.5, 10.5, 99.99, 1e20, -3.25])
    note = (f"k{key}", str(key), f"2024-0{rng.randrange(1, 4)}-05T10:00:00-03:00", str(rng.randrange(3)), "n", rng.choice([None, "x"]),
            rng.choice(["SP", "RJ", None]), val, 1.0 * key, None, 0.0, 0.0, rng.choice([None, 2.5]), *at)
    items = [(f"k{key}", str(rng.randrange(4)), "p", "UN", rng.choice([1.0, 2.5]), rng.choice([None, 7.77]), rng.choice([3.0, 4.5]), *at)
             for _ in range(rng.randrange(4))]
    return note, items


def frames(spark, versions):
    notes = spark.createDataFrame([n for n, _ in versions], NOTES.replace("timestamp timestamp", "timestamp string"))
    items = spark.createDataFrame([i for _, x in versions for i in x], ITEMS.replace("timestamp timestamp", "timestamp string"))
    return [df.withColumn("timestamp", F.col("timestamp").cast("timestamp")) for df in (notes, items)]


def canon(df):
    return sorted(repr([(c, r[c]) for c in sorted(df.columns)]) for r in df.collect())


def full(spark, versions):
    notes, items = frames(spark, versions)
    newest = normalize.latest_by_key(notes, "chNFe", POSITION)
    kept = items.join(newest.select("chNFe", *POSITION), ["chNFe", *POSITION], "left_semi")
    return {name: fn({"notas": newest, "itens": kept}[src]) for name, (_, src, fn) in reports.REPORTS.items()}


def check(spark, state, versions):
    for name, want in full(spark, versions).items():
        got = state.report(spark, name)
        assert set(got.columns) == set(want.columns)
        assert canon(got) == canon(want), name


def test_publish_republish_change_and_late_versions(spark, tmp_path):
    rng = random.Random(7)
    state = ReportState(str(tmp_path / "state"), buckets=8)
    first = [version(rng, k, 1) for k in range(30)]
    assert state.update(*frames(spark, first))
    check(spark, state, first)
    assert not state.update(*frames(spark, first))                     # the same versions again
    second = [version(rng, k, 3) for k in range(20, 40)]               # some replaced, some new
    second += [version(rng, k, 4) for k in range(20, 23)]              # two versions in one run
    assert state.update(*frames(spark, second))
    late = [version(rng, k, 2) for k in range(18, 26)]                 # between the versions that are there
    assert state.update(*frames(spark, late))
    every = first + second + late
    check(spark, state, every)
    state.compact(spark)
    assert len(state.runs(spark)) == 1
    check(spark, state, every)
    last = [version(rng, k, 9) for k in range(40)]                     # every extreme and every number is taken back
    assert state.update(*frames(spark, last))
    check(spark, state, every + last)


def test_cost_follows_the_changed_rows(spark, tmp_path):
    rng = random.Random(8)
    state = ReportState(str(tmp_path / "state"), buckets=64)
    state.update(*frames(spark, [version(rng, k, 1) for k in range(200)]))
    before = state._read(spark, "counters", "run string").count()
    state.update(*frames(spark, [version(rng, 5, 2)]))
    # one note touches its groups before and after alone, and one bucket of facts
    assert state._read(spark, "counters", "run string").count() - before <= 40
    run = [r for r in state.runs(spark) if state._read(spark, "notas", FACTS["notas"]).where(F.col("run") == r).count() == 1]
    assert len(run) == 1


def test_a_run_that_died_does_not_count(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    state = ReportState(str(tmp_path / "state"), buckets=4)
    first = [version(rng, k, 1) for k in range(10)]
    state.update(*frames(spark, first))
    second = [version(rng, k, 2) for k in range(5)]

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(ReportState, "_commit", dies)
        with pytest.raises(RuntimeError):
            state.update(*frames(spark, second))
    check(spark, state, first)
    state.update(*frames(spark, second))
    check(spark, state, first + second)


def test_empty(spark, tmp_path):
    state = ReportState(str(tmp_path / "state"))
    notes, items = frames(spark, [version(random.Random(1), 1, 1)])
    assert not state.update(notes.limit(0), items.limit(0))
    assert all(state.report(spark, n).count() == 0 for n in reports.REPORTS)
    assert set(NOTE_FACTS) < set(notes.columns) and set(ITEM_FACTS) < set(items.columns)

"""Distributed places against sorting in Python."""

from __future__ import annotations

import random

import pytest

from fiscalflow.operators.ranking import numbered, ranked

ORDER = (("v", True), ("k", False))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v double, k string").repartition(5)


def data(n=500):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 0.0, 0.0, 0.0, 1.5, -2.0, 7.0]), rng.choice([None, "a", "b", "c"])) for i in range(n)]
    return rows + [(1, 0.0, "a")] * 200     # a hot key of equal rows


def key(r):
    """Spark's order: nulls last when descending, first when ascending."""
    return (r[1] is None, -(r[1] or 0.0), r[2] is not None, r[2] or "")


def test_row_numbers(spark):
    rows = data()
    got = sorted((r.place, (r.id, r.v, r.k)) for r in numbered(frame(spark, rows), ORDER).collect())
    assert [p for p, _ in got] == list(range(1, len(rows) + 1))
    assert [key(r) for _, r in got] == sorted(map(key, rows))
    assert sorted(map(repr, (r for _, r in got))) == sorted(map(repr, rows))


@pytest.mark.parametrize("dense", [False, True])
def test_ranks(spark, dense):
    rows = data()
    keys = sorted(map(key, rows))
    distinct = sorted(set(keys))
    want = sorted(repr(((distinct if dense else keys).index(key(r)) + 1, *r)) for r in rows)
    got = ranked(frame(spark, rows), ORDER, "p", dense)
    assert sorted(repr((r.p, r.id, r.v, r.k)) for r in got.collect()) == want


def test_no_single_task_window(spark):
    for df in (numbered(frame(spark, data()), ORDER), ranked(frame(spark, data()), ORDER)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan


def test_empty(spark):
    none = frame(spark, data()).limit(0)
    assert numbered(none, ORDER).count() == 0 and ranked(none, ORDER).count() == 0

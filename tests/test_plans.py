"""Plan shape: no Python UDFs, top-k without a full sort, pruned scans, checked broadcasts."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from fiscalflow import registry


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"stream_available_now"}))
def test_no_python_udf(spark, name):
    """The invoice queries alone: the corpus operators have their own tests."""
    plan = executed(registry.QUERIES[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "MapInPandas", "MapInArrow", "PythonUDF"):
        assert marker not in plan, (name, marker)


def test_topk_is_take_ordered(spark):
    plan = executed(registry.q_produtos_mais_vendidos(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_report_scans_are_pruned(spark):
    df = registry.q_valor_medio_mensal(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "orders" in line]
    assert scans
    for s in scans:
        schema = s.split("ReadSchema: ")[1]
        assert "o_orderpriority" not in schema and "o_orderstatus" not in schema


def test_nation_broadcast_after_check(spark):
    plan = executed(registry.q_notas_por_uf(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["uf_emitente", "total_notas", "valor_total", "valor_medio"]
    assert df.count() > 0

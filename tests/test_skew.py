"""Hot keys: one customer, one order and one user each hold a third of their table.

The skewed copies are written from the smallest test tables; queries must stay exact
(DuckDB oracle) and invoice item lists must stay bounded.
"""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fiscalflow.sources import star
from fiscalflow.sources.star import TABLES

SKEWED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM t",
    "lineitem": "SELECT * REPLACE (CASE WHEN row_number() OVER () % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey)"
                " FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM t",
}


@pytest.fixture(scope="module")
def skew_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name in TABLES:
        src = f"{SF_SMALL}/{name}.parquet"
        if name in SKEWED:
            con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{src}')")
            con.execute(f"COPY ({SKEWED[name]}) TO '{d}/{name}.parquet' (FORMAT PARQUET)")
        else:
            os.symlink(src, f"{d}/{name}.parquet")
    return d


@pytest.fixture(scope="module")
def con(skew_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skew_dir}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ["notas_por_uf", "faturamento_emitente", "tributos_por_nota", "latest_by_key",
                                  "json_encode_parse_itens", "totals_reconciliation", "produtos_mais_vendidos",
                                  "json_parse_notas", "persisted_notas_por_uf", "xml_roundtrip_itens"])
def test_exact_under_skew(spark, con, skew_dir, name):
    df = entry.queries()[name](spark, skew_dir)
    res = con.execute(entry.oracle_sql()[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in res.description],
                                                                        res.fetchall())


def test_hot_order_is_one_note_everywhere(spark, con, skew_dir):
    t = star.Tables(spark, skew_dir)
    n_hot = con.execute("SELECT COUNT(*) FROM lineitem WHERE l_orderkey = 11").fetchone()[0]
    g = star.item_groups(t).filter(F.col("l_orderkey") == 11).select(F.size("itens").alias("n")).collect()
    assert [r.n for r in g] == [n_hot]                        # no item dropped
    note = star.notas(t).filter("ide_nNF = '11'").collect()
    record = star.records(t).filter(F.col("nfe.ide.nNF") == "11").select("nfe.chNFe", "nfe.total.vNF").collect()
    assert [(r.chNFe, float(r.vNF)) for r in record] == [(r.chNFe, r.total_vNF) for r in note]


def test_reconciles_beyond_one_series(spark, tmp_path):
    """A second copy of the orders, shifted by the size of a series, has the same numbers."""
    con = duckdb.connect()
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(f"""COPY (SELECT * FROM '{SF_SMALL}/{name}.parquet' UNION ALL
            SELECT * REPLACE ({key} + 1000000000 AS {key}) FROM '{SF_SMALL}/{name}.parquet') TO '{tmp_path}/{name}.parquet' (FORMAT PARQUET)""")
    for name in TABLES:
        if name not in ("orders", "lineitem"):
            os.symlink(f"{SF_SMALL}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    got = entry.queries()["totals_reconciliation"](spark, str(tmp_path))
    assert got.count() == 3000 and got.where("not vprod_ok or not vdesc_ok or not vtottrib_ok").count() == 0

"""Message parsing and flattening (P8-P15; N7, N8, N9) and latest-by-key."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fiscalflow.operators import normalize


def msg(key, itens, vnf="10.00"):
    return json.dumps({"chNFe": key, "versao": "3.10", "ide": {"nNF": "1", "dhEmi": "2024-01-01T00:00:00-03:00"},
                       "emit": {"endereco": {"UF": "SP"}}, "total": {"vNF": vnf}, "itens": itens},
                      ensure_ascii=False)


def test_parse_flatten_rejects(spark):
    item = {"nItem": "1", "cProd": "9", "qCom": "2.0000", "vProd": "abc"}
    rows = [
        ("k1", msg("k1", [item, {"nItem": "2", "cProd": "8"}])),
        ("k2", msg("k2", [], vnf="")),                 # empty item list, empty number
        ("k3", msg("k3", None)),                       # NULL item list
        ("k4", "{not json"),                           # malformed (N8)
        ("k5", None),                                  # NULL value
    ]
    m = spark.createDataFrame(rows, "key string, value string")
    parsed = normalize.parse_messages(m, keep=("key",))
    good, bad = normalize.split_parsed(parsed)
    assert sorted(r.key for r in bad.collect()) == ["k4", "k5"]
    # reference parity: every message becomes a header row, malformed ones all NULL
    notas = {r.chNFe: r for r in normalize.notas(parsed).collect()}
    assert len(notas) == 4 and None in notas
    assert notas["k2"].total_vNF is None and notas["k1"].total_vNF == 10.0          # N7
    itens = normalize.itens(good).collect()
    assert [(r.chNFe, r.nItem) for r in sorted(itens, key=lambda r: r.nItem)] == [("k1", 1), ("k1", 2)]   # N9
    first = [r for r in itens if r.nItem == 1][0]
    assert first.qCom == 2.0 and first.vProd is None                                 # bad number -> NULL
    outer = normalize.itens(good, outer=True).collect()
    assert sorted({r.chNFe for r in outer}) == ["k1", "k2", "k3"]


def test_parse_runs_once_per_row(spark):
    m = spark.createDataFrame([("k", msg("k", [{"nItem": "1"}]))], "key string, value string")
    parsed = normalize.parse_messages(m)
    good, _ = normalize.split_parsed(parsed)
    plan = normalize.itens(good)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_latest_by_key_brute_force(spark):
    rows = [(k, ts, off, f"v{k}{ts}{off}") for k in range(5) for ts in range(4) for off in range(3)]
    rows += [(0, 9, i, f"hot{i}") for i in range(200)]       # one hot key with many rows
    df = spark.createDataFrame(rows, "key int, ts int, offset int, value string")
    got = {r.key: (r.ts, r.offset, r.value) for r in normalize.latest_by_key(df, "key", ("ts", "offset")).collect()}
    want = {}
    for k, ts, off, v in rows:
        if k not in want or (ts, off) > want[k][:2]:
            want[k] = (ts, off, v)
    assert got == want


def test_latest_by_key_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 1, "a")], "key int, ts int, value string")
    plan = normalize.latest_by_key(df, "key", ("ts",))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_max_by" in plan          # combined map-side before the shuffle


def test_latest_messages_orders_by_log_position(spark):
    rows = [("a", "old", 0, 5, 1), ("a", "new", 0, 1, 2), ("b", "x", 1, 3, 1), ("b", "y", 1, 4, 1)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset long, batch long")
    df = df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = {r.key: r.value for r in normalize.latest_messages(df).collect()}
    assert got == {"a": "new", "b": "y"}

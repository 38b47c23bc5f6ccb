"""Column functions against plain-Python brute force: money rounding, check digit, keys."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xml_fixtures import KEYS

from fiscalflow.functions import keys, money


def half_up(x: Decimal, places: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def test_money_avg_exact_ties(spark):
    # 0.005 ties and a group far beyond 10^6 rows (where a 6-digit decimal average double-rounds)
    rows = [("a", "1.00"), ("a", "1.01"), ("b", "0.01"), ("b", "0.00"), ("c", "-1.00"), ("c", "-1.01")]
    df = spark.createDataFrame(rows, "g string, v string").withColumn("v", F.col("v").cast("double"))
    got = {r.g: r.avg for r in df.groupBy("g").agg(money.money_avg("v").alias("avg")).collect()}
    assert got == {"a": 1.01, "b": 0.01, "c": -1.01}

    n = 2_000_001                                   # sum = 1 cent + (n-1) * 0 -> avg just below .005 boundary
    big = spark.range(n).select(F.when(F.col("id") < 1000001, F.lit(0.01)).otherwise(F.lit(0.0)).alias("v"))
    r = big.agg(money.money_avg("v").alias("a"), money.money_sum("v").alias("s")).first()
    exact = Decimal(1000001) / Decimal(100) / Decimal(n)
    assert r.a == half_up(exact, 2)
    assert r.s == 10000.01


def test_money_avg_matches_decimal_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(5), round(rnd.uniform(0, 1000), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(money.money_sum("v").alias("s"),
                                                         money.money_avg("v").alias("a")).collect()}
    for g in range(5):
        vals = [Decimal(str(v)) for k, v in rows if k == g]
        assert got[g] == (float(sum(vals)), half_up(sum(vals) / len(vals), 2))


def test_percent_guard(spark):
    df = spark.createDataFrame([(1.76, 30.0), (1.0, 0.0), (1.0, None), (None, 10.0), (1.0, 3.0)],
                               "p double, w double")
    got = [r.pct for r in df.select(money.percent_of("p", "w").alias("pct")).collect()]
    assert got == [5.87, 0.0, 0.0, None, 33.33]


def weighted(digits: str) -> int:
    """Digits times 2, 3, ..., 9, 2, ... from the right, summed."""
    return sum(int(c) * (2 + i % 8) for i, c in enumerate(digits[::-1]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789", min_size=43, max_size=43), min_size=1, max_size=20))
def test_check_digit_completes_the_sum(spark, bodies):
    """With its check digit a key's weighted sum leaves 0, or 0 or 1 when the digit is 0."""
    df = spark.createDataFrame([(b,) for b in bodies] + [("12a" + "0" * 40,), ("1" * 42,)], "b string")
    got = [r.dv for r in keys.with_check_digit(df, "b", "dv").collect()]
    assert got[-2:] == [None, None]
    for b, dv in zip(bodies, got):
        assert 0 <= dv <= 9 and (weighted(b) + dv) % 11 in ((0,) if dv else (0, 1))


def test_check_digit_of_known_keys(spark):
    df = spark.createDataFrame([(k,) for k in KEYS.values()], "b string")
    assert [r.dv for r in keys.with_check_digit(df, "b", "dv").collect()] == [int(k[-1]) for k in KEYS.values()]


def test_key_parts_and_compose(spark):
    df = spark.createDataFrame([(35, "2401", 11111111000191, 1, 101, 12345678), (35, "2401", 11111111000191, 1234, 101, 1)],
                               "cuf int, aamm string, cnpj long, serie int, nnf long, cnf long")
    out = keys.with_access_key(df, "k", F.col("cuf"), F.col("aamm"), F.col("cnpj"), F.lit("55"), F.col("serie"),
                               F.col("nnf"), F.lit("1"), F.col("cnf"))
    k, too_long = (r.k for r in out.collect())
    assert k == KEYS["ok_1"] and too_long is None   # a series of four digits is not cut to three
    parts = out.select(*keys.key_part_columns("k")).first().asDict()
    assert parts == {"cUF": "35", "AAMM": "2401", "CNPJ": "11111111000191", "mod": "55", "serie": "001",
                     "nNF": "000000101", "tpEmis": "1", "cNF": "12345678", "cDV": k[-1]}


def test_no_amount_is_dropped_or_rounded_before_the_sum(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("a", 0.004), ("b", 5.0), ("b", 200_000_000.0), ("c", 1e20), ("c", 1.0),
                                ("d", float("nan")), ("d", 1.0), ("e", None)], "g string, v double")
    got = {r.g: r for r in df.groupBy("g").agg(money.money_sum("v").alias("s"), money.money_avg("v").alias("a"),
                                               money.money_max("v").alias("x")).collect()}
    assert got["a"].s == 0.01 and got["b"].a == 100_000_002.5 and got["c"].s == 1e20 and got["c"].x == 1e20
    assert got["d"].s != got["d"].s and got["e"].s is None and got["e"].a is None
    pct = spark.createDataFrame([(1e15, 1e16), (1e19, 1e20), (0.004, 0.03)], "p double, w double")
    assert [r.x for r in pct.select(money.percent_of("p", "w").alias("x")).collect()] == [10.0, 10.0, 13.33]

"""Invoices in parts: bounded messages, exact reassembly, incomplete and repeated publications."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalflow.operators import parts, ranking
from fiscalflow.schemas import INVOICE_SCHEMA
from fiscalflow.sources.messages import FileLog

ITEM = INVOICE_SCHEMA["itens"].dataType.elementType


def items(spark, sizes):
    """(chNFe, item): so many items of each key."""
    df = spark.createDataFrame(sizes, "chNFe string, n long").withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).repartition(5, "i")
    fields = [(F.col("i").cast("string") if f.name == "nItem" else F.lit("1.5") if f.name == "vProd" else F.lit("x")).alias(f.name) for f in ITEM.fields]
    return df.select("chNFe", F.struct(*fields).alias("item"))


def heads(spark, keys, value="10.00"):
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    nfe = F.from_json(F.format_string('{"chNFe":"%s","ide":{"nNF":"7"},"total":{"vNF":"' + value + '"}}', F.col("k")), INVOICE_SCHEMA)
    return rows.select(nfe.alias("nfe"))


SIZES = [("hot", 1000), ("three", 3), ("ten", 10), ("eleven", 11), ("elsewhere", 4)]
KEYS = ["hot", "three", "ten", "eleven", "none"]


def messages(spark, publication, **options):
    return parts.to_part_messages(heads(spark, KEYS, **options), items(spark, SIZES), F.lit(publication), max_items=10)


def state(parsed):
    notas, itens = parts.tables_of(parts.newest_parts(parsed))
    got = {r.chNFe: (r.publicacao, r.total_vNF) for r in notas.collect()}
    assert notas.count() == len(got)
    return got, sorted((r.chNFe, r.nItem) for r in itens.collect())


ALL = sorted((k, i + 1) for k, n in SIZES if k in KEYS for i in range(n))


def test_numbers_within_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k")).repartition(7)
    got = {}
    for r in ranking.numbered_within(df, "k").collect():
        got.setdefault(r.k, []).append(r.number)
    assert len(got) == 1002 and all(sorted(x) == list(range(len(x))) for x in got.values())


def test_no_message_is_longer_than_asked(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    log.write(messages(spark, "1"), batch=1)
    parsed = parts.parsed_parts(log.read(spark))
    lengths = {}
    for r in parsed.select("chave", "parte", "partes", F.size("nfe.itens").alias("n")).collect():
        lengths.setdefault(r.chave, {})[r.parte] = (r.partes, r.n)
    assert lengths["hot"] == {i: (100, 10) for i in range(100)}
    assert lengths["three"] == {0: (1, 3)} and lengths["ten"] == {0: (1, 10)} and lengths["none"] == {0: (1, 0)}
    assert sorted(lengths["eleven"].values()) == [(2, 1), (2, 10)]
    assert state(parsed) == ({k: ("1", 10.0) for k in KEYS}, ALL)


def test_a_publication_counts_when_all_parts_are_there(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    log.write(messages(spark, "1"), batch=1)
    second = messages(spark, "2", value="20.00")
    late = (F.get_json_object("value", "$.parte") == "1") & F.col("key").isin("hot", "eleven")
    log.write(second.where(~late), batch=2)
    log.write(second.where(~late & (F.col("key") == "ten")), batch=3)      # sent twice
    parsed = parts.parsed_parts(log.read(spark))
    want = {k: ("2", 20.0) if k not in ("hot", "eleven") else ("1", 10.0) for k in KEYS}
    assert state(parsed) == (want, ALL)
    assert sorted((r.key, r.publicacao, r.partes, r.presentes) for r in parts.incomplete(parsed).collect()) == [("eleven", "2", 2, 1), ("hot", "2", 100, 99)]
    log.write(second.where(late), batch=4)
    parsed = parts.parsed_parts(log.read(spark))
    assert state(parsed) == ({k: ("2", 20.0) for k in KEYS}, ALL) and parts.incomplete(parsed).count() == 0


def test_messages_without_parts_and_odd_ones(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    rows = [("a", '{"chNFe":"a","total":{"vNF":"1.00"},"itens":[{"nItem":"1"}]}'), ("b", None), ("c", "{broken"), ("", '{"chNFe":" "}'),
            ("d", '{"chNFe":"d","parte":"5","partes":"1","publicacao":"1"}')]
    log.write(spark.createDataFrame(rows, "key string, value string"), batch=1)
    log.write(spark.createDataFrame([("a", '{"chNFe":"a","total":{"vNF":"2.00"},"itens":[{"nItem":"1"},{"nItem":"2"}]}')], "key string, value string"), batch=2)
    parsed = parts.parsed_parts(log.read(spark))
    assert state(parsed) == ({"a": ("", 2.0)}, [("a", 1), ("a", 2)])
    assert [r.key for r in parts.incomplete(parsed).collect()] == ["d"]
    assert parts.item_parts(items(spark, SIZES).limit(0)).count() == 0

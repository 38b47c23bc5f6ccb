"""End to end on hand-written XML files: ingest -> persist -> reports."""

from __future__ import annotations

import os
import shutil
import uuid

import pytest
from xml_fixtures import GOOD, KEYS, REJECTS, write_fixtures

from fiscalflow.plans import pipeline
from fiscalflow.plans.catalog import read_table
from fiscalflow.sources.messages import FileLog


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("fixtures"))
    xml_dir = write_fixtures(os.path.join(base, "xmls"))
    log = FileLog(os.path.join(base, "log"))
    db = "nfe_" + uuid.uuid4().hex[:6]
    ing = pipeline.run_ingest(spark, xml_dir, log, db=db)
    per = pipeline.run_persist(spark, log, db=db)
    summary = {r.table_name: r.row_count for r in pipeline.run_reports(spark, db).collect()}
    return {"base": base, "xml_dir": xml_dir, "log": log, "db": db, "ingest": ing, "persist": per,
            "summary": summary}


def rows(spark, run, table):
    return pipeline.read_report(spark, table, run["db"]).collect()


def test_rejects_table(spark, run):
    saved = {os.path.basename(r.file): r.reason for r in read_table(spark, "nfe_rejeitos", run["db"]).collect()}
    assert saved == {**REJECTS, "empty.xml": "empty_file"}


def test_ingest_counts_and_rejects(run):
    ing = run["ingest"]
    assert ing.messages == len(GOOD) == 10
    got = {os.path.basename(r.file): r.reason for r in ing.rejects.collect()}
    assert got == {**REJECTS, "empty.xml": "empty_file"}     # a file of no bytes has no row in any scan
    malformed = [r for r in ing.rejects.collect() if r.reason == "malformed"]
    assert all(r.raw for r in malformed)          # raw text kept for malformed files
    audit = {(s, m): v for s, m, v in ing.audit.rows()}
    assert audit[("parsed_files", "invoices")] == 10
    assert audit[("parsed_files", "rejected")] == 5


def test_base_tables(spark, run):
    assert run["persist"].notas == 10
    assert run["persist"].itens == 14                 # no_items contributes none (N9)
    notas = {r.chNFe: r for r in read_table(spark, "nfe_notas", run["db"]).collect()}
    assert set(notas) == {v for v in KEYS.values()}
    nt = notas[KEYS["no_total"]]
    assert (nt.total_vNF, nt.total_vProd, nt.total_vTotTrib, nt.total_vBC) == (0.0, 0.0, 0.0, 0.0)   # N2
    assert notas[KEYS["empty_child"]].total_vNF is None                                         # N1, N7
    dc = notas[KEYS["dest_cnpj"]]
    assert (dc.dest_CPF, dc.dest_CNPJ, dc.dest_xMun, dc.dest_UF) == ("", "11222333000181", "", "")  # N3
    assert notas[KEYS["ok_1"]].emit_xNome == "MERCADO SÃO JOÃO"                                 # N18
    itens = read_table(spark, "nfe_itens", run["db"]).collect()
    esponja = [r for r in itens if r.cProd == "702"]
    assert len(esponja) == 1 and esponja[0].vTotTrib is None                                   # N10
    assert {r.nItem for r in itens if r.chNFe == KEYS["ok_3"]} == {1, 2, 3, 4, 5}


def test_report_notas_por_uf(spark, run):
    got = [tuple(r) for r in rows(spark, run, "resultado_notas_por_uf")]
    assert got == [("SP", 7, 122.5, 17.5), ("RJ", 3, 81.4, 40.7)]


def test_report_valor_medio_mensal(spark, run):
    got = [tuple(r) for r in rows(spark, run, "resultado_valor_medio_mensal")]
    assert got == [
        ("2024-01", 2, 40.0, 20.0, 10.0, 30.0),       # 2024-01-31T23:30-03:00 stays in January (N6)
        ("2024-02", 2, 150.4, 75.2, 69.0, 81.4),
        ("2024-03", 6, 13.5, 2.7, 0.0, 12.0),
    ]


def test_report_produtos(spark, run):
    got = [tuple(r) for r in rows(spark, run, "resultado_produtos_mais_vendidos")]
    assert got[0] == ("329", "LEITE INTEGRAL UHT 1L", "UN", 2, 11.0, 55.0, 5.0)
    assert [r[0] for r in got[:6]] == ["329", "505", "502", "410", "503", "701"]   # ties by code (N13)
    assert len(got) == 13


def test_report_tributos(spark, run):
    got = {r.chave_nfe: r for r in rows(spark, run, "resultado_tributos_por_nota")}
    assert got[KEYS["ok_1"]].percentual_tributos == 5.87
    assert got[KEYS["ok_2"]].percentual_tributos == 5.93
    assert got[KEYS["zero_value"]].percentual_tributos == 0.0         # vNF = 0 (N11)
    assert got[KEYS["empty_child"]].percentual_tributos == 0.0        # vNF NULL takes ELSE 0


def test_report_faturamento(spark, run):
    got = {r.cnpj_emitente: tuple(r) for r in rows(spark, run, "resultado_faturamento_emitente")}
    assert got["11111111000191"] == ("11111111000191", "MERCADO SÃO JOÃO", "SÃO JOÃO", "SP", 4, 53.5, 53.5, 3.05)


def test_summary_counts(run):
    assert run["summary"] == {
        "resultado_notas_por_uf": 2, "resultado_faturamento_emitente": 3,
        "resultado_produtos_mais_vendidos": 13, "resultado_tributos_por_nota": 10,
        "resultado_valor_medio_mensal": 3,
    }


def test_republish_and_dedup(spark, run, tmp_path):
    """Publishing the folder again doubles the log; 'latest' keeps one per key."""
    log = FileLog(str(tmp_path / "log"))
    pipeline.run_ingest(spark, run["xml_dir"], log, batch=1)
    pipeline.run_ingest(spark, run["xml_dir"], log, batch=2)
    assert log.read(spark).count() == 20
    db = "nfe_" + uuid.uuid4().hex[:6]
    assert pipeline.run_persist(spark, log, db=db, dedup="none").notas == 20
    assert pipeline.run_persist(spark, log, db=db, dedup="latest").notas == 10
    # re-running persist over the same log is idempotent
    assert pipeline.run_persist(spark, log, db=db, dedup="latest").notas == 10
    kept = read_table(spark, "nfe_notas", db).count()
    assert kept == 10


def test_reports_rerun_idempotent(spark, run):
    first = run["summary"]
    again = {r.table_name: r.row_count for r in pipeline.run_reports(spark, run["db"]).collect()}
    assert again == first


def test_batch_reader_reads_same_invoices(spark, run, tmp_path):
    from fiscalflow.sources.xml import read_xml_rows, split_documents

    d = tmp_path / "good"
    d.mkdir()
    for n in GOOD:
        shutil.copy(os.path.join(run["xml_dir"], n), d / n)
    good, bad = split_documents(read_xml_rows(spark, str(d)))
    assert {r.nfe.chNFe for r in good.collect()} == set(KEYS.values())
    assert bad.count() == 0


def test_ingest_many_documents_per_file(spark, tmp_path):
    """E8 on files holding many invoices each (split across tasks)."""
    from conftest import SF_SMALL
    from pyspark.sql import functions as F

    from fiscalflow.sources import star
    from tools.xml_batches import write_xml_batches

    t = star.Tables(spark, SF_SMALL)
    recs = star.records(t)
    d = str(tmp_path / "bulk")
    assert write_xml_batches(recs, d, docs_per_file=500) == 3
    log = FileLog(str(tmp_path / "log"))
    res = pipeline.run_ingest(spark, d, log, glob="*.txt", many_per_file=True)
    assert res.messages == t["orders"].count()
    assert res.rejects.count() == 0
    want = {r.k for r in recs.select(F.col("nfe.chNFe").alias("k")).collect()}
    assert {r.key for r in log.read(spark).collect()} == want


def test_all_rejected_and_empty_folders(spark, tmp_path):
    """No good file, or no file at all, gives empty results with the full schema."""
    bad_dir = write_fixtures(str(tmp_path / "bad"), list(REJECTS))
    res = pipeline.run_ingest(spark, bad_dir, FileLog(str(tmp_path / "log1")))
    assert res.messages == 0 and res.rejects.count() == len(REJECTS)
    empty = tmp_path / "empty"
    empty.mkdir()
    res = pipeline.run_ingest(spark, str(empty), FileLog(str(tmp_path / "log2")))
    assert res.messages == 0 and res.rejects.count() == 0
    res = pipeline.run_ingest(spark, str(empty), FileLog(str(tmp_path / "log3")), many_per_file=True)
    assert res.messages == 0


def test_narrow_item_parse_matches_full(spark, run):
    """The item-only XML read (narrow schema) gives the items and rejects of the full read."""
    from pyspark.sql import functions as F

    from fiscalflow.operators import normalize, records
    from fiscalflow.schemas import XML_ITEM_SCHEMA
    from fiscalflow.sources import xml as xs

    text = spark.read.text(run["xml_dir"], wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))
    full_good, full_bad = xs.split_documents(xs.parse_xml_text(text))
    narrow_good, narrow_bad = xs.split_documents(xs.parse_xml_text(text, schema=XML_ITEM_SCHEMA),
                                                 to_record=records.document_items)
    as_set = lambda df: sorted(map(repr, df.collect()))
    assert as_set(normalize.itens(narrow_good)) == as_set(normalize.itens(full_good))
    assert as_set(narrow_bad.select("file", "reason")) == as_set(full_bad.select("file", "reason"))
    from fiscalflow.schemas import XML_CHECK_SCHEMA

    _, check_bad = xs.split_documents(xs.parse_xml_text(text, schema=XML_CHECK_SCHEMA), to_record=lambda d: d)
    assert as_set(check_bad.select("file", "reason")) == as_set(full_bad.select("file", "reason"))


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    from conftest import SF_SMALL

    from fiscalflow.sources import star
    from fiscalflow.sources.xml import read_xml_rows
    from tools.xml_batches import write_xml_batches

    d = str(tmp_path / "bulk")
    write_xml_batches(star.records(star.Tables(spark, SF_SMALL), with_items=False), d, docs_per_file=100_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        docs = read_xml_rows(spark, d, "*.txt")
        assert docs.rdd.getNumPartitions() > 4 and docs.where("doc._corrupt_record is not null").count() == 0
        assert docs.count() == 1500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_persist_rules_and_staging(spark, tmp_path):
    """Empty, broken and keyless messages are rejects; notes without a key never replace each other."""
    import glob

    from conftest import SF_SMALL

    from fiscalflow.operators import records
    from fiscalflow.session import checkpoint_dir
    from fiscalflow.sources import star

    log = FileLog(str(tmp_path / "log"))
    good = records.to_messages(star.records(star.Tables(spark, SF_SMALL), with_items=False)).limit(3)
    bad = spark.createDataFrame([(None, None), ("", '{"chNFe":"1","versao":"a"}'), ("", '{"chNFe":"2","versao":"b"}'), ("k", "{"), ("k", ""),
                                 ("m", '{"versao":"x"}')], "key string, value string")
    log.write(good.unionByName(bad))
    db = "nfe_" + uuid.uuid4().hex[:6]
    root = checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
    before = glob.glob(f"{root}/fiscalflow-stage/*")
    res = pipeline.run_persist(spark, log, db=db)
    assert res.notas == 5      # the two records with an empty message key have keys of their own
    assert sorted(r.reason for r in res.rejects.collect()) in (["empty", "empty", "missing_key"], ["empty", "malformed", "missing_key"])
    assert pipeline.run_persist(spark, log, db=db, dedup="none").rejects.count() == 4
    assert glob.glob(f"{root}/fiscalflow-stage/*") == before      # staged data is gone after each job


def test_shared_folder_is_required_on_a_cluster(spark):
    import pytest as pt

    from fiscalflow.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pt.raises(ValueError):
        checkpoint_dir(Session())

"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the test tables whole through the star-schema mapping of
``fiscalflow.sources.star`` and applies the library operator under test.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.money import money_sum
from .operators import normalize, parts, quality, ranking, records, reports
from .operators.audit import AuditTable
from .plans import catalog, pipeline
from .schemas import ITEM_PATH_SCHEMA, XML_CHECK_SCHEMA, XML_ITEM_SCHEMA, XML_PROTOCOL_SCHEMA
from .session import STAGED, checkpoint_dir, create_empty_file, frees_shuffles, remove_folder
from .sources import star
from .sources import xml as xml_source
from .sources.messages import FileLog, normalize_kafka
from .streaming.incremental import all_rejects, ingest_available, latest_itens, latest_notas, persist_available
from .streaming.latest_state import latest_available, latest_state
from .streaming.reconcile import place_in_file, reconcile_available, reconciled
from .streaming.report_state import ReportState


def _tables(spark: SparkSession, sf_dir: str) -> star.Tables:
    return star.Tables(spark, sf_dir)


def _kept(df: DataFrame) -> DataFrame:
    """A result that outlives the folders and tables it was made from, as compressed columns."""
    return _saved(df, f"{checkpoint_dir(df.sparkSession)}/fiscalflow-kept")


def _saved(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written once below ``folder`` and read from there."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.options(**STAGED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- E1-E5: the five reports -------------------------------------------------------

def q_notas_por_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes per issuer state (header frame: orders + issuer + state)."""
    t = _tables(spark, sf_dir)
    return reports.notas_por_uf(star.notas(t, with_item_totals=False, with_key=False))


def q_faturamento_emitente(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per issuer (header frame with per-note item totals)."""
    t = _tables(spark, sf_dir)
    return reports.faturamento_emitente(star.notas(t, with_key=False), sort=False)


def q_produtos_mais_vendidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-20 products by quantity (item frame: lineitem + part)."""
    t = _tables(spark, sf_dir)
    return reports.produtos_mais_vendidos(star.itens(t))


def q_tributos_por_nota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxes and tax percentage per note (header frame with key and item totals)."""
    t = _tables(spark, sf_dir)
    return reports.tributos_por_nota(star.notas(t), sort=False)


def q_valor_medio_mensal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: value statistics per emission month (orders only: no issuer column is used)."""
    t = _tables(spark, sf_dir)
    return reports.valor_medio_mensal(star.notas(t, with_item_totals=False, with_key=False, with_issuer=False))


# --- message path: records -> JSON / XML -> parse -> flat tables --------------------

ITEM_OUT = ("nNF", "nItem", "cProd", "xProd", "CFOP", "uCom", "qCom", "vUnCom", "vProd", "vDesc", "vTotTrib")
NOTA_OUT = ("chNFe", "ide_nNF", "ide_serie", "ide_dhEmi", "emit_CNPJ", "emit_xNome", "emit_xFant", "emit_UF",
            "total_vProd", "total_vDesc", "total_vNF", "total_vTotTrib", "prot_cStat")


def q_json_encode_parse_itens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> JSON messages -> narrow parse -> exploded items."""
    t = _tables(spark, sf_dir)
    msgs = records.to_messages(star.records(t))
    parsed = normalize.parse_messages(msgs, schema=ITEM_PATH_SCHEMA)
    return normalize.itens(parsed).select(*ITEM_OUT)


def q_json_parse_notas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> JSON messages -> full parse -> header table."""
    t = _tables(spark, sf_dir)
    parsed = normalize.parse_messages(records.to_messages(star.records(t)))
    return normalize.notas(parsed).select(*NOTA_OUT)


def q_xml_roundtrip_itens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> nfeProc XML text -> from_xml -> record -> exploded items."""
    t = _tables(spark, sf_dir)
    text = records.to_xml_text(star.records(t)).select(F.lit("table").alias("file"), F.col("xml").alias("raw"))
    docs = xml_source.parse_xml_text(text, schema=XML_ITEM_SCHEMA)      # only key, nNF and items
    good, _ = xml_source.split_documents(docs, to_record=records.document_items)
    return normalize.itens(good).select(*ITEM_OUT)


# --- data-quality operators ----------------------------------------------------------

KEY_PARTS = ("cUF", "AAMM", "CNPJ", "mod", "serie", "nNF", "tpEmis", "cNF", "cDV")


def q_access_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """44-digit key split into its layout fields."""
    t = _tables(spark, sf_dir)
    return quality.key_parts(star.notas(t, with_item_totals=False).select("chNFe"), "chNFe")


def q_access_key_check_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: modulo-11 check digit recomputed from the first 43 digits."""
    t = _tables(spark, sf_dir)
    keys = star.notas(t, with_item_totals=False).select("chNFe", "o_orderstatus")
    # the last digit of notes with status P is moved up by one, so that it is wrong
    digit = F.pmod(F.substring("chNFe", 44, 1).cast("int") + 1, F.lit(10)).cast("string")
    damaged = F.when(F.col("o_orderstatus") == "P", F.concat(F.substring("chNFe", 1, 43), digit)).otherwise(F.col("chNFe"))
    return quality.check_digit_status(keys.select(damaged.alias("chNFe")), "chNFe")


def q_totals_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header totals against item sums (left join: notes without items count)."""
    t = _tables(spark, sf_dir)
    notas = star.notas(t, with_key=False, with_issuer=False)
    return quality.reconcile_totals(notas, star.itens(t, with_product=False), ("ide_serie", "ide_nNF"), ("serie", "nNF"))


def q_uf_lookup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issuer state -> state code through the nation table; key prefix agreement."""
    t = _tables(spark, sf_dir)
    lookup = t["nation"].select(F.col("n_name").alias("uf"), F.col("n_nationkey").alias("cuf"))
    notas = star.notas(t, with_item_totals=False)
    # status P: the code of another state; status O: a state that isn't in the lookup
    notas = notas.withColumn("ide_cUF", F.when(F.col("o_orderstatus") == "P", F.lit("77")).otherwise(F.col("ide_cUF")))
    notas = notas.withColumn("emit_UF", F.when(F.col("o_orderstatus") == "O", F.lit("XX")).otherwise(F.col("emit_UF")))
    return quality.uf_code_check(notas, lookup)


def q_key_protocol_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of infNFe/@Id against infProt/chNFe and cStat, read back from XML text."""
    t = _tables(spark, sf_dir)
    rec = star.records(t, with_items=False, extra=("o_orderstatus",))
    # status P: a protocol that was denied; status O: the protocol of another key
    r, status = F.col("nfe"), F.col("o_orderstatus")
    denied = r.withField("protocolo", r.getField("protocolo").withField("cStat", F.lit("301")))
    xml = F.to_xml(records.record_to_document(F.when(status == "P", denied).otherwise(r)), records.XML_WRITE_OPTIONS)
    other = F.regexp_replace(xml, "<chNFe>[0-9]", "<chNFe>X")
    text = rec.select(F.when(status == "O", other).otherwise(xml).alias("raw"))
    return quality.protocol_check(xml_source.parse_xml_text(text, schema=XML_PROTOCOL_SCHEMA))


def q_item_tax_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item tax share and outlier flag."""
    t = _tables(spark, sf_dir)
    return quality.item_tax_rate(star.itens(t, with_product=False), keys=("nNF", "nItem"))


def q_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user (ties broken by event id)."""
    t = _tables(spark, sf_dir)
    return normalize.latest_by_key(t["events"], "user_id", ("ts", "event_id"))


def q_event_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on real JSON text: ``events.props`` parsed with a fixed schema."""
    t = _tables(spark, sf_dir)
    e = t["events"]
    parsed = F.from_json(F.col("props"), "k bigint", {"mode": "PERMISSIVE"})
    return e.select("event_id", "user_id", "event_type", parsed.getField("k").alias("k"))


def q_guarded_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> number with ``try_cast``; text that is no number gives NULL."""
    t = _tables(spark, sf_dir)
    li = t["lineitem"]
    return li.select(
        "l_orderkey", "l_linenumber",
        normalize.typed(F.col("l_quantity").cast("string"), "double").alias("qty"),
        normalize.typed(F.col("l_returnflag"), "double").alias("flag_num"),
        normalize.typed(F.substring("l_returnflag", 2, 1), "double").alias("empty_num"),
        normalize.typed(F.col("l_linenumber").cast("string"), "int").alias("line_int"),
    )


def q_missing_block_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks removed from the XML by order status come back as defaults.

    status P: no ICMSTot (all totals "0.00"); status O: no issuer address and no
    recipient (all ""); other notes unchanged.
    """
    t = _tables(spark, sf_dir)
    rec = star.records(t, with_items=False, extra=("o_orderstatus",))
    r = F.col("nfe")
    status = F.col("o_orderstatus")
    no_addr = r.withField("emit", r.getField("emit").withField("endereco", F.lit(None))).withField(
        "dest", F.lit(None))
    no_total = r.withField("total", F.lit(None))
    rec = rec.select(F.when(status == "P", no_total).when(status == "O", no_addr).otherwise(r).alias("nfe"))
    text = records.to_xml_text(rec).select(F.col("xml").alias("raw"))
    good, _ = xml_source.split_documents(xml_source.parse_xml_text(text.select(F.lit("t").alias("file"), "raw")))
    return normalize.notas(good).select(
        "chNFe", "emit_UF", "emit_xMun", "dest_CPF", "dest_xNome", "dest_UF",
        "total_vBC", "total_vProd", "total_vNF", "total_vTotTrib")


def q_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the saved base tables and the five saved result tables."""
    names = [pipeline.NOTAS_TABLE, pipeline.ITENS_TABLE, *(table for table, _, _ in reports.REPORTS.values())]
    return _persisted(spark, sf_dir, False, lambda db: catalog.counts(spark, names, db), reports_too=True)


# --- rejects, republication and the persisted pipeline -----------------------------


def q_xml_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents damaged by order priority are routed to the rejects.

    1-URGENT: text cut after 200 characters (malformed); 2-HIGH: no ``ide`` block;
    3-MEDIUM: ``CTe`` instead of ``NFe`` (no invoice).  Other documents pass.
    """
    t = _tables(spark, sf_dir)
    rec = star.records(t, with_items=False, extra=("o_orderpriority",))
    r, pr = F.col("nfe"), F.col("o_orderpriority")
    rec = rec.select(F.when(pr == "2-HIGH", r.withField("ide", F.lit(None))).otherwise(r).alias("nfe"), pr)
    xml = F.to_xml(records.record_to_document(F.col("nfe")), records.XML_WRITE_OPTIONS)
    raw = (F.when(pr == "1-URGENT", F.substring(xml, 1, 200))
           .when(pr == "3-MEDIUM", F.replace(F.replace(xml, F.lit("<NFe>"), F.lit("<CTe>")),
                                             F.lit("</NFe>"), F.lit("</CTe>")))
           .otherwise(xml))
    text = rec.select(F.col("nfe.chNFe").alias("file"), raw.alias("raw"))
    # only the rejects are used: the good side keeps the (narrow) parsed document as is
    _, bad = xml_source.split_documents(xml_source.parse_xml_text(text, schema=XML_CHECK_SCHEMA),
                                        to_record=lambda doc: doc)
    return bad.select(F.col("file").alias("key"), "reason")


def q_republish_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice published twice to the file log; the newest
    message per key is kept before parsing."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-log/{uuid.uuid4().hex}"
    log, made = FileLog(root), f"{root}/made"
    msgs = _saved(records.to_messages(star.records(t, with_items=False)), made)
    log.write(msgs, batch=1)
    log.write(msgs, batch=2)
    remove_folder(spark, made)
    latest = normalize.latest_messages(log.read(spark))
    parsed = normalize.parse_messages(latest, keep=("batch",))
    return parsed.select(F.col("nfe.chNFe").alias("chNFe"), normalize.typed(F.col("nfe.total.vNF"), "double")
                         .alias("total_vNF"), "batch")


def q_topic_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoices of three order statuses written as three batches; the messages of two snapshots,
    read between fixed offsets once the third batch is there, and whether their offsets have no gaps."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-log/{uuid.uuid4().hex}"
    log = FileLog(root)
    rec = _saved(records.to_messages(star.records(t, with_items=False, extra=("o_orderstatus",)), keep=("o_orderstatus",)), f"{root}/made")
    ends = [None]
    for batch, status in enumerate("FOP"):
        log.write(rec.where(F.col("o_orderstatus") == status).select("key", "value"), batch=batch)
        ends.append(log.end_offsets(spark))
    shots = []
    for n in (1, 2):
        rows = log.read(spark, ends[n - 1], ends[n])
        runs = rows.groupBy("partition").agg((F.max("offset") - F.min("offset") + 1 == F.countDistinct("offset")).alias("gapless"))
        shots.append(rows.join(runs, "partition").select("key", F.lit(n).alias("snapshot"), "gapless"))
    out = _kept(shots[0].union(shots[1]))
    remove_folder(spark, root)
    return out


def q_binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows with binary key and value, as a broker gives them, cast to text and parsed into header rows."""
    t = _tables(spark, sf_dir)
    msgs = records.to_messages(star.records(t, with_items=False))
    raw = msgs.select(F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"), F.lit("nfe-json").alias("topic"),
                      F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    parsed = normalize.parse_messages(normalize_kafka(raw))
    return normalize.notas(parsed).select("chNFe", "ide_nNF", "emit_UF", "emit_xNome", "total_vNF")


def _damaged_messages(t: star.Tables, with_items: bool) -> DataFrame:
    """Invoice messages of all orders, of which some are damaged by order priority:
    1-URGENT: no value; 2-HIGH: text cut after 100 characters; 3-MEDIUM: no key."""
    rec = star.records(t, with_items=with_items, extra=("o_orderpriority", "o_orderkey"))
    pr, r = F.col("o_orderpriority"), F.col("nfe")
    rec = rec.select(F.when(pr == "3-MEDIUM", r.withField("chNFe", F.lit(""))).otherwise(r).alias("nfe"), pr, "o_orderkey")
    value = F.to_json("nfe")
    value = F.when(pr == "1-URGENT", F.lit(None)).when(pr == "2-HIGH", F.substring(value, 1, 100)).otherwise(value)
    return rec.select(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("key"), value.alias("value"))


@frees_shuffles
def _persisted(spark: SparkSession, sf_dir: str, damaged: bool, result: Callable[[str], DataFrame],
               with_items: bool = True, reports_too: bool = False, buckets: int | None = None) -> DataFrame:
    """Messages -> log -> persisted tables (-> reports) in a database and folder of its own,
    which are dropped once ``result`` has been read."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-log/{uuid.uuid4().hex}"
    db = "fiscalflow_" + uuid.uuid4().hex[:12]
    log = FileLog(root)
    log.write(_damaged_messages(t, with_items) if damaged else records.to_messages(star.records(t, with_items=with_items)))
    pipeline.run_persist(spark, log, db=db, buckets=buckets)
    if reports_too:
        pipeline.run_reports(spark, db)
    out = _kept(result(db))
    catalog.drop_database(spark, db)
    remove_folder(spark, root)
    return out


def q_persisted_notas_por_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> message log -> persist (staged snapshot, tables)
    -> five saved reports; the notes-per-state table read back from the catalog."""
    return _persisted(spark, sf_dir, False, lambda db: pipeline.read_report(spark, "resultado_notas_por_uf", db), reports_too=True)


def q_bucketed_issuer_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2, R3, S8 over header and item tables in buckets of the key: one shuffle, for the sum per issuer."""
    def result(db: str) -> DataFrame:
        return reports.conferencia_emitente(*(catalog.read_table(spark, t, db) for t in (pipeline.NOTAS_TABLE, pipeline.ITENS_TABLE)))

    return _persisted(spark, sf_dir, True, result, buckets=16)


@frees_shuffles
def q_parts_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5, P14, R4, R6 in parts: all invoices published in parts of at most three items, then again those of status P,
    with a higher value, and of status O without their second part; each note's newest complete publication."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-log/{uuid.uuid4().hex}"
    log = FileLog(root)
    rec = _saved(star.records(t, with_items=False, extra=("o_orderstatus",)), f"{root}/made")
    items = _saved(star.item_records(t), f"{root}/made")
    r, status = F.col("nfe"), F.col("o_orderstatus")
    higher = r.withField("total", r.getField("total").withField("vNF", (r.getField("total").getField("vNF").cast("decimal(18,2)") + 1).cast("string")))
    again = rec.where("o_orderstatus in ('P', 'O')").select(F.when(status == "P", higher).otherwise(r).alias("nfe"), status)
    log.write(parts.to_part_messages(rec, items, F.lit("1"), max_items=3, folder=f"{root}/made/1"), batch=1)
    remove_folder(spark, f"{root}/made/1")
    second = parts.to_part_messages(again, items, F.concat(F.lit("2"), status), max_items=3, folder=f"{root}/made/2")
    value = lambda f: F.get_json_object("value", f"$.{f}")
    log.write(second.where((value("publicacao") != "2O") | (value("parte") != "1")), batch=2)
    remove_folder(spark, f"{root}/made")
    parsed = _saved(parts.parsed_parts(log.read(spark)), f"{root}/parsed")
    remove_folder(spark, log.path)
    # each of the three is worked out on its own, so that its shuffles are gone before the next one's
    notas, itens = parts.tables_of(parts.newest_parts(parsed))
    notas = _saved(notas.select("chNFe", "publicacao", "total_vNF"), f"{root}/read")
    sums = _saved(itens.groupBy("chNFe").agg(F.count(F.lit(1)).alias("n_itens"), money_sum("vProd").alias("soma")), f"{root}/read")
    lost = _saved(parts.incomplete(parsed).select(F.col("key").alias("chNFe"), F.col("publicacao").alias("incompleta")), f"{root}/read")
    out = notas.join(sums, "chNFe", "left").join(lost, "chNFe", "left")
    out = _kept(out.select("chNFe", "publicacao", "total_vNF", F.coalesce("n_itens", F.lit(0)).alias("n_itens"), "soma", "incompleta"))
    remove_folder(spark, root)
    return out


def q_persisted_notas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 34 columns of the saved header table, with damaged messages in the log."""
    return _persisted(spark, sf_dir, True, lambda db: catalog.read_table(spark, pipeline.NOTAS_TABLE, db), with_items=False)


def q_persisted_itens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 13 columns of the saved item table, with damaged messages in the log."""
    return _persisted(spark, sf_dir, True, lambda db: catalog.read_table(spark, pipeline.ITENS_TABLE, db))


def q_persisted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved rejects of damaged messages, with reason."""
    return _persisted(spark, sf_dir, True, lambda db: catalog.read_table(spark, pipeline.MESSAGE_REJECTS_TABLE, db)
                      .select("key", "reason"), with_items=False)


def q_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the five saved result tables in their order: a row number and the first column."""
    def result(db: str) -> DataFrame:
        placed = []
        for table in reports.REPORT_ORDER:
            df = pipeline.read_report_places(spark, table, db)
            placed.append(df.select(F.lit(table).alias("table_name"), "place", F.col(df.columns[0]).alias("name")))
        return reduce(DataFrame.union, placed)

    return _persisted(spark, sf_dir, False, result, reports_too=True)


def q_report_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O2: rank and dense rank of every note by its tax, ties included, and its row number by tax and key."""
    t = _tables(spark, sf_dir)
    notas = _kept(reports.tributos_por_nota(star.notas(t), sort=False).select("chave_nfe", "valor_total_tributos"))
    by = (("valor_total_tributos", True),)
    out = ranking.ranked(ranking.ranked(notas, by, "posto"), by, "posto_denso", dense=True)
    return ranking.numbered(out, (*by, ("chave_nfe", False)), "lugar")


def q_ctas_and_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved, dropped, created by CTAS and overwritten from itself."""
    t = _tables(spark, sf_dir)
    db = "fiscalflow_" + uuid.uuid4().hex[:12]
    catalog.ensure_database(spark, db)
    catalog.save_table(t["nation"].select("n_nationkey", "n_name"), "n", db)
    catalog.drop_table(spark, "n", db)
    catalog.save_table(t["nation"].select("n_nationkey", "n_name", "n_regionkey"), "src", db)
    catalog.create_table_as_select(spark, "n", f"SELECT n_nationkey, n_name FROM `{db}`.src", db)
    again = catalog.read_table(spark, "n", db)
    catalog.save_table(again.withColumn("n_nationkey", F.col("n_nationkey") + 100), "n", db)
    out = _kept(catalog.read_table(spark, "n", db))
    catalog.drop_database(spark, db)
    return out


@frees_shuffles
def q_xml_files_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All invoices written as batch XML files, read back through the ingest job;
    the messages' keys and, for documents damaged by order priority, the rejects."""
    t = _tables(spark, sf_dir)
    rec = star.records(t, with_items=False, extra=("o_orderpriority",))
    pr = F.col("o_orderpriority")
    r = F.col("nfe")
    rec = rec.select(F.when(pr == "2-HIGH", r.withField("ide", F.lit(None))).otherwise(r).alias("nfe"), pr)
    xml = F.to_xml(records.record_to_document(r), records.XML_WRITE_OPTIONS)
    broken = F.regexp_replace(xml, "</?NFe>", "")
    text = rec.select(F.when(pr == "1-URGENT", F.replace(xml, F.lit("</emit>"), F.lit(""))).when(pr == "3-MEDIUM", broken).otherwise(xml).alias("value"))
    root = f"{checkpoint_dir(spark)}/fiscalflow-xml/{uuid.uuid4().hex}"
    text.write.text(f"{root}/files", compression="lz4")
    log = FileLog(f"{root}/log")
    db = "fiscalflow_" + uuid.uuid4().hex[:12]
    res = pipeline.run_ingest(spark, f"{root}/files", log, glob="*.txt.lz4", many_per_file=True, db=db)
    good = log.read(spark).select("key", F.lit("message").alias("outcome"))
    bad = res.rejects.select(F.regexp_extract("raw", 'Id="NFe([0-9]+)"', 1).alias("key"), F.col("reason").alias("outcome"))
    out = _kept(good.union(bad))
    catalog.drop_database(spark, db)
    remove_folder(spark, root)
    return out


@frees_shuffles
def q_xml_single_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S3, P1-P7, E8 on the default path: the newest invoice of every customer as a file of its own, some damaged by
    order priority, and a file of no bytes for every nation; each file's outcome, and the messages' header rows."""
    t = _tables(spark, sf_dir)
    newest = normalize.latest_by_key(t["orders"], "o_custkey", ("o_orderdate", "o_orderkey"))
    rec = star.records(t, with_items=False, orders=newest, extra=("o_orderpriority", "o_custkey"))
    pr, r = F.col("o_orderpriority"), F.col("nfe")
    rec = rec.select(F.when(pr == "2-HIGH", r.withField("ide", F.lit(None))).otherwise(r).alias("nfe"), pr, F.col("o_custkey").alias("customer"))
    xml = F.to_xml(records.record_to_document(r), records.XML_WRITE_OPTIONS)
    text = F.when(pr == "1-URGENT", F.substring(xml, 1, 200)).when(pr == "3-MEDIUM", F.regexp_replace(xml, "</?NFe>", "")).otherwise(xml)
    root = f"{checkpoint_dir(spark)}/fiscalflow-xml/{uuid.uuid4().hex}"
    # each file names its customer at its head
    head = F.concat(F.lit("<!--customer="), F.coalesce(F.col("customer").cast("string"), F.lit("")), F.lit("-->"))
    files = rec.select("customer", text.alias("text")).repartition(4 * spark.sparkContext.defaultParallelism, "customer").groupBy("customer")
    texts = files.agg(F.concat_ws("\n", F.collect_list("text")).alias("text"))
    name = F.concat(F.lit("invoice-"), F.coalesce(F.col("customer").cast("string"), F.lit("")), F.lit(".txt"))
    xml_source.write_single_files(texts.select(name.alias("name"), F.concat(head, "text").alias("value")), f"{root}/files")
    for n in t["nation"].select("n_nationkey").collect():
        create_empty_file(spark, f"{root}/files/customer=-{n[0] + 1}.txt")
    log, db = FileLog(f"{root}/log"), "fiscalflow_" + uuid.uuid4().hex[:12]
    res = pipeline.run_ingest(spark, f"{root}/files", log, glob="*.txt", db=db)
    notas = normalize.notas(normalize.parse_messages(log.read(spark)))
    good = notas.select(F.col("emit_CNPJ").cast("bigint").alias("customer"), F.lit("message").alias("outcome"), "chNFe", "total_vNF")
    named = F.when(F.col("reason") == "empty_file", F.col("file")).otherwise(F.col("raw"))
    bad = res.rejects.select(F.regexp_extract(named, "customer=(-?[0-9]+)", 1).try_cast("bigint").alias("customer"), F.col("reason").alias("outcome"),
                             F.lit(None).cast("string").alias("chNFe"), F.lit(None).cast("double").alias("total_vNF"))
    out = _kept(good.union(bad))
    catalog.drop_database(spark, db)
    remove_folder(spark, root)
    return out


@frees_shuffles
def q_audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that persist, reports and a persisting stream wrote to one audit table, over damaged messages."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-audit/{uuid.uuid4().hex}"
    log, audit, db = FileLog(f"{root}/log"), AuditTable(f"{root}/audit"), "fiscalflow_" + uuid.uuid4().hex[:12]
    log.write(_damaged_messages(t, True), batch=1)
    pipeline.run_persist(spark, log, db=db, audit_table=audit)
    pipeline.run_reports(spark, db, audit_table=audit)
    persist_available(spark, log, f"{root}/tables", f"{root}/checkpoint", audit_table=audit)
    out = _kept(audit.read(spark).groupBy("job", "stage", "metric").agg(F.sum("value").alias("value")))
    catalog.drop_database(spark, db)
    remove_folder(spark, root)
    return out


@frees_shuffles
def q_stream_persist_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages persisted by the stream, read again after a lost checkpoint;
    notes and rejects count once."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-incremental/{uuid.uuid4().hex}"
    log = FileLog(f"{root}/log")
    msgs = _saved(_damaged_messages(t, True), f"{root}/made")
    log.write(msgs, batch=1)
    persist_available(spark, log, f"{root}/tables", f"{root}/checkpoint-1")
    log.write(msgs, batch=2)
    remove_folder(spark, f"{root}/made")
    persist_available(spark, log, f"{root}/tables", f"{root}/checkpoint-2")
    notes = latest_notas(spark, f"{root}/tables").select(F.col("chNFe").alias("key"), F.lit("note").alias("outcome"))
    items = latest_itens(spark, f"{root}/tables").select(F.col("chNFe").alias("key"), F.lit("item").alias("outcome"))
    bad = all_rejects(spark, f"{root}/tables").select("key", F.col("reason").alias("outcome"))
    out = _kept(notes.union(items).union(bad))
    remove_folder(spark, root)
    return out


# --- streaming -----------------------------------------------------------------------


def q_stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a file stream -> invoice messages -> file log (availableNow,
    checkpointed), then the log read back and parsed into header rows."""
    t = _tables(spark, sf_dir)
    stream = (spark.readStream.schema(t["orders"].schema).option("pathGlobFilter", "orders.parquet")
              .parquet(sf_dir))
    recs = star.records(t, with_items=False, orders=stream)
    msgs = recs.select(F.col("nfe.chNFe").alias("key"), F.to_json("nfe").alias("value"))
    root = f"{checkpoint_dir(spark)}/fiscalflow-stream/{uuid.uuid4().hex}"
    log = FileLog(f"{root}/log")
    ingest_available(spark, msgs, log, f"{root}/checkpoint")
    parsed = normalize.parse_messages(log.read(spark))
    return normalize.notas(parsed).select("chNFe", "ide_nNF", "emit_UF", "total_vProd", "total_vNF", "total_vTotTrib")


@frees_shuffles
def q_incremental_persist_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5, E9 incremental: invoices published twice to the log; a checkpointed availableNow
    stream parses the new batches into appended header rows; the newest version per note
    is picked at read time."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-incremental/{uuid.uuid4().hex}"
    log = FileLog(f"{root}/log")
    msgs = _saved(records.to_messages(star.records(t, with_items=False)), f"{root}/made")
    log.write(msgs, batch=1)
    log.write(msgs, batch=2)
    remove_folder(spark, f"{root}/made")
    persist_available(spark, log, f"{root}/tables", f"{root}/checkpoint")
    return latest_notas(spark, f"{root}/tables").select("chNFe", "ide_nNF", "emit_UF", "total_vNF", "total_vTotTrib")


@frees_shuffles
def q_stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All invoices published, then those of status P again with a higher value, then with the given one; three
    runs keep the newest message of each key in the streaming state, from which it is read and parsed."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-state/{uuid.uuid4().hex}"
    log = FileLog(f"{root}/log")
    rec = _saved(star.records(t, with_items=False, extra=("o_orderstatus",)), f"{root}/made")
    r = F.col("nfe")
    higher = (r.getField("total").getField("vNF").cast("decimal(18,2)") + 1).cast("string")
    some = rec.where("o_orderstatus = 'P'")
    for batch, given in enumerate((rec, some.select(r.withField("total", r.getField("total").withField("vNF", higher)).alias("nfe")), some)):
        log.write(records.to_messages(given), batch=batch)
        latest_available(spark, log, f"{root}/checkpoint")
    parsed = normalize.parse_messages(latest_state(spark, f"{root}/checkpoint"), keep=("batch",))
    out = _kept(parsed.select(F.col("nfe.chNFe").alias("chNFe"), normalize.typed(F.col("nfe.total.vNF"), "double").alias("total_vNF"), "batch"))
    remove_folder(spark, root)
    return out


@frees_shuffles
def q_stream_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 over streams: headers and items arrive in three runs, some items long before their header, others after it was
    closed; header totals against item sums from the rows of the stream-stream join."""
    t = _tables(spark, sf_dir)
    keys = ("ide_serie", "ide_nNF")
    root = f"{checkpoint_dir(spark)}/fiscalflow-reconcile/{uuid.uuid4().hex}"
    day = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("event_time"))
    notas = star.notas(t, with_key=False, with_issuer=False).select(
        *keys, F.to_timestamp(F.substring("ide_dhEmi", 1, 10)).alias("event_time"), "total_vProd", "total_vDesc", "total_vTotTrib", "total_vNF", "o_orderstatus")
    itens = star.itens(t, with_product=False).join(day, "l_orderkey", "left").select(
        F.col("serie").alias("ide_serie"), F.col("nNF").alias("ide_nNF"), "nItem", "event_time", "vProd", "vDesc", "vTotTrib")
    notas, itens = _saved(notas, f"{root}/made"), _saved(itens, f"{root}/made")
    runs = (("o_orderstatus <> 'P'", "nItem > 3", None), ("o_orderstatus = 'P'", "nItem = 2", "1996-01-01 00:00:00"),
            ("false", "nItem in (1, 3)", "2100-01-01 00:00:00"))
    for heads, items, until in runs:
        notas.where(heads).drop("o_orderstatus").write.mode("append").parquet(f"{root}/headers")
        itens.where(items).write.mode("append").parquet(f"{root}/items")
        streams = [spark.readStream.schema(df.schema).parquet(f"{root}/{name}").select("*", place_in_file().alias("place"))
                   for name, df in (("headers", notas.drop("o_orderstatus")), ("items", itens))]
        reconcile_available(spark, *streams, f"{root}/out", f"{root}/checkpoint", keys=keys, number="place", until=until)
    out = _kept(reconciled(spark, f"{root}/out", keys))
    remove_folder(spark, root)
    return out


@frees_shuffles
def q_incremental_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E5 incremental: all invoices published, published again, then those of status P published with another state,
    a higher value and no items; the reports as kept by the state, in long form."""
    t = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/fiscalflow-incremental/{uuid.uuid4().hex}"
    log, state = FileLog(f"{root}/log"), ReportState(f"{root}/state", buckets=16)
    rec = _saved(star.records(t, extra=("o_orderstatus",)), f"{root}/made")
    r = F.col("nfe")
    address = r.getField("emit").getField("endereco").withField("UF", F.lit("XX"))
    higher = (r.getField("total").getField("vNF").cast("decimal(18,2)") + 1).cast("string")
    changed = (r.withField("emit", r.getField("emit").withField("endereco", address))
               .withField("total", r.getField("total").withField("vNF", higher))
               .withField("itens", F.slice(r.getField("itens"), 1, 0)))
    third = rec.where("o_orderstatus = 'P'").select(changed.alias("nfe"))
    for batch, some in enumerate((rec, rec, third)):
        log.write(records.to_messages(some), batch=batch)
        persist_available(spark, log, f"{root}/tables", f"{root}/checkpoint", state=state)
    state.compact(spark)
    long = []
    for name, group, values in _LONG_REPORTS:
        df = state.report(spark, name)
        long.append(df.select(F.lit(name).alias("report"), F.concat_ws("|", *group).alias("grp"),
                               *[(F.col(v) if v else F.lit(None)).cast("double").alias(f"v{i}") for i, v in enumerate(values)]))
    out = _kept(reduce(DataFrame.union, long))
    remove_folder(spark, root)
    return out


# (report, columns of the group, values) of the long form
_LONG_REPORTS = (
    ("notas_por_uf", ("uf_emitente",), ("total_notas", "valor_total", "valor_medio", None)),
    ("faturamento_emitente", ("cnpj_emitente", "nome_emitente", "fantasia_emitente", "uf_emitente"),
     ("total_notas", "valor_produtos", "valor_total_nf", "valor_total_tributos")),
    ("produtos_mais_vendidos", ("codigo_produto", "descricao_produto", "unidade"), ("qtd_vendas", "quantidade_total", "valor_total", "preco_medio_unitario")),
    ("tributos_por_nota", ("chave_nfe", "numero_nf", "emitente"), ("valor_nota", "valor_icms", "valor_total_tributos", "percentual_tributos")),
    ("valor_medio_mensal", ("ano_mes",), ("total_notas", "valor_total", "valor_minimo", "valor_maximo")),
)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "notas_por_uf": q_notas_por_uf,
    "faturamento_emitente": q_faturamento_emitente,
    "produtos_mais_vendidos": q_produtos_mais_vendidos,
    "tributos_por_nota": q_tributos_por_nota,
    "valor_medio_mensal": q_valor_medio_mensal,
    "json_encode_parse_itens": q_json_encode_parse_itens,
    "json_parse_notas": q_json_parse_notas,
    "xml_roundtrip_itens": q_xml_roundtrip_itens,
    "access_key_parts": q_access_key_parts,
    "access_key_check_digit": q_access_key_check_digit,
    "totals_reconciliation": q_totals_reconciliation,
    "uf_lookup_check": q_uf_lookup_check,
    "key_protocol_check": q_key_protocol_check,
    "item_tax_rate": q_item_tax_rate,
    "latest_by_key": q_latest_by_key,
    "event_props_json": q_event_props_json,
    "guarded_cast": q_guarded_cast,
    "missing_block_defaults": q_missing_block_defaults,
    "table_counts": q_table_counts,
    "stream_available_now": q_stream_available_now,
    "xml_rejects": q_xml_rejects,
    "republish_latest": q_republish_latest,
    "topic_snapshots": q_topic_snapshots,
    "binary_messages": q_binary_messages,
    "persisted_notas_por_uf": q_persisted_notas_por_uf,
    "incremental_persist_latest": q_incremental_persist_latest,
    "incremental_reports": q_incremental_reports,
    "bucketed_issuer_check": q_bucketed_issuer_check,
    "parts_persist": q_parts_persist,
    "persisted_notas": q_persisted_notas,
    "persisted_itens": q_persisted_itens,
    "persisted_rejects": q_persisted_rejects,
    "report_job": q_report_job,
    "report_ranks": q_report_ranks,
    "ctas_and_drop": q_ctas_and_drop,
    "xml_files_ingest": q_xml_files_ingest,
    "xml_single_files": q_xml_single_files,
    "audit_table": q_audit_table,
    "stream_persist_rejects": q_stream_persist_rejects,
    "stream_latest_state": q_stream_latest_state,
    "stream_reconciliation": q_stream_reconciliation,
}

"""Invoice records: XML document -> nested record -> JSON message, and back to XML.

``document_to_record`` is the distributed form of the reference's per-file parser
(P1-P7): struct field access with the same defaults -- missing or empty text gives
``""`` (N1), a missing ``ICMSTot`` gives ``"0.00"`` for every total while a missing
child of a present block gives ``""`` (N2), missing ``emit``/``dest``/address/protocol
give ``""`` (N3), an item without ``imposto`` has no ``vTotTrib`` (N10).  Everything is
a Column expression: one projection, no UDF, runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INVOICE_NAMESPACE, KEY_PREFIX, LAYOUT_VERSION, MISSING_TOTAL_DEFAULT
from ..functions.text import block_text, strip_literal, text_or_empty
from ..schemas import ADDRESS_FIELDS, DEST_FIELDS, EMIT_FIELDS, IDE_FIELDS, PROD_FIELDS, PROT_FIELDS, TOTAL_FIELDS

DOC = "doc"          # column holding the parsed XML document (schemas.XML_SCHEMA)
XML_WRITE_OPTIONS = {"rowTag": "nfeProc", "indent": ""}   # compact text: 40% faster to write
RECORD = "nfe"       # column holding the invoice record (schemas.INVOICE_SCHEMA)


def _address(block: Column, name: str) -> Column:
    addr = block.getField(name)
    return F.struct(*[
        F.when(block.isNull() | addr.isNull(), F.lit("")).otherwise(text_or_empty(addr.getField(f))).alias(f)
        for f in ADDRESS_FIELDS
    ])


def _item(d: Column) -> Column:
    prod, imposto = d.getField("prod"), d.getField("imposto")
    fields = [text_or_empty(d.getField("_nItem")).alias("nItem")]
    fields += [block_text(prod, f).alias(f) for f in PROD_FIELDS]
    # no imposto block -> no vTotTrib value (dropped from the JSON text, N10)
    fields.append(F.when(imposto.isNull(), F.lit(None).cast("string"))
                  .otherwise(text_or_empty(imposto.getField("vTotTrib"))).alias("vTotTrib"))
    return F.struct(*fields)


def document_to_record(doc: Column) -> Column:
    """Parsed ``nfeProc`` document -> invoice record struct (``INVOICE_SCHEMA``)."""
    inf = doc.getField("NFe").getField("infNFe")
    ide, emit, dest = inf.getField("ide"), inf.getField("emit"), inf.getField("dest")
    icms = inf.getField("total").getField("ICMSTot")
    prot = doc.getField("protNFe").getField("infProt")
    return F.struct(
        strip_literal(text_or_empty(inf.getField("_Id")), KEY_PREFIX).alias("chNFe"),
        text_or_empty(inf.getField("_versao")).alias("versao"),
        F.struct(*[text_or_empty(ide.getField(f)).alias(f) for f in IDE_FIELDS]).alias("ide"),
        F.struct(*[block_text(emit, f).alias(f) for f in EMIT_FIELDS],
                 _address(emit, "enderEmit").alias("endereco")).alias("emit"),
        F.struct(*[block_text(dest, f).alias(f) for f in DEST_FIELDS],
                 _address(dest, "enderDest").alias("endereco")).alias("dest"),
        F.coalesce(F.transform(inf.getField("det"), _item), F.array()).alias("itens"),
        F.struct(*[block_text(icms, f, MISSING_TOTAL_DEFAULT).alias(f) for f in TOTAL_FIELDS]).alias("total"),
        F.struct(*[block_text(prot, f).alias(f) for f in PROT_FIELDS]).alias("protocolo"),
    )


def document_items(doc: Column) -> Column:
    """Parsed document -> ``(chNFe, ide.nNF, itens)``: the item-path record (the shape
    of ``schemas.ITEM_PATH_SCHEMA``), enough for :func:`normalize.itens`.  Works on the
    full or the narrow (``XML_ITEM_SCHEMA``) parse."""
    inf = doc.getField("NFe").getField("infNFe")
    return F.struct(
        strip_literal(text_or_empty(inf.getField("_Id")), KEY_PREFIX).alias("chNFe"),
        F.struct(text_or_empty(inf.getField("ide").getField("nNF")).alias("nNF")).alias("ide"),
        F.coalesce(F.transform(inf.getField("det"), _item), F.array()).alias("itens"),
    )


def reject_reason(doc: Column, corrupt: Column) -> Column:
    """Why a document cannot become a record, or NULL when it can."""
    inf = doc.getField("NFe").getField("infNFe")
    det = inf.getField("det")
    return (
        F.when(corrupt.isNotNull(), F.lit("malformed"))
        .when(doc.getField("NFe").isNull() | inf.isNull(), F.lit("no_invoice"))
        .when(inf.getField("ide").isNull(), F.lit("missing_ide"))
        .when(strip_literal(text_or_empty(inf.getField("_Id")), KEY_PREFIX) == "", F.lit("missing_key"))
        .when(F.coalesce(F.exists(det, lambda d: d.getField("prod").isNull()), F.lit(False)), F.lit("item_without_prod"))
    )


def to_messages(records: DataFrame, record: str = RECORD, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key = chNFe, value = JSON text)`` and the columns ``keep`` per record.

    ``to_json`` keeps non-ASCII text as UTF-8 and drops NULL fields, which is how an
    item without ``imposto`` loses its ``vTotTrib`` key (N10, N18).
    """
    r = F.col(record)
    return records.select(r.getField("chNFe").alias("key"), F.to_json(r).alias("value"), *keep)


# --- record -> XML document (the XML sink; inverse of document_to_record) ---------------


def record_to_document(rec: Column) -> Column:
    """Invoice record -> struct in the ``nfeProc`` layout, ready for ``to_xml``."""
    e, d, t, p = (rec.getField(x) for x in ("emit", "dest", "total", "protocolo"))

    def det(i: Column) -> Column:
        return F.struct(
            i.getField("nItem").alias("_nItem"),
            F.struct(*[i.getField(f).alias(f) for f in PROD_FIELDS]).alias("prod"),
            F.when(i.getField("vTotTrib").isNull(), F.lit(None))
            .otherwise(F.struct(i.getField("vTotTrib").alias("vTotTrib"))).alias("imposto"),
        )

    inf = F.struct(
        F.concat(F.lit(KEY_PREFIX), rec.getField("chNFe")).alias("_Id"),
        rec.getField("versao").alias("_versao"),
        rec.getField("ide").alias("ide"),
        F.struct(*[e.getField(f).alias(f) for f in EMIT_FIELDS],
                 e.getField("endereco").alias("enderEmit")).alias("emit"),
        F.struct(*[d.getField(f).alias(f) for f in DEST_FIELDS],
                 d.getField("endereco").alias("enderDest")).alias("dest"),
        F.transform(rec.getField("itens"), det).alias("det"),
        F.struct(t.alias("ICMSTot")).alias("total"),
    )
    return F.struct(
        F.lit(INVOICE_NAMESPACE).alias("_xmlns"),
        F.lit(LAYOUT_VERSION).alias("_versao"),
        F.struct(inf.alias("infNFe")).alias("NFe"),
        F.struct(F.struct(rec.getField("chNFe").alias("chNFe"),
                          *[p.getField(f).alias(f) for f in PROT_FIELDS]).alias("infProt")).alias("protNFe"),
    )


def to_xml_text(records: DataFrame, record: str = RECORD) -> DataFrame:
    """``(key, xml)`` per record: one ``nfeProc`` document per invoice."""
    doc = record_to_document(F.col(record))
    return records.select(F.col(record).getField("chNFe").alias("key"),
                          F.to_xml(doc, XML_WRITE_OPTIONS).alias("xml"))

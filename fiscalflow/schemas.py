"""Schemas of every layer: XML read schema, JSON message schema, flat tables.

All message leaves are strings (money, counts and dates included); typing happens
when the flat tables are projected.  The flat tables are described by column maps
(output name, path in the parsed message, target type) so that the projection is
data, not 40 hand-written lines.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S) for n in names]


IDE_FIELDS = ("cUF", "cNF", "natOp", "mod", "serie", "nNF", "dhEmi", "dhSaiEnt", "tpNF", "cMunFG")
ADDRESS_FIELDS = ("xLgr", "nro", "xBairro", "cMun", "xMun", "UF", "CEP")
EMIT_FIELDS = ("CNPJ", "xNome", "xFant", "IE", "CRT")
DEST_FIELDS = ("CPF", "CNPJ", "xNome")
PROD_FIELDS = ("cProd", "xProd", "NCM", "CFOP", "uCom", "qCom", "vUnCom", "vProd", "vDesc")
TOTAL_FIELDS = (
    "vBC", "vICMS", "vICMSDeson", "vBCST", "vST", "vProd", "vFrete", "vSeg",
    "vDesc", "vII", "vIPI", "vPIS", "vCOFINS", "vOutro", "vNF", "vTotTrib",
)
PROT_FIELDS = ("nProt", "dhRecbto", "cStat")

ADDRESS = T.StructType(_strings(*ADDRESS_FIELDS))

# ---------------------------------------------------------------------------
# JSON message (one invoice) -- every leaf a string
# ---------------------------------------------------------------------------
ITEM_RECORD = T.StructType(_strings("nItem", *PROD_FIELDS, "vTotTrib"))

INVOICE_SCHEMA = T.StructType(
    _strings("chNFe", "versao")
    + [
        T.StructField("ide", T.StructType(_strings(*IDE_FIELDS))),
        T.StructField("emit", T.StructType(_strings(*EMIT_FIELDS) + [T.StructField("endereco", ADDRESS)])),
        T.StructField("dest", T.StructType(_strings(*DEST_FIELDS) + [T.StructField("endereco", ADDRESS)])),
        T.StructField("itens", T.ArrayType(ITEM_RECORD)),
        T.StructField("total", T.StructType(_strings(*TOTAL_FIELDS))),
        T.StructField("protocolo", T.StructType(_strings(*PROT_FIELDS))),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# Parse schema with a slot for text that is not valid JSON (rejects, N8).
INVOICE_PARSE_SCHEMA = T.StructType(INVOICE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, S)])

# Narrow parse schema for the item path: only what the item table needs.
ITEM_PATH_SCHEMA = T.StructType(
    _strings("chNFe")
    + [
        T.StructField("ide", T.StructType(_strings("nNF"))),
        T.StructField("itens", T.ArrayType(ITEM_RECORD)),
    ]
)

# ---------------------------------------------------------------------------
# XML document (root element nfeProc), attributes prefixed with "_"
# ---------------------------------------------------------------------------
XML_DET = T.StructType(
    [
        T.StructField("_nItem", S),
        T.StructField("prod", T.StructType(_strings(*PROD_FIELDS))),
        T.StructField("imposto", T.StructType(_strings("vTotTrib"))),
    ]
)

XML_INF_NFE = T.StructType(
    _strings("_Id", "_versao")
    + [
        T.StructField("ide", T.StructType(_strings(*IDE_FIELDS))),
        T.StructField("emit", T.StructType(_strings(*EMIT_FIELDS) + [T.StructField("enderEmit", ADDRESS)])),
        T.StructField("dest", T.StructType(_strings(*DEST_FIELDS) + [T.StructField("enderDest", ADDRESS)])),
        T.StructField("det", T.ArrayType(XML_DET)),
        T.StructField("total", T.StructType([T.StructField("ICMSTot", T.StructType(_strings(*TOTAL_FIELDS)))])),
    ]
)

XML_SCHEMA = T.StructType(
    [
        T.StructField("_versao", S),
        T.StructField("NFe", T.StructType([T.StructField("infNFe", XML_INF_NFE)])),
        T.StructField(
            "protNFe",
            T.StructType([T.StructField("infProt", T.StructType(_strings("chNFe", *PROT_FIELDS)))]),
        ),
        T.StructField(CORRUPT_COLUMN, S),
    ]
)

# Narrow XML read schema for item-only consumers: key, note number and items.  The
# parser skips everything else, about a third faster than the full schema.
XML_ITEM_SCHEMA = T.StructType(
    [
        T.StructField("NFe", T.StructType([T.StructField("infNFe", T.StructType(
            _strings("_Id")
            + [
                T.StructField("ide", T.StructType(_strings("nNF"))),
                T.StructField("det", T.ArrayType(XML_DET)),
            ]
        ))])),
        T.StructField(CORRUPT_COLUMN, S),
    ]
)

# Narrow XML read schema for reject routing only (R6): what the reject reasons test.
XML_CHECK_SCHEMA = T.StructType(
    [
        T.StructField("NFe", T.StructType([T.StructField("infNFe", T.StructType(
            _strings("_Id")
            + [
                T.StructField("ide", T.StructType(_strings("nNF"))),
                T.StructField("det", T.ArrayType(T.StructType([
                    T.StructField("prod", T.StructType(_strings("cProd")))]))),
            ]
        ))])),
        T.StructField(CORRUPT_COLUMN, S),
    ]
)

# Narrow XML read schema for the key/protocol check.
XML_PROTOCOL_SCHEMA = T.StructType(
    [
        T.StructField("NFe", T.StructType([T.StructField("infNFe", T.StructType(_strings("_Id")))])),
        T.StructField("protNFe", T.StructType([T.StructField("infProt", T.StructType(_strings("chNFe", "cStat")))])),
        T.StructField(CORRUPT_COLUMN, S),
    ]
)

# ---------------------------------------------------------------------------
# Flat tables: (column, path in the parsed message, type)
# ---------------------------------------------------------------------------
NOTAS_COLUMNS: tuple[tuple[str, str, str], ...] = (
    ("chNFe", "chNFe", "string"),
    ("versao", "versao", "string"),
    *((f"ide_{f}", f"ide.{f}", "string") for f in ("cUF", "nNF", "natOp", "serie", "dhEmi", "dhSaiEnt", "tpNF", "cMunFG")),
    *((f"emit_{f}", f"emit.{f}", "string") for f in EMIT_FIELDS),
    ("emit_xMun", "emit.endereco.xMun", "string"),
    ("emit_UF", "emit.endereco.UF", "string"),
    *((f"dest_{f}", f"dest.{f}", "string") for f in DEST_FIELDS),
    ("dest_xMun", "dest.endereco.xMun", "string"),
    ("dest_UF", "dest.endereco.UF", "string"),
    *((f"total_{f}", f"total.{f}", "double")
      for f in ("vBC", "vICMS", "vProd", "vFrete", "vDesc", "vPIS", "vCOFINS", "vNF", "vTotTrib")),
    *((f"prot_{f}", f"protocolo.{f}", "string") for f in PROT_FIELDS),
)

ITENS_COLUMNS: tuple[tuple[str, str, str], ...] = (
    ("nItem", "item.nItem", "int"),
    ("cProd", "item.cProd", "string"),
    ("xProd", "item.xProd", "string"),
    ("NCM", "item.NCM", "string"),
    ("CFOP", "item.CFOP", "string"),
    ("uCom", "item.uCom", "string"),
    ("qCom", "item.qCom", "double"),
    ("vUnCom", "item.vUnCom", "double"),
    ("vProd", "item.vProd", "double"),
    ("vDesc", "item.vDesc", "double"),
    ("vTotTrib", "item.vTotTrib", "double"),
)


def ddl(columns: tuple[tuple[str, str, str], ...]) -> str:
    return ", ".join(f"{name} {typ}" for name, _, typ in columns)


NOTAS_DDL = ddl(NOTAS_COLUMNS)
ITENS_DDL = "chNFe string, nNF string, " + ddl(ITENS_COLUMNS)

# Message log row (what a Kafka source supplies, plus the writing batch).
MESSAGE_LOG_DDL = (
    "key string, value string, topic string, partition int, offset bigint, "
    "timestamp timestamp, batch bigint"
)

"""Invoice frames derived from the star-schema test tables.

Mapping (one fixed rule, used by every registered query):

* note (invoice header)  = one ``orders`` row
* issuer                 = the order's ``customer``; CNPJ = custkey padded to 14 digits,
                           name = ``c_name``, trade name = ``c_mktsegment``
* issuer state (UF)      = the customer's ``nation.n_name``; state code = nation key
* emission time          = ``o_orderdate`` written as local ISO-8601 with ``-03:00``
* vNF                    = ``o_totalprice``
* item                   = one ``lineitem`` row with its ``part``: cProd = partkey,
                           xProd = ``p_name``, uCom = ``p_type``, qCom = ``l_quantity``,
                           vUnCom = ``p_retailprice``, vProd = ``l_extendedprice``,
                           vDesc = extprice x discount, vTotTrib = extprice x tax
                           (both rounded half-up to cents)
* note totals vProd / vDesc / vTotTrib = sums over the note's items (0 without items)
* serie / nNF            = orderkey split at 10^9 (so keys stay 9 digits at any scale)

Joins go through :func:`lookup_join`: ``nation`` is broadcast after a size check; the
large dimensions (``customer``, ``part``) are shuffle-joined and AQE splits hot keys.
Item totals are aggregated per order *before* they meet ``orders`` (combinable
partial aggregation, so a hot order collapses map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AUTHORIZED_STATUS, CFOP_SALE, EMISSION_NORMAL, LAYOUT_VERSION, MODEL_NFE, NAT_OP_SALE
from ..functions.keys import with_access_key
from ..functions.money import wide
from ..operators.joins import lookup_join

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

NNF_SPLIT = 1_000_000_000


class Tables:
    """Lazy access to the parquet tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]


def iso_local(ts: Column) -> Column:
    """Timestamp as written in an invoice: ``yyyy-MM-ddTHH:mm:ss-03:00``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00"))


def serie_of(orderkey: Column) -> Column:
    return (F.floor(orderkey / NNF_SPLIT) + 1).cast("long")


def nnf_of(orderkey: Column) -> Column:
    return F.pmod(orderkey, F.lit(NNF_SPLIT)).cast("long")


def cnf_of(orderkey: Column, custkey: Column) -> Column:
    """Deterministic 8-digit numeric code of a note."""
    return F.pmod(orderkey * 7919 + custkey * 104729, F.lit(100_000_000))


def add_access_key(df: DataFrame, cnf: Column | None = None) -> DataFrame:
    """Add ``chNFe`` to a frame holding order, customer and nation columns."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return with_access_key(
        df, "chNFe", F.col("c_nationkey"), F.date_format("o_orderdate", "yyMM"), ck, F.lit(MODEL_NFE),
        serie_of(ok), nnf_of(ok), F.lit(EMISSION_NORMAL), cnf_of(ok, ck) if cnf is None else cnf,
    )


def item_money(li: DataFrame) -> DataFrame:
    """Per-item cent amounts (exact decimals) next to the lineitem columns."""
    # a price of the source tables that is beyond 16 digits raises: it is never dropped
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.withColumn("_vprod", price).withColumn(
        "_vdesc", F.round(price * F.col("l_discount").cast("decimal(18,4)"), 2).cast("decimal(18,2)")
    ).withColumn("_vtrib", F.round(price * F.col("l_tax").cast("decimal(18,4)"), 2).cast("decimal(18,2)"))


def note_item_totals(t: Tables) -> DataFrame:
    """Per-order sums of item vProd / vDesc / vTotTrib (aggregated before any join)."""
    li = item_money(t["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount", "l_tax"))
    return li.groupBy("l_orderkey").agg(
        F.sum("_vprod").alias("_sum_vprod"),
        F.sum("_vdesc").alias("_sum_vdesc"),
        F.sum("_vtrib").alias("_sum_vtrib"),
    )


def issuers(t: Tables) -> DataFrame:
    """customer + its nation (the state); nation is broadcast after a size check."""
    c = t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup_join(c, n, on="c_nationkey", how="left")


def notas(t: Tables, with_item_totals: bool = True, with_key: bool = True, with_issuer: bool = True) -> DataFrame:
    """Invoice header frame (the ``nfe_notas`` columns the reports use).

    Every order is a note; issuer columns come from a LEFT join on the customer's
    primary key, so leaving them out (``with_issuer=False``, no key) drops the join
    without changing the rows.
    """
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    with_issuer = with_issuer or with_key
    hdr = o.join(issuers(t), o.o_custkey == F.col("c_custkey"), "left") if with_issuer else o
    if with_item_totals:
        tot = note_item_totals(t)
        hdr = hdr.join(tot, hdr.o_orderkey == tot.l_orderkey, "left")
        zero = F.lit(0).cast("decimal(28,2)")
        vprod = F.coalesce(F.col("_sum_vprod"), zero).cast("double")
        vdesc = F.coalesce(F.col("_sum_vdesc"), zero).cast("double")
        vtrib = F.coalesce(F.col("_sum_vtrib"), zero).cast("double")
    else:
        vprod = vdesc = vtrib = F.lit(None).cast("double")
    if with_key:
        hdr = add_access_key(hdr)
    key = F.col("chNFe") if with_key else F.lit(None).cast("string")

    def issuer(c: Column) -> Column:
        return c if with_issuer else F.lit(None).cast("string")

    return hdr.select(
        key.alias("chNFe"),
        F.lit(LAYOUT_VERSION).alias("versao"),
        issuer(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("ide_cUF"),
        nnf_of(F.col("o_orderkey")).cast("string").alias("ide_nNF"),
        F.lit(NAT_OP_SALE).alias("ide_natOp"),
        serie_of(F.col("o_orderkey")).cast("string").alias("ide_serie"),
        iso_local(F.col("o_orderdate")).alias("ide_dhEmi"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("emit_CNPJ"),
        issuer(F.col("c_name")).alias("emit_xNome"),
        issuer(F.col("c_mktsegment")).alias("emit_xFant"),
        issuer(F.col("n_name")).alias("emit_UF"),
        vprod.alias("total_vProd"),
        vdesc.alias("total_vDesc"),
        F.lit(0.0).alias("total_vICMS"),
        F.lit(0.0).alias("total_vPIS"),
        F.lit(0.0).alias("total_vCOFINS"),
        F.col("o_totalprice").alias("total_vNF"),
        vtrib.alias("total_vTotTrib"),
        F.lit(AUTHORIZED_STATUS).alias("prot_cStat"),
        "o_orderstatus",
    )


def itens(t: Tables, with_product: bool = True) -> DataFrame:
    """Invoice item frame (the ``nfe_itens`` columns the reports use), without the key.

    Every lineitem is an item; product columns come from a LEFT join on the part's
    primary key, skipped with ``with_product=False``.
    """
    li = item_money(t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    if with_product:
        p = t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice")
        li = li.join(p, on="l_partkey", how="left")

    def product(name: str, typ: str = "string") -> Column:
        return F.col(name) if with_product else F.lit(None).cast(typ)

    return li.select(
        serie_of(F.col("l_orderkey")).cast("string").alias("serie"),
        nnf_of(F.col("l_orderkey")).cast("string").alias("nNF"),
        F.col("l_linenumber").alias("nItem"),
        F.col("l_partkey").cast("string").alias("cProd"),
        product("p_name").alias("xProd"),
        F.lit(CFOP_SALE).alias("CFOP"),
        product("p_type").alias("uCom"),
        F.col("l_quantity").alias("qCom"),
        product("p_retailprice", "double").alias("vUnCom"),
        F.col("_vprod").cast("double").alias("vProd"),
        F.col("_vdesc").cast("double").alias("vDesc"),
        F.col("_vtrib").cast("double").alias("vTotTrib"),
        F.col("l_orderkey"),
    )


# --- nested invoice records (the message shape) -------------------------------------

def _s(c: Column) -> Column:
    return c.cast("string")


def money(name: str) -> Column:
    """Amount as written in a message: all its places, or the number as it is if it is too large."""
    return F.coalesce(_s(wide(name)), _s(F.col(name)))


def _item_struct() -> Column:
    return F.struct(
        _s(F.col("l_linenumber")).alias("nItem"),
        _s(F.col("l_partkey")).alias("cProd"),
        F.col("p_name").alias("xProd"),
        F.lit("").alias("NCM"),
        F.lit(CFOP_SALE).alias("CFOP"),
        F.col("p_type").alias("uCom"),
        _s(money("l_quantity")).alias("qCom"),
        _s(money("p_retailprice")).alias("vUnCom"),
        _s(F.col("_vprod")).alias("vProd"),
        _s(F.col("_vdesc")).alias("vDesc"),
        _s(F.col("_vtrib")).alias("vTotTrib"),
    )


def item_records(t: Tables) -> DataFrame:
    """``(chNFe, item)``: a row for each item, as it stands in a record, with the key of its note."""
    li = item_money(t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    p = t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice")
    li = li.join(p, on="l_partkey", how="left").select("l_orderkey", _item_struct().alias("item"))
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    keys = add_access_key(o.join(issuers(t), o.o_custkey == F.col("c_custkey"), "left")).select("o_orderkey", "chNFe")
    return li.join(keys, li.l_orderkey == keys.o_orderkey).select("chNFe", "item")


def item_groups(t: Tables) -> DataFrame:
    """Items of each order as a list: ``(l_orderkey, itens, sums)``.

    An invoice is one message that holds all its items, as in the reference, so the list
    is as long as the invoice.  Item rows are shuffled by order first: the lists are then
    built once on the reduce side instead of being built map-side and shuffled as arrays.
    """
    li = item_money(t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    p = t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice")
    li = li.join(p, on="l_partkey", how="left").repartition("l_orderkey")
    return li.groupBy("l_orderkey").agg(
        F.collect_list(_item_struct()).alias("itens"),
        F.sum("_vprod").alias("_sum_vprod"),
        F.sum("_vdesc").alias("_sum_vdesc"),
        F.sum("_vtrib").alias("_sum_vtrib"),
    )


def records(t: Tables, with_items: bool = True, extra: tuple[str, ...] = (),
            orders: DataFrame | None = None) -> DataFrame:
    """One nested invoice record (``INVOICE_SCHEMA``) per order, the note of :func:`notas`.

    ``with_items=False`` leaves ``itens`` NULL and takes the totals from the per-order
    item sums (no item lists are collected).  ``extra`` carries order columns along.
    ``orders`` replaces the orders table, e.g. by a streaming read of it.
    """
    o = (t["orders"] if orders is None else orders).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", *extra)
    hdr = o.join(issuers(t), o.o_custkey == F.col("c_custkey"), "left")
    if with_items:
        g = item_groups(t)
    else:
        g = note_item_totals(t).withColumn("itens", F.lit(None).cast(
            "array<struct<nItem:string,cProd:string,xProd:string,NCM:string,CFOP:string,uCom:string,"
            "qCom:string,vUnCom:string,vProd:string,vDesc:string,vTotTrib:string>>"))
    j = hdr.join(g, hdr.o_orderkey == g.l_orderkey, "left")
    zero = F.lit(0).cast("decimal(28,2)")
    vprod = F.coalesce(F.col("_sum_vprod"), zero)
    vdesc = F.coalesce(F.col("_sum_vdesc"), zero)
    vtrib = F.coalesce(F.col("_sum_vtrib"), zero)
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    cnf = cnf_of(ok, ck)
    j = add_access_key(j)
    key = F.col("chNFe")
    dh = iso_local(F.col("o_orderdate"))
    empty = F.lit("")
    addr = lambda uf: F.struct(*[empty.alias(f) for f in ("xLgr", "nro", "xBairro", "cMun", "xMun")],
                               uf.alias("UF"), empty.alias("CEP"))
    zero_s = F.lit("0.00")
    total = F.struct(
        zero_s.alias("vBC"), zero_s.alias("vICMS"), zero_s.alias("vICMSDeson"), zero_s.alias("vBCST"),
        zero_s.alias("vST"), _s(vprod).alias("vProd"), zero_s.alias("vFrete"), zero_s.alias("vSeg"),
        _s(vdesc).alias("vDesc"), zero_s.alias("vII"), zero_s.alias("vIPI"), zero_s.alias("vPIS"),
        zero_s.alias("vCOFINS"), zero_s.alias("vOutro"), _s(money("o_totalprice")).alias("vNF"), _s(vtrib).alias("vTotTrib"),
    )
    rec = F.struct(
        key.alias("chNFe"),
        F.lit(LAYOUT_VERSION).alias("versao"),
        F.struct(
            F.lpad(_s(F.col("c_nationkey")), 2, "0").alias("cUF"), F.lpad(_s(cnf), 8, "0").alias("cNF"),
            F.lit(NAT_OP_SALE).alias("natOp"), F.lit(MODEL_NFE).alias("mod"), _s(serie_of(ok)).alias("serie"),
            _s(nnf_of(ok)).alias("nNF"), dh.alias("dhEmi"), dh.alias("dhSaiEnt"), F.lit("1").alias("tpNF"),
            empty.alias("cMunFG"),
        ).alias("ide"),
        F.struct(
            F.lpad(_s(ck), 14, "0").alias("CNPJ"), F.col("c_name").alias("xNome"),
            F.col("c_mktsegment").alias("xFant"), empty.alias("IE"), F.lit("1").alias("CRT"),
            addr(F.col("n_name")).alias("endereco"),
        ).alias("emit"),
        F.struct(empty.alias("CPF"), empty.alias("CNPJ"), empty.alias("xNome"), addr(empty).alias("endereco")).alias("dest"),
        F.col("itens").alias("itens"),
        total.alias("total"),
        F.struct(F.lpad(_s(ok), 15, "0").alias("nProt"), dh.alias("dhRecbto"),
                 F.lit(AUTHORIZED_STATUS).alias("cStat")).alias("protocolo"),
    )
    return j.select(rec.alias("nfe"), *extra)

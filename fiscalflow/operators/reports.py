"""The five reports (E1-E5) as pure functions ``(notas | itens) -> DataFrame``.

Column names and meanings follow the reference's result tables.  Money is summed as
decimals, rounded once after the sum, and averages/percentages are rounded half-up exactly (see
``fiscalflow.functions.money``), so results do not depend on partitioning.

``sort`` keeps the reference's ORDER BY.  A table written from a sorted frame has no
order on read (N14), so the persist pipeline writes unsorted and sorts at read time;
for the two per-note/per-issuer reports the sort is a distributed range sort, never a
single task.  The top-k report (E3) always sorts: the limit is its feature, and the
tie-break keys make its 20 rows deterministic (N13).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money_avg, money_max, money_min, money_sum, percent_of, wide

TOP_PRODUCTS = 20


def notas_por_uf(notas: DataFrame, sort: bool = True) -> DataFrame:
    """Notes per issuer state -- count, total and average value."""
    out = notas.groupBy(F.col("emit_UF").alias("uf_emitente")).agg(
        F.count(F.lit(1)).alias("total_notas"),
        money_sum("total_vNF").alias("valor_total"),
        money_avg("total_vNF").alias("valor_medio"),
    )
    return out.orderBy(F.desc("total_notas"), "uf_emitente") if sort else out


def faturamento_emitente(notas: DataFrame, sort: bool = True) -> DataFrame:
    """Revenue per issuer (CNPJ, name, trade name, state)."""
    out = notas.groupBy(
        F.col("emit_CNPJ").alias("cnpj_emitente"),
        F.col("emit_xNome").alias("nome_emitente"),
        F.col("emit_xFant").alias("fantasia_emitente"),
        F.col("emit_UF").alias("uf_emitente"),
    ).agg(
        F.count(F.lit(1)).alias("total_notas"),
        money_sum("total_vProd").alias("valor_produtos"),
        money_sum("total_vNF").alias("valor_total_nf"),
        money_sum("total_vTotTrib").alias("valor_total_tributos"),
    )
    return out.orderBy(F.desc("valor_total_nf"), "cnpj_emitente") if sort else out


def produtos_mais_vendidos(itens: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Top-k products by quantity, ties broken by the group keys.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each partition keeps
    its own k best rows, so no full sort and no single large task.
    """
    agg = itens.groupBy(
        F.col("cProd").alias("codigo_produto"),
        F.col("xProd").alias("descricao_produto"),
        F.col("uCom").alias("unidade"),
    ).agg(
        F.count(F.lit(1)).alias("qtd_vendas"),
        money_sum("qCom", 4).alias("_qty"),
        money_sum("vProd").alias("valor_total"),
        money_avg("vUnCom").alias("preco_medio_unitario"),
    )
    top = agg.orderBy(F.desc("_qty"), "codigo_produto", "descricao_produto", "unidade").limit(k)
    return top.select(
        "codigo_produto", "descricao_produto", "unidade", "qtd_vendas",
        F.col("_qty").alias("quantidade_total"), "valor_total", "preco_medio_unitario",
    )


def tributos_por_nota(notas: DataFrame, sort: bool = True) -> DataFrame:
    """Taxes per note with the guarded tax percentage."""
    out = notas.select(
        F.col("chNFe").alias("chave_nfe"),
        F.col("ide_nNF").alias("numero_nf"),
        F.col("emit_xNome").alias("emitente"),
        F.col("total_vNF").alias("valor_nota"),
        F.col("total_vICMS").alias("valor_icms"),
        F.col("total_vPIS").alias("valor_pis"),
        F.col("total_vCOFINS").alias("valor_cofins"),
        F.col("total_vTotTrib").alias("valor_total_tributos"),
        percent_of("total_vTotTrib", "total_vNF").alias("percentual_tributos"),
    )
    return out.orderBy(F.desc("valor_total_tributos"), "chave_nfe") if sort else out


def valor_medio_mensal(notas: DataFrame, sort: bool = True) -> DataFrame:
    """E5: value statistics per local emission month ``substring(dhEmi, 1, 7)``."""
    out = notas.groupBy(F.substring("ide_dhEmi", 1, 7).alias("ano_mes")).agg(
        F.count(F.lit(1)).alias("total_notas"),
        money_sum("total_vNF").alias("valor_total"),
        money_avg("total_vNF").alias("valor_medio"),
        money_min("total_vNF").alias("valor_minimo"),
        money_max("total_vNF").alias("valor_maximo"),
    )
    return out.orderBy("ano_mes") if sort else out


def conferencia_emitente(notas: DataFrame, itens: DataFrame) -> DataFrame:
    """E2 with R3: revenue per issuer from headers and from items, and the notes whose product total is not that of its items.

    Items are summed per note and joined to it by key; with both tables in buckets of the key, the sum
    per issuer is the only shuffle.
    """
    sums = itens.groupBy("chNFe").agg(F.count(F.lit(1)).alias("n"), F.sum(wide("vProd")).alias("itens"))
    n = notas.join(sums, "chNFe", "left")
    same = F.coalesce(wide("total_vProd"), F.lit(0)) == F.coalesce("itens", F.lit(0))
    return n.groupBy(F.col("emit_CNPJ").alias("cnpj_emitente")).agg(
        F.count(F.lit(1)).alias("total_notas"), F.sum(F.coalesce("n", F.lit(0))).alias("total_itens"),
        money_sum("total_vProd").alias("valor_notas"), F.round(F.coalesce(F.sum("itens"), F.lit(0)), 2).cast("double").alias("valor_itens"),
        F.sum(F.when(same, 0).otherwise(1)).alias("notas_divergentes"))


# name -> (result table, input table, function)
REPORTS: dict[str, tuple[str, str, Callable[..., DataFrame]]] = {
    "notas_por_uf": ("resultado_notas_por_uf", "notas", notas_por_uf),
    "faturamento_emitente": ("resultado_faturamento_emitente", "notas", faturamento_emitente),
    "produtos_mais_vendidos": ("resultado_produtos_mais_vendidos", "itens", produtos_mais_vendidos),
    "tributos_por_nota": ("resultado_tributos_por_nota", "notas", tributos_por_nota),
    "valor_medio_mensal": ("resultado_valor_medio_mensal", "notas", valor_medio_mensal),
}

# read-time order of each saved result table (N14): (column, descending)
REPORT_ORDER: dict[str, tuple[tuple[str, bool], ...]] = {
    "resultado_notas_por_uf": (("total_notas", True), ("uf_emitente", False)),
    "resultado_faturamento_emitente": (("valor_total_nf", True), ("cnpj_emitente", False)),
    "resultado_produtos_mais_vendidos": (
        ("quantidade_total", True), ("codigo_produto", False), ("descricao_produto", False), ("unidade", False)),
    "resultado_tributos_por_nota": (("valor_total_tributos", True), ("chave_nfe", False)),
    "resultado_valor_medio_mensal": (("ano_mes", False),),
}


def ordered(df: DataFrame, table: str) -> DataFrame:
    """A saved result table in the reference's order."""
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in REPORT_ORDER[table]])

"""DuckDB SQL for the registered queries (the independent correctness oracle).

The SQL repeats the star-schema mapping of ``fiscalflow.sources.star``.  Money is summed
as wide decimals and rounded after the sum; averages and percentages are rounded half-up
from the digits of the sum, as integers.
"""

from __future__ import annotations

from .constants import ACCESS_KEY_LAYOUT
from .functions.keys import BODY_LENGTH, weight

# --- exact money helpers ---------------------------------------------------------------


def dec(x: str, scale: int = 10) -> str:
    """Through text, so that a double keeps the places it was written with."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,{scale}))"


def money_sum(x: str, scale: int = 2) -> str:
    return f"CAST(ROUND(SUM({dec(x)}), {scale}) AS DOUBLE)"


def rounded_ratio(units: str, den: str, out_scale: int = 2) -> str:
    n = f"CAST({units} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    q = f"((2 * abs({n}) + {d}) // (2 * {d}))"
    return f"(CAST(sign({n}) * {q} AS DOUBLE) / {10 ** out_scale}.0)"


def money_avg(x: str, out_scale: int = 2) -> str:
    units = f"CAST(replace(CAST(SUM({dec(x)}) AS VARCHAR), '.', '') AS HUGEINT)"
    return f"(CASE WHEN COUNT({x}) > 0 THEN {rounded_ratio(units, f'(COUNT({x}) * {10 ** (10 - out_scale)})', out_scale)} END)"


def percent_of(part: str, whole: str, out_scale: int = 2) -> str:
    p, w = (f"CAST(replace(CAST({dec(x)} AS VARCHAR), '.', '') AS HUGEINT)" for x in (part, whole))
    pct = rounded_ratio(f"({p} * {100 * 10 ** out_scale})", w, out_scale)
    return f"(CASE WHEN {whole} > 0 THEN {pct} ELSE 0.0 END)"


# --- access key ------------------------------------------------------------------------


def check_digit(body: str) -> str:
    terms = " + ".join(f"TRY_CAST(substr({body}, {p}, 1) AS INTEGER) * {weight(p)}" for p in range(1, BODY_LENGTH + 1))
    r = f"(({terms}) % 11)"
    return f"(CASE WHEN length({body}) <> {BODY_LENGTH} THEN NULL WHEN {r} < 2 THEN 0 ELSE 11 - {r} END)"


def key_parts(key: str) -> list[str]:
    out, pos = [], 1
    for name, width in ACCESS_KEY_LAYOUT:
        out.append(f"substr({key}, {pos}, {width}) AS {name}")
        pos += width
    return out


def _lp(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


KEY_BODY = (
    f"{_lp('c_nationkey', 2)} || strftime(o_orderdate, '%y%m') || {_lp('o_custkey', 14)} || '55' || "
    f"{_lp('(o_orderkey // 1000000000 + 1)', 3)} || {_lp('(o_orderkey % 1000000000)', 9)} || '1' || "
    f"{_lp('((o_orderkey * 7919 + o_custkey * 104729) % 100000000)', 8)}"
)

# --- star-schema mapping ---------------------------------------------------------------

ITEM_MONEY = """
    CAST(l_extendedprice AS DECIMAL(18,2)) AS vprod,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS vdesc,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS vtrib"""

NOTE_TOTALS = f"""
  note_totals AS (
    SELECT l_orderkey, SUM(vprod) AS s_vprod, SUM(vdesc) AS s_vdesc, SUM(vtrib) AS s_vtrib
    FROM (SELECT l_orderkey, {ITEM_MONEY} FROM lineitem) GROUP BY l_orderkey)"""

NOTAS_BASE = """
  hdr AS (
    SELECT o.*, c_custkey, c_name, c_mktsegment, c_nationkey, n_name
    FROM orders o LEFT JOIN (customer LEFT JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey)"""


def notas_cte(with_item_totals: bool = True, with_key: bool = True, with_itens: bool = False) -> str:
    """``WITH`` clause defining ``notas`` exactly like ``star.notas``."""
    parts = [NOTAS_BASE]
    if with_item_totals:
        parts.append(NOTE_TOTALS)
        src = "hdr LEFT JOIN note_totals ON o_orderkey = l_orderkey"
        vprod = "CAST(COALESCE(s_vprod, 0) AS DOUBLE)"
        vdesc = "CAST(COALESCE(s_vdesc, 0) AS DOUBLE)"
        vtrib = "CAST(COALESCE(s_vtrib, 0) AS DOUBLE)"
    else:
        src = "hdr"
        vprod = vdesc = vtrib = "CAST(NULL AS DOUBLE)"
    key = f"body || CAST({check_digit('body')} AS VARCHAR)" if with_key else "CAST(NULL AS VARCHAR)"
    parts.append(f"""
  keyed AS (SELECT *, {KEY_BODY} AS body FROM {src}),
  notas AS (
    SELECT {key} AS chNFe, '3.10' AS versao, {_lp('c_nationkey', 2)} AS ide_cUF,
      CAST(o_orderkey % 1000000000 AS VARCHAR) AS ide_nNF, 'VENDA DE MERCADORIA' AS ide_natOp,
      CAST(o_orderkey // 1000000000 + 1 AS VARCHAR) AS ide_serie,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS ide_dhEmi,
      {_lp('o_custkey', 14)} AS emit_CNPJ, c_name AS emit_xNome, c_mktsegment AS emit_xFant,
      n_name AS emit_UF, {vprod} AS total_vProd, {vdesc} AS total_vDesc,
      0.0::DOUBLE AS total_vICMS, 0.0::DOUBLE AS total_vPIS, 0.0::DOUBLE AS total_vCOFINS,
      o_totalprice AS total_vNF, {vtrib} AS total_vTotTrib, '100' AS prot_cStat, o_orderstatus, o_orderpriority, o_orderkey
    FROM keyed)""")
    if with_itens:
        parts.append(ITENS_BODY)
    return "WITH " + ",".join(parts)


ITENS_BODY = f"""
  itens AS (
    SELECT CAST(l_orderkey // 1000000000 + 1 AS VARCHAR) AS serie,
      CAST(l_orderkey % 1000000000 AS VARCHAR) AS nNF, l_linenumber AS nItem,
      CAST(l_partkey AS VARCHAR) AS cProd, p_name AS xProd, '5102' AS CFOP, p_type AS uCom,
      l_quantity AS qCom, p_retailprice AS vUnCom,
      CAST(vprod AS DOUBLE) AS vProd, CAST(vdesc AS DOUBLE) AS vDesc, CAST(vtrib AS DOUBLE) AS vTotTrib,
      l_orderkey
    FROM (SELECT *, {ITEM_MONEY} FROM lineitem) li LEFT JOIN part ON l_partkey = p_partkey)"""
ITENS_CTE = "WITH " + ITENS_BODY

# --- the five reports ------------------------------------------------------------------

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["notas_por_uf"] = notas_cte(False, False) + f"""
SELECT emit_UF AS uf_emitente, COUNT(*) AS total_notas,
  {money_sum('total_vNF')} AS valor_total, {money_avg('total_vNF')} AS valor_medio
FROM notas GROUP BY emit_UF"""

ORACLE_SQL["faturamento_emitente"] = notas_cte(True, False) + f"""
SELECT emit_CNPJ AS cnpj_emitente, emit_xNome AS nome_emitente, emit_xFant AS fantasia_emitente,
  emit_UF AS uf_emitente, COUNT(*) AS total_notas,
  {money_sum('total_vProd')} AS valor_produtos, {money_sum('total_vNF')} AS valor_total_nf,
  {money_sum('total_vTotTrib')} AS valor_total_tributos
FROM notas GROUP BY emit_CNPJ, emit_xNome, emit_xFant, emit_UF"""

ORACLE_SQL["produtos_mais_vendidos"] = ITENS_CTE + f"""
SELECT cProd AS codigo_produto, xProd AS descricao_produto, uCom AS unidade, COUNT(*) AS qtd_vendas,
  {money_sum('qCom', 4)} AS quantidade_total, {money_sum('vProd')} AS valor_total,
  {money_avg('vUnCom')} AS preco_medio_unitario
FROM itens GROUP BY cProd, xProd, uCom
ORDER BY quantidade_total DESC, codigo_produto, descricao_produto, unidade
LIMIT 20"""

ORACLE_SQL["tributos_por_nota"] = notas_cte(True, True) + f"""
SELECT chNFe AS chave_nfe, ide_nNF AS numero_nf, emit_xNome AS emitente, total_vNF AS valor_nota,
  total_vICMS AS valor_icms, total_vPIS AS valor_pis, total_vCOFINS AS valor_cofins,
  total_vTotTrib AS valor_total_tributos, {percent_of('total_vTotTrib', 'total_vNF')} AS percentual_tributos
FROM notas"""

ORACLE_SQL["valor_medio_mensal"] = notas_cte(False, False) + f"""
SELECT substring(ide_dhEmi, 1, 7) AS ano_mes, COUNT(*) AS total_notas,
  {money_sum('total_vNF')} AS valor_total, {money_avg('total_vNF')} AS valor_medio,
  ROUND(MIN(total_vNF), 2) AS valor_minimo, ROUND(MAX(total_vNF), 2) AS valor_maximo
FROM notas GROUP BY substring(ide_dhEmi, 1, 7)"""

# --- message path round trips ----------------------------------------------------------

ITEM_OUT = "nNF, nItem, cProd, xProd, CFOP, uCom, qCom, vUnCom, vProd, vDesc, vTotTrib"

ORACLE_SQL["json_encode_parse_itens"] = ITENS_CTE + f"\nSELECT {ITEM_OUT} FROM itens"
ORACLE_SQL["xml_roundtrip_itens"] = ITENS_CTE + f"\nSELECT {ITEM_OUT} FROM itens"
ORACLE_SQL["json_parse_notas"] = notas_cte(True, True) + """
SELECT chNFe, ide_nNF, ide_serie, ide_dhEmi, emit_CNPJ, emit_xNome, emit_xFant, emit_UF,
  total_vProd, total_vDesc, total_vNF, total_vTotTrib, prot_cStat FROM notas"""

# --- data-quality operators ------------------------------------------------------------

ORACLE_SQL["access_key_parts"] = notas_cte(False, True) + f"""
SELECT chNFe, {", ".join(key_parts("chNFe"))} FROM notas"""

_DV = check_digit("substr(chNFe, 1, 43)")
ORACLE_SQL["access_key_check_digit"] = notas_cte(False, True) + f""",
  damaged AS (SELECT CASE WHEN o_orderstatus = 'P' THEN substr(chNFe, 1, 43) ||
    CAST((CAST(substr(chNFe, 44, 1) AS INTEGER) + 1) % 10 AS VARCHAR) ELSE chNFe END AS chNFe FROM notas)
SELECT chNFe, {_DV} AS dv_expected, TRY_CAST(substr(chNFe, 44, 1) AS INTEGER) AS dv_actual,
  COALESCE(length(chNFe) = 44 AND {_DV} = TRY_CAST(substr(chNFe, 44, 1) AS INTEGER), false) AS dv_ok
FROM damaged"""


def _within(a: str, b: str, tol: str = "0.005") -> str:
    return f"COALESCE(abs(({a}) - ({b})) <= {tol}, false)"


ORACLE_SQL["totals_reconciliation"] = notas_cte(True, False, with_itens=True) + f""",
  sums AS (SELECT serie AS _s, nNF AS _k, COUNT(*) AS n_itens, SUM({dec('vProd')}) AS iv_prod,
             SUM({dec('vDesc')}) AS iv_desc, SUM({dec('vTotTrib')}) AS iv_trib FROM itens GROUP BY serie, nNF)
SELECT ide_serie, ide_nNF, COALESCE(n_itens, 0) AS n_itens,
  CAST(COALESCE(iv_prod, 0) AS DOUBLE) AS itens_vProd, CAST(COALESCE(iv_desc, 0) AS DOUBLE) AS itens_vDesc,
  CAST(COALESCE(iv_trib, 0) AS DOUBLE) AS itens_vTotTrib,
  {_within(dec('total_vProd'), 'COALESCE(iv_prod, 0)')} AS vprod_ok,
  {_within(dec('total_vDesc'), 'COALESCE(iv_desc, 0)')} AS vdesc_ok,
  {_within(dec('total_vTotTrib'), 'COALESCE(iv_trib, 0)')} AS vtottrib_ok,
  {_within(dec('total_vNF'), dec('total_vProd') + ' - ' + dec('total_vDesc'))} AS vnf_ok
FROM notas LEFT JOIN sums ON ide_nNF = _k AND ide_serie = _s"""

ORACLE_SQL["uf_lookup_check"] = notas_cte(False, True) + """,
  damaged AS (SELECT chNFe, CASE WHEN o_orderstatus = 'P' THEN '77' ELSE ide_cUF END AS ide_cUF,
    CASE WHEN o_orderstatus = 'O' THEN 'XX' ELSE emit_UF END AS emit_UF FROM notas)
SELECT chNFe, emit_UF, ide_cUF, lk.n_nationkey AS expected_cUF, lk.n_name IS NOT NULL AS uf_known,
  COALESCE(TRY_CAST(ide_cUF AS INTEGER) = lk.n_nationkey, false) AS cuf_ok,
  COALESCE(TRY_CAST(substr(chNFe, 1, 2) AS INTEGER) = TRY_CAST(ide_cUF AS INTEGER), false) AS key_prefix_ok
FROM damaged LEFT JOIN nation lk ON emit_UF = lk.n_name"""

ORACLE_SQL["key_protocol_check"] = notas_cte(False, True) + """
SELECT chNFe, CASE WHEN o_orderstatus = 'O' THEN 'X' || substr(chNFe, 2) ELSE chNFe END AS prot_chNFe,
  CASE WHEN o_orderstatus = 'P' THEN '301' ELSE '100' END AS prot_cStat,
  o_orderstatus <> 'O' AS key_matches, o_orderstatus <> 'P' AS authorized FROM notas"""

_UNITS = {x: f"CAST(replace(CAST({dec(x)} AS VARCHAR), '.', '') AS HUGEINT)" for x in ("vProd", "vTotTrib")}
_RATE = f"(CASE WHEN vProd > 0 THEN {rounded_ratio(_UNITS['vTotTrib'] + ' * 10000', _UNITS['vProd'], 4)} END)"
ORACLE_SQL["item_tax_rate"] = ITENS_CTE + f"""
SELECT nNF, nItem, vProd, vTotTrib, {_RATE} AS tax_rate,
  COALESCE(abs(round({_RATE} * 10000) - 585) > 5, true) AS rate_outlier
FROM itens"""

ORACLE_SQL["latest_by_key"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

ORACLE_SQL["event_props_json"] = """
SELECT event_id, user_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLE_SQL["guarded_cast"] = """
SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS qty,
  TRY_CAST(l_returnflag AS DOUBLE) AS flag_num, TRY_CAST(substr(l_returnflag, 2, 1) AS DOUBLE) AS empty_num,
  TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line_int
FROM lineitem"""

ORACLE_SQL["missing_block_defaults"] = notas_cte(True, True) + """
SELECT chNFe, CASE WHEN o_orderstatus = 'O' THEN '' ELSE emit_UF END AS emit_UF, '' AS emit_xMun,
  '' AS dest_CPF, '' AS dest_xNome, '' AS dest_UF, 0.0::DOUBLE AS total_vBC,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE total_vProd END AS total_vProd,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE total_vNF END AS total_vNF,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE total_vTotTrib END AS total_vTotTrib
FROM notas"""

ORACLE_SQL["table_counts"] = notas_cte(True, False, with_itens=True) + """
SELECT 'nfe_notas' AS table_name, COUNT(*) AS row_count FROM notas
UNION ALL SELECT 'nfe_itens', COUNT(*) FROM itens
UNION ALL SELECT 'resultado_notas_por_uf', COUNT(*) FROM (SELECT 1 FROM notas GROUP BY emit_UF)
UNION ALL SELECT 'resultado_faturamento_emitente', COUNT(*) FROM (
  SELECT 1 FROM notas GROUP BY emit_CNPJ, emit_xNome, emit_xFant, emit_UF)
UNION ALL SELECT 'resultado_produtos_mais_vendidos', LEAST(20, COUNT(*)) FROM (
  SELECT 1 FROM itens GROUP BY cProd, xProd, uCom)
UNION ALL SELECT 'resultado_tributos_por_nota', COUNT(*) FROM notas
UNION ALL SELECT 'resultado_valor_medio_mensal', COUNT(*) FROM (SELECT 1 FROM notas GROUP BY substring(ide_dhEmi, 1, 7))"""

# --- streaming ---------------------------------------------------------------------------

ORACLE_SQL["stream_available_now"] = notas_cte(True, True) + """
SELECT chNFe, ide_nNF, emit_UF, total_vProd, total_vNF, total_vTotTrib FROM notas"""

# --- rejects, republication and the persisted pipeline ------------------------------------

ORACLE_SQL["xml_rejects"] = notas_cte(False, True) + """
SELECT chNFe AS key, CASE o_orderpriority WHEN '1-URGENT' THEN 'malformed' WHEN '2-HIGH' THEN 'missing_ide'
  ELSE 'no_invoice' END AS reason
FROM notas WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

ORACLE_SQL["republish_latest"] = notas_cte(False, True) + """
SELECT chNFe, total_vNF, CAST(2 AS BIGINT) AS batch FROM notas"""

ORACLE_SQL["topic_snapshots"] = notas_cte(False, True) + """
SELECT chNFe AS key, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS snapshot, true AS gapless FROM notas WHERE o_orderstatus IN ('F', 'O')"""

ORACLE_SQL["binary_messages"] = notas_cte(False, True) + """
SELECT chNFe, ide_nNF, emit_UF, emit_xNome, total_vNF FROM notas"""

ORACLE_SQL["persisted_notas_por_uf"] = ORACLE_SQL["notas_por_uf"]

ORACLE_SQL["incremental_persist_latest"] = notas_cte(True, True) + """
SELECT chNFe, ide_nNF, emit_UF, total_vNF, total_vTotTrib FROM notas"""


ORACLE_SQL["stream_latest_state"] = notas_cte(False, True) + """
SELECT chNFe, total_vNF, CAST(CASE o_orderstatus WHEN 'P' THEN 2 ELSE 0 END AS BIGINT) AS batch FROM notas"""

ORACLE_SQL["stream_reconciliation"] = ORACLE_SQL["totals_reconciliation"]


# --- damaged messages and files: by order priority ---------------------------------------

_GOOD = "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
_REASON = """CASE o_orderpriority WHEN '1-URGENT' THEN '{0}' WHEN '2-HIGH' THEN '{1}' ELSE '{2}' END"""
_MESSAGE_REASON = _REASON.format("empty", "malformed", "missing_key")

ORACLE_SQL["persisted_notas"] = notas_cte(True, True) + f"""
SELECT chNFe, versao, ide_cUF, ide_nNF, ide_natOp, ide_serie, ide_dhEmi, ide_dhEmi AS ide_dhSaiEnt, '1' AS ide_tpNF,
  '' AS ide_cMunFG, emit_CNPJ, emit_xNome, emit_xFant, '' AS emit_IE, '1' AS emit_CRT, '' AS emit_xMun, emit_UF,
  '' AS dest_CPF, '' AS dest_CNPJ, '' AS dest_xNome, '' AS dest_xMun, '' AS dest_UF,
  0.0::DOUBLE AS total_vBC, total_vICMS, total_vProd, 0.0::DOUBLE AS total_vFrete, total_vDesc, total_vPIS, total_vCOFINS,
  total_vNF, total_vTotTrib, {_lp('o_orderkey', 15)} AS prot_nProt, ide_dhEmi AS prot_dhRecbto, prot_cStat
FROM notas WHERE {_GOOD}"""

ORACLE_SQL["persisted_itens"] = notas_cte(False, True, with_itens=True) + f"""
SELECT n.chNFe, i.nNF, nItem, cProd, xProd, '' AS NCM, CFOP, uCom, qCom, vUnCom, vProd, vDesc, vTotTrib
FROM itens i JOIN notas n ON i.l_orderkey = n.o_orderkey WHERE {_GOOD}"""

ORACLE_SQL["bucketed_issuer_check"] = notas_cte(True, False, with_itens=True) + f""",
  sums AS (SELECT l_orderkey, COUNT(*) AS n, SUM({dec('vProd')}) AS v FROM itens GROUP BY l_orderkey)
SELECT emit_CNPJ AS cnpj_emitente, COUNT(*) AS total_notas, CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS total_itens, {money_sum('total_vProd')} AS valor_notas,
  CAST(ROUND(COALESCE(SUM(v), 0), 2) AS DOUBLE) AS valor_itens,
  CAST(SUM(CASE WHEN {dec('total_vProd')} = COALESCE(v, 0) THEN 0 ELSE 1 END) AS BIGINT) AS notas_divergentes
FROM notas LEFT JOIN sums ON l_orderkey = o_orderkey WHERE {_GOOD} GROUP BY emit_CNPJ"""

ORACLE_SQL["parts_persist"] = notas_cte(False, True, with_itens=True) + f""",
  sums AS (SELECT l_orderkey, COUNT(*) AS n, {money_sum('vProd')} AS v FROM itens GROUP BY l_orderkey)
SELECT chNFe, CASE WHEN o_orderstatus = 'P' THEN '2P' WHEN o_orderstatus = 'O' AND COALESCE(n, 0) <= 3 THEN '2O' ELSE '1' END AS publicacao,
  CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(CAST(total_vNF AS VARCHAR) AS DECIMAL(18,2)) + 1 AS DOUBLE) ELSE total_vNF END AS total_vNF,
  COALESCE(n, 0) AS n_itens, v AS soma, CASE WHEN o_orderstatus = 'O' AND n > 3 THEN '2O' END AS incompleta
FROM notas LEFT JOIN sums ON l_orderkey = o_orderkey"""

ORACLE_SQL["persisted_rejects"] = f"""
SELECT 'order ' || o_orderkey AS key, {_MESSAGE_REASON} AS reason FROM orders WHERE NOT ({_GOOD})"""

_PLACED = "SELECT '{0}' AS table_name, row_number() OVER (ORDER BY {1}) AS place, {2} AS name FROM ({3})"
ORACLE_SQL["report_job"] = " UNION ALL ".join("(" + _PLACED.format(*x) + ")" for x in (
    ("resultado_notas_por_uf", "total_notas DESC, uf_emitente", "uf_emitente", ORACLE_SQL["notas_por_uf"]),
    ("resultado_faturamento_emitente", "valor_total_nf DESC, cnpj_emitente", "cnpj_emitente", ORACLE_SQL["faturamento_emitente"]),
    ("resultado_produtos_mais_vendidos", "quantidade_total DESC, codigo_produto, descricao_produto, unidade", "codigo_produto",
     ORACLE_SQL["produtos_mais_vendidos"]),
    ("resultado_tributos_por_nota", "valor_total_tributos DESC, chave_nfe", "chave_nfe", ORACLE_SQL["tributos_por_nota"]),
    ("resultado_valor_medio_mensal", "ano_mes", "ano_mes", ORACLE_SQL["valor_medio_mensal"])))

ORACLE_SQL["report_ranks"] = f"""
SELECT chave_nfe, valor_total_tributos, rank() OVER (ORDER BY valor_total_tributos DESC) AS posto,
  dense_rank() OVER (ORDER BY valor_total_tributos DESC) AS posto_denso,
  row_number() OVER (ORDER BY valor_total_tributos DESC, chave_nfe) AS lugar
FROM ({ORACLE_SQL['tributos_por_nota']})"""

ORACLE_SQL["ctas_and_drop"] = "SELECT n_nationkey + 100 AS n_nationkey, n_name FROM nation"

ORACLE_SQL["xml_files_ingest"] = notas_cte(False, True) + f"""
SELECT chNFe AS key, CASE WHEN {_GOOD} THEN 'message' ELSE {_REASON.format('malformed', 'missing_ide', 'no_invoice')} END AS outcome
FROM notas"""

ORACLE_SQL["xml_single_files"] = notas_cte(False, True) + f""",
  newest AS (SELECT * FROM notas QUALIFY row_number() OVER (PARTITION BY emit_CNPJ ORDER BY ide_dhEmi DESC, o_orderkey DESC) = 1)
SELECT CAST(emit_CNPJ AS BIGINT) AS customer, CASE WHEN {_GOOD} THEN 'message' ELSE {_REASON.format('malformed', 'missing_ide', 'no_invoice')} END AS outcome,
  CASE WHEN {_GOOD} THEN chNFe END AS chNFe, CASE WHEN {_GOOD} THEN total_vNF END AS total_vNF
FROM newest
UNION ALL SELECT -1 - n_nationkey, 'empty_file', NULL, NULL FROM nation"""

_AUDITED = {
    "messages_read": "SELECT COUNT(*) FROM notas", "nfe_notas": f"SELECT COUNT(*) FROM notas WHERE {_GOOD}",
    "nfe_itens": f"SELECT COUNT(*) FROM itens JOIN notas ON l_orderkey = o_orderkey WHERE {_GOOD}",
    "rejected": f"SELECT COUNT(*) FROM notas WHERE NOT ({_GOOD})"}
_REPORTED = {
    "resultado_notas_por_uf": "SELECT COUNT(DISTINCT emit_UF) FROM good",
    "resultado_faturamento_emitente": "SELECT COUNT(*) FROM (SELECT DISTINCT emit_CNPJ, emit_xNome, emit_xFant, emit_UF FROM good)",
    "resultado_produtos_mais_vendidos": "SELECT LEAST(20, COUNT(*)) FROM (SELECT DISTINCT cProd, xProd, uCom FROM itens JOIN good ON l_orderkey = o_orderkey)",
    "resultado_tributos_por_nota": "SELECT COUNT(*) FROM good",
    "resultado_valor_medio_mensal": "SELECT COUNT(DISTINCT substring(ide_dhEmi, 1, 7)) FROM good"}
ORACLE_SQL["audit_table"] = notas_cte(False, True, with_itens=True) + f", good AS (SELECT * FROM notas WHERE {_GOOD})" + " UNION ALL ".join(
    f" SELECT '{job}' AS job, '{stage}' AS stage, 'rows' AS metric, ({sql}) AS value"
    for job, stages in (("persist", _AUDITED), ("persist_stream", _AUDITED), ("reports", _REPORTED)) for stage, sql in stages.items())

ORACLE_SQL["stream_persist_rejects"] = notas_cte(False, True) + f"""
SELECT chNFe AS key, 'note' AS outcome FROM notas WHERE {_GOOD}
UNION ALL SELECT chNFe, 'item' FROM notas JOIN lineitem ON l_orderkey = o_orderkey WHERE {_GOOD}
UNION ALL SELECT 'order ' || o_orderkey, {_MESSAGE_REASON} FROM notas, (VALUES (1), (2)) AS batches(b) WHERE NOT ({_GOOD})"""


def _long(report: str, group: str, values: tuple[str, ...], sql: str) -> str:
    cells = ", ".join(f"CAST({v} AS DOUBLE) AS v{i}" for i, v in enumerate(values))
    return f"SELECT '{report}' AS report, concat_ws('|', {group}) AS grp, {cells} FROM ({sql})"


def _body(name: str) -> str:
    """The report's SELECT alone."""
    sql = ORACLE_SQL[name]
    return sql[sql.rindex("\nSELECT"):]


# invoices of status P have another state, a higher value and no items
_REPLACED = notas_cte(True, True, with_itens=True).replace("  notas AS (", "  first_notas AS (").replace("  itens AS (", "  first_itens AS (") + """,
  notas AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'XX' ELSE emit_UF END AS emit_UF,
    CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(CAST(total_vNF AS VARCHAR) AS DECIMAL(18,2)) + 1 AS DOUBLE) ELSE total_vNF END AS total_vNF) FROM first_notas),
  itens AS (SELECT i.* FROM first_itens i JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P')
"""
ORACLE_SQL["incremental_reports"] = _REPLACED + " UNION ALL ".join((
    _long("notas_por_uf", "uf_emitente", ("total_notas", "valor_total", "valor_medio", "NULL"), _body("notas_por_uf")),
    _long("faturamento_emitente", "cnpj_emitente, nome_emitente, fantasia_emitente, uf_emitente",
          ("total_notas", "valor_produtos", "valor_total_nf", "valor_total_tributos"), _body("faturamento_emitente")),
    _long("produtos_mais_vendidos", "codigo_produto, descricao_produto, unidade",
          ("qtd_vendas", "quantidade_total", "valor_total", "preco_medio_unitario"), _body("produtos_mais_vendidos")),
    _long("tributos_por_nota", "chave_nfe, numero_nf, emitente", ("valor_nota", "valor_icms", "valor_total_tributos", "percentual_tributos"), _body("tributos_por_nota")),
    _long("valor_medio_mensal", "ano_mes", ("total_notas", "valor_total", "valor_minimo", "valor_maximo"), _body("valor_medio_mensal"))))

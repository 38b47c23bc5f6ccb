"""Fixed values of the electronic-invoice domain.

Everything in this module is a fixed value that must stay exactly as written for
results to be right (layout widths, codes, defaults).  Nothing here is logic.
"""

from __future__ import annotations

# --- fixed values: issuer-state codes (UF -> IBGE code), 27 entries -----------------
UF_CODES: dict[str, int] = {
    "AC": 12, "AL": 27, "AP": 16, "AM": 13, "BA": 29, "CE": 23,
    "DF": 53, "ES": 32, "GO": 52, "MA": 21, "MT": 51, "MS": 50,
    "MG": 31, "PA": 15, "PB": 25, "PR": 41, "PE": 26, "PI": 22,
    "RJ": 33, "RN": 24, "RS": 43, "RO": 11, "RR": 14, "SC": 42,
    "SP": 35, "SE": 28, "TO": 17,
}

# --- fixed values: 44-digit access key layout, (field, width) left to right ---------
ACCESS_KEY_LAYOUT: tuple[tuple[str, int], ...] = (
    ("cUF", 2), ("AAMM", 4), ("CNPJ", 14), ("mod", 2), ("serie", 3),
    ("nNF", 9), ("tpEmis", 1), ("cNF", 8), ("cDV", 1),
)

# --- fixed values: check digit (modulo 11, weights 2..9 cycling from the right) -----
CHECK_DIGIT_MODULUS = 11
CHECK_DIGIT_MIN_WEIGHT = 2
CHECK_DIGIT_MAX_WEIGHT = 9

# --- fixed values: invoice constants ------------------------------------------------
INVOICE_NAMESPACE = "http://www.portalfiscal.inf.br/nfe"
LAYOUT_VERSION = "3.10"
MODEL_NFE = "55"
EMISSION_NORMAL = "1"
AUTHORIZED_STATUS = "100"
MAX_ITEMS_PER_INVOICE = 990          # nItem runs 1..990 in the layout
MISSING_TOTAL_DEFAULT = "0.00"       # every ICMSTot child when the block is absent
KEY_PREFIX = "NFe"                   # infNFe/@Id = "NFe" + 44-digit key
EXPECTED_ITEM_TAX_RATE = "0.0585"    # approximate tax share of vProd per item
ITEM_TAX_RATE_TOLERANCE = "0.0005"
TOTALS_TOLERANCE = "0.005"

# --- fixed values: message-log / topic defaults -------------------------------------
DEFAULT_TOPIC = "nfe-json"
DEFAULT_LOG_PARTITIONS = 3

# fixed values: operation of a sale (text and code)
NAT_OP_SALE = "VENDA DE MERCADORIA"
CFOP_SALE = "5102"

"""Hand-written invoice XML files of the shape described in FIXTURES.md (F1)."""

from __future__ import annotations

import os

NS = "http://www.portalfiscal.inf.br/nfe"


def item_xml(n: int, cprod: str, xprod: str, ucom: str, qcom: str, vun: str, vprod: str, vdesc: str = "0.00",
             vtrib: str | None = "0.00", prod: bool = True) -> str:
    p = (f"<prod><cProd>{cprod}</cProd><cEAN/><xProd>{xprod}</xProd><NCM>04012010</NCM><CFOP>5102</CFOP>"
         f"<uCom>{ucom}</uCom><qCom>{qcom}</qCom><vUnCom>{vun}</vUnCom><vProd>{vprod}</vProd>"
         f"<vDesc>{vdesc}</vDesc></prod>") if prod else ""
    imp = (f"<imposto><vTotTrib>{vtrib}</vTotTrib><ICMS><ICMSSN102><orig>0</orig></ICMSSN102></ICMS></imposto>"
           if vtrib is not None else "")
    return f'<det nItem="{n}">{p}{imp}</det>'


def invoice_xml(key: str, nnf: str, dh: str, cnpj: str, xnome: str, xfant: str, uf: str, cuf: str,
                items: list[str], totals: dict[str, str] | None, dest: str = "cpf",
                ide: bool = True, prot_key: str | None = None, cstat: str = "100", xmun: str = "CIDADE") -> str:
    ide_xml = (f"<ide><cUF>{cuf}</cUF><cNF>12345678</cNF><natOp>VENDA DE MERCADORIA</natOp><mod>55</mod>"
               f"<serie>1</serie><nNF>{nnf}</nNF><dhEmi>{dh}</dhEmi><dhSaiEnt>{dh}</dhSaiEnt><tpNF>1</tpNF>"
               f"<cMunFG>1234567</cMunFG></ide>") if ide else ""
    emit = (f"<emit><CNPJ>{cnpj}</CNPJ><xNome>{xnome}</xNome><xFant>{xfant}</xFant><IE>123</IE><CRT>1</CRT>"
            f"<enderEmit><xLgr>RUA A</xLgr><nro>1</nro><xBairro>CENTRO</xBairro><cMun>1234567</cMun>"
            f"<xMun>{xmun}</xMun><UF>{uf}</UF><CEP>01000000</CEP><fone>1100000000</fone></enderEmit></emit>")
    if dest == "cpf":
        dest_xml = ("<dest><CPF>12345678901</CPF><xNome>JOSÉ DA SILVA</xNome><enderDest><xLgr>RUA B</xLgr>"
                    "<nro>2</nro><xBairro>BAIRRO</xBairro><cMun>7654321</cMun><xMun>OUTRA</xMun><UF>SP</UF>"
                    "<CEP>02000000</CEP></enderDest></dest>")
    else:
        dest_xml = "<dest><CNPJ>11222333000181</CNPJ><xNome>EMPRESA LTDA</xNome></dest>"
    if totals is None:
        total_xml = ""
    else:
        fields = ["vBC", "vICMS", "vICMSDeson", "vBCST", "vST", "vProd", "vFrete", "vSeg", "vDesc", "vII",
                  "vIPI", "vPIS", "vCOFINS", "vOutro", "vNF", "vTotTrib"]
        body = "".join(f"<{f}/>" if totals.get(f, "0.00") == "" else f"<{f}>{totals.get(f, '0.00')}</{f}>"
                       for f in fields)
        total_xml = f"<total><ICMSTot>{body}</ICMSTot></total>"
    prot = (f'<protNFe versao="3.10"><infProt><tpAmb>1</tpAmb><chNFe>{prot_key or key}</chNFe>'
            f"<dhRecbto>{dh}</dhRecbto><nProt>135000000000001</nProt><cStat>{cstat}</cStat>"
            f"<xMotivo>Autorizado o uso da NF-e</xMotivo></infProt></protNFe>")
    return (f'<?xml version="1.0" encoding="UTF-8"?>\n<nfeProc xmlns="{NS}" versao="3.10"><NFe>'
            f'<infNFe Id="NFe{key}" versao="3.10">{ide_xml}{emit}{dest_xml}{"".join(items)}{total_xml}'
            f'<transp><modFrete>9</modFrete></transp><infAdic><infCpl>texto livre</infCpl></infAdic>'
            f"</infNFe></NFe>{prot}</nfeProc>")


CNPJ_A = "11111111000191"
CNPJ_B = "22222222000191"
CNPJ_C = "33333333000191"

# fixed values: 44-digit keys, the last digit worked out by hand
KEYS = {
    "ok_1": "35240111111111000191550010000001011123456783",
    "ok_2": "35240222222222000191550010000001021123456784",
    "ok_3": "33240233333333000191550010000001031123456787",
    "ok_month_edge": "35240111111111000191550010000001041123456785",
    "no_total": "33240333333333000191550010000001051123456785",
    "empty_child": "33240333333333000191550010000001061123456782",
    "no_imposto": "35240311111111000191550010000001071123456784",
    "dest_cnpj": "35240311111111000191550010000001081123456781",
    "zero_value": "35240322222222000191550010000001091123456789",
    "no_items": "35240322222222000191550010000001101123456780",
}
REJECT_KEYS = {
    "no_ide": "35240311111111000191550010000001111123456787",
    "det_no_prod": "35240311111111000191550010000001121123456784",
}


def fixture_files() -> dict[str, str]:
    k = KEYS
    files = {
        "ok_1.xml": invoice_xml(k["ok_1"], "101", "2024-01-10T10:00:00-03:00", CNPJ_A, "MERCADO SÃO JOÃO", "SÃO JOÃO",
                                "SP", "35", [item_xml(1, "329", "LEITE INTEGRAL UHT 1L", "UN", "6.0000",
                                                      "5.0000000000", "30.00", "0.00", "1.76")],
                                {"vProd": "30.00", "vDesc": "0.00", "vNF": "30.00", "vTotTrib": "1.76"}),
        "ok_2.xml": invoice_xml(k["ok_2"], "102", "2024-02-05T09:00:00-03:00", CNPJ_B, "SUPERMERCADO BOA VISTA",
                                "BOA VISTA", "SP", "35",
                                [item_xml(1, "329", "LEITE INTEGRAL UHT 1L", "UN", "5.0000", "5.0000000000",
                                          "25.00", "1.00", "1.46"),
                                 item_xml(2, "410", "ARROZ BRANCO 5KG", "PCT", "2.0000", "22.5000000000",
                                          "45.00", "0.00", "2.63")],
                                {"vProd": "70.00", "vDesc": "1.00", "vNF": "69.00", "vTotTrib": "4.09"}),
        "ok_3.xml": invoice_xml(k["ok_3"], "103", "2024-02-20T18:30:00-03:00", CNPJ_C, "ATACAREJO RIO", "RIO",
                                "RJ", "33",
                                [item_xml(i + 1, c, d, u, q, v, p, "0.00", tt) for i, (c, d, u, q, v, p, tt) in enumerate([
                                    ("501", "CAFÉ TORRADO 500G", "PCT", "1.0000", "15.9000000000", "15.90", "0.93"),
                                    ("502", "AÇÚCAR 1KG", "PCT", "3.0000", "4.5000000000", "13.50", "0.79"),
                                    ("503", "FEIJÃO 1KG", "PCT", "2.0000", "8.2500000000", "16.50", "0.97"),
                                    ("504", "BANANA", "KG", "1.2500", "6.0000000000", "7.50", "0.44"),
                                    ("505", "ÓLEO DE SOJA 900ML", "UN", "4.0000", "7.0000000000", "28.00", "1.64"),
                                ])],
                                {"vProd": "81.40", "vDesc": "0.00", "vNF": "81.40", "vTotTrib": "4.77"}),
        "ok_month_edge.xml": invoice_xml(k["ok_month_edge"], "104", "2024-01-31T23:30:00-03:00", CNPJ_A,
                                         "MERCADO SÃO JOÃO", "SÃO JOÃO", "SP", "35",
                                         [item_xml(1, "600", "PÃO FRANCÊS", "KG", "0.5000", "20.0000000000",
                                                   "10.00", "0.00", "0.59")],
                                         {"vProd": "10.00", "vDesc": "0.00", "vNF": "10.00", "vTotTrib": "0.59"}),
        "no_total.xml": invoice_xml(k["no_total"], "105", "2024-03-01T10:00:00-03:00", CNPJ_C, "ATACAREJO RIO", "RIO",
                                    "RJ", "33", [item_xml(1, "700", "SABÃO", "UN", "1.0000", "3.0000000000", "3.00")],
                                    None),
        "empty_child.xml": invoice_xml(k["empty_child"], "106", "2024-03-02T10:00:00-03:00", CNPJ_C, "ATACAREJO RIO",
                                       "RIO", "RJ", "33",
                                       [item_xml(1, "701", "DETERGENTE", "UN", "2.0000", "2.0000000000", "4.00")],
                                       {"vProd": "4.00", "vNF": "", "vTotTrib": "0.23"}),
        "no_imposto.xml": invoice_xml(k["no_imposto"], "107", "2024-03-03T10:00:00-03:00", CNPJ_A, "MERCADO SÃO JOÃO",
                                      "SÃO JOÃO", "SP", "35",
                                      [item_xml(1, "702", "ESPONJA", "UN", "1.0000", "1.5000000000", "1.50", vtrib=None)],
                                      {"vProd": "1.50", "vNF": "1.50", "vTotTrib": "0.00"}),
        "dest_cnpj.xml": invoice_xml(k["dest_cnpj"], "108", "2024-03-04T10:00:00-03:00", CNPJ_A, "MERCADO SÃO JOÃO",
                                     "SÃO JOÃO", "SP", "35",
                                     [item_xml(1, "703", "VASSOURA", "UN", "1.0000", "12.0000000000", "12.00", "0.00",
                                               "0.70")],
                                     {"vProd": "12.00", "vNF": "12.00", "vTotTrib": "0.70"}, dest="cnpj"),
        "zero_value.xml": invoice_xml(k["zero_value"], "109", "2024-03-05T10:00:00-03:00", CNPJ_B,
                                      "SUPERMERCADO BOA VISTA", "BOA VISTA", "SP", "35",
                                      [item_xml(1, "704", "BRINDE", "UN", "1.0000", "0.0000000000", "0.00")],
                                      {"vProd": "0.00", "vNF": "0.00", "vTotTrib": "0.00"}),
        "no_items.xml": invoice_xml(k["no_items"], "110", "2024-03-06T10:00:00-03:00", CNPJ_B, "SUPERMERCADO BOA VISTA",
                                    "BOA VISTA", "SP", "35", [], {"vProd": "0.00", "vNF": "0.00", "vTotTrib": "0.00"}),
        # rejects
        "no_ide.xml": invoice_xml(REJECT_KEYS["no_ide"], "111", "2024-03-07T10:00:00-03:00", CNPJ_A,
                                  "X", "X", "SP", "35", [item_xml(1, "1", "A", "UN", "1", "1", "1.00")],
                                  {"vNF": "1.00"}, ide=False),
        "det_no_prod.xml": invoice_xml(REJECT_KEYS["det_no_prod"], "112", "2024-03-08T10:00:00-03:00",
                                       CNPJ_A, "X", "X", "SP", "35", [item_xml(1, "1", "A", "UN", "1", "1", "1.00",
                                                                               prod=False)], {"vNF": "1.00"}),
        "truncated.xml": '<?xml version="1.0"?>\n<nfeProc xmlns="' + NS + '"><NFe><infNFe Id="NFe1"><ide><cUF>35',
        "mismatched_tags.xml": '<nfeProc xmlns="' + NS + '"><NFe><infNFe Id="NFe1"><ide></emit></NFe></nfeProc>',
        "wrong_root.xml": '<?xml version="1.0"?>\n<cteProc xmlns="' + NS + '"><CTe><infCte Id="x"/></CTe></cteProc>',
        "empty.xml": "",
    }
    return files


REJECTS = {
    "no_ide.xml": "missing_ide",
    "det_no_prod.xml": "item_without_prod",
    "truncated.xml": "malformed",
    "mismatched_tags.xml": "malformed",
    "wrong_root.xml": "no_invoice",
}

GOOD = [n for n in fixture_files() if n not in REJECTS and n != "empty.xml"]


def write_fixtures(folder: str, names: list[str] | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in fixture_files().items():
        if names is None or name in names:
            with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                f.write(text)
    return folder

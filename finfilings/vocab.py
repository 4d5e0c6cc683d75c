"""Fixed values of the published data families.

Everything here is dictated by the publisher's file names, codes and column
lists; nothing is computed.
"""

from __future__ import annotations

# Balance-sheet institution tokens and the label of each.
BALANCE_TYPES = {
    "BANCOS": "Bancos",
    "COOPERATIVAS": "Cooperativas-de-credito",
    "CONSORCIOS": "Administradoras-de-consorcios",
    "CONGLOMERADOS": "Conglomerados-financeiros",
    "SOCIEDADES": "Sociedades",
    "BLOPRUDENCIAL": "Conglomerados-prudenciais",
    "COMBINADOS": "Combinados-cooperativos",
    "LIQUIDACAO": "Instituicoes-em-regime-especial",
}

# Institution-list tokens and labels.  Not the same vocabulary as
# above: the consortium token is singular here.
INSTITUTION_TYPES = {
    "CONGLOMERADOS": "Conglomerados",
    "BANCOS": "Bancos_comerciais-multiplos-caixa",
    "COOPERATIVAS": "Cooperativas-de-credito",
    "CONSORCIO": "Consorcios-adm",
    "SOCIEDADES": "Bancos-investimentos-desenvolvimento-sociedade-corretoras",
}

# Document numbers of the balance sheets.
DOCUMENTS = (4010, 4413, 4423, 4433, 4060, 4016, 4066)

# Forms in which one period may have landed, best first.
LANDING_SUFFIXES = (".CSV.ZIP", ".CSV", ".ZIP")

# Indicator institution types.
INDICATOR_TYPES = {
    1: "Conglomerados Prudenciais e Instituicoes Independentes",
    2: "Conglomerados Financeiros e Instituicoes Independentes",
    3: "Instituicoes Individuais",
    4: "Instituicoes com Operacoes de Cambio",
}

# Indicator report codes (total, assets, liabilities).
INDICATOR_REPORTS = ("T", "A", "P")

# Columns of the indicator values payload.
VALUE_COLUMNS = (
    "TipoInstituicao",
    "CodInst",
    "AnoMes",
    "NomeRelatorio",
    "NumeroRelatorio",
    "Grupo",
    "Conta",
    "NomeColuna",
    "DescricaoColuna",
    "Saldo",
)

# Columns of the indicator registry payload.
REGISTRY_COLUMNS = (
    "CodInst",
    "Data",
    "NomeInstituicao",
    "DataInicioAtividade",
    "Tcb",
    "Td",
    "Tc",
    "SegmentoTb",
    "Atividade",
    "Uf",
    "Municipio",
    "Sr",
    "CodConglomeradoFinanceiro",
    "CodConglomeradoPrudencial",
    "CnpjInstituicaoLider",
    "Situacao",
)

# Act types kept under their own landing folder.
OTHER_ACT_TYPES = ("Comunicado", "Ato de Diretor", "Ato do Presidente")

# Columns required before balances are pivoted.
BALANCE_COLUMNS = ("data", "documento", "cnpj", "nome_instituicao", "conta", "saldo")

# Columns identifying one row of the wide balance table.
BALANCE_IDS = ("data", "documento", "cnpj", "nome_instituicao")

# Raw balance columns that are dropped when present.
DROPPED_BALANCE_COLUMNS = (
    "ATRIBUTO",
    "NOME CONTA",
    "AGENCIA",
    "COD_CONGL",
    "NOME_CONGL",
    "TAXONOMIA",
    "NOME_CONTA",
)

# Fixed value: rows per page of the act search.
PAGE_ROWS = 500

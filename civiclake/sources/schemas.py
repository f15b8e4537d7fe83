"""Table contracts: column layouts of the raw (all-string) tables.

The column lists are fixed values: they are the published layouts, in order.
"""

from __future__ import annotations

from pyspark.sql import types as T

COMPANIES = [
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social", "porte_empresa", "ente_federativo_responsavel",
]
ESTABLISHMENTS = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_exterior", "pais", "data_inicio_atividade", "cnae_fiscal_principal",
    "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
    "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2", "ddd_fax",
    "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
]
PARTNERS = [
    "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cpf_cnpj_socio",
    "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
    "nome_do_representante", "qualificacao_representante_legal", "faixa_etaria",
]
AMENDMENT = [
    "autor", "codigo_emenda", "tipo_emenda", "sk_tipo_emenda", "localidade_do_gasto",
    "codigo_funcao", "funcao", "codigo_subfuncao", "subfuncao", "programa", "acao",
    "plano_orcamentario", "numero_emenda", "ano", "valor_total_a1", "valor_empenhado",
    "valor_liquidado", "valor_resto_inscrito", "valor_resto_cancelado", "valor_resto_pago",
    "possui_apoio_solicitante",
]
DOCUMENT = ["codigo_documento", "fase_documento", "data_documento", "favorecido", "valor_documento"]
AMENDMENT_DOCUMENTS = AMENDMENT + DOCUMENT
RESEARCHERS = [
    "id_lattes", "data_atualizacao", "hora_atualizacao", "nome", "uf_atuacao", "general_data",
    "atuacoes_profissionais", "projetos_pesquisa", "producoes_bibliograficas",
]
QUOTES = ["texto", "autor", "tags", "url_origem"]

# payload field -> table column; order as in AMENDMENT / DOCUMENT
AMENDMENT_FIELDS = {
    "autor": "autor", "codigoEmenda": "codigo_emenda", "tipoEmenda": "tipo_emenda",
    "skTipoEmenda": "sk_tipo_emenda", "localidadeDoGasto": "localidade_do_gasto",
    "codigoFuncao": "codigo_funcao", "funcao": "funcao", "codigoSubfuncao": "codigo_subfuncao",
    "subfuncao": "subfuncao", "programa": "programa", "acao": "acao",
    "planoOrcamentario": "plano_orcamentario", "numeroEmenda": "numero_emenda", "ano": "ano",
    "valorPago": "valor_total_a1", "valorEmpenhado": "valor_empenhado",
    "valorLiquidado": "valor_liquidado", "valorRestoInscrito": "valor_resto_inscrito",
    "valorRestoCancelado": "valor_resto_cancelado", "valorRestoPago": "valor_resto_pago",
    "possuiApoiadorSolicitante": "possui_apoio_solicitante",
}
DOCUMENT_FIELDS = {
    "codigoDocumentoResumido": "codigo_documento", "fase": "fase_documento",
    "data": "data_documento", "favorecido": "favorecido", "valor": "valor_documento",
}
NULL_WHEN_MISSING = {"subfuncao"}

# file suffix (and the spelling used by generated samples) -> layout
LAYOUTS = {
    "EMPRECSV": COMPANIES,
    "ESTABELE": ESTABLISHMENTS,
    "SOCIOCSV": PARTNERS,
    "Empresas": COMPANIES,
    "Estabelecimentos": ESTABLISHMENTS,
    "Socios": PARTNERS,
}

# table name -> business columns of the raw table
TABLES = {
    "cgu_emendas_parlamentares": AMENDMENT_DOCUMENTS,
    "rfb_cnpj_empresas": COMPANIES,
    "rfb_cnpj_estabelecimentos": ESTABLISHMENTS,
    "rfb_cnpj_socios": PARTNERS,
    "lattes_raw": RESEARCHERS,
    "quotes": QUOTES,
}
# end of fixed values

LOAD_COLUMN = "data_extracao"


def strings(columns: list[str]) -> T.StructType:
    """All-string schema; nothing is inferred, so ``0008`` stays ``0008``."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def bronze(columns: list[str]) -> T.StructType:
    """Raw-table schema: load time first, then the business columns as text."""
    return T.StructType([T.StructField(LOAD_COLUMN, T.TimestampType()), *strings(columns).fields])


def layout_for(pattern: str) -> list[str]:
    """Positional layout for a file pattern; unknown patterns are an error."""
    for mark, columns in LAYOUTS.items():
        if mark in pattern:
            return columns
    raise ValueError(f"no column layout for file pattern {pattern!r}; known: {sorted(LAYOUTS)}")


REVENUE_LEVELS = [
    "categoriaEconomica", "origem", "especie", "rubrica", "alinea", "subalinea",
    "subdetalhamento1", "subdetalhamento2", "subdetalhamento3",
]


def revenue_file() -> T.StructType:
    """Schema of a revenue file: one object per management unit."""
    levels = ", ".join(f"{n}: struct<codigo: string, denominacao: string>" for n in REVENUE_LEVELS)
    record = (
        "struct<receita: struct<codigo: bigint, tipoReceita: string>, "
        "unidadeGestora: struct<codigo: bigint, denominacao: string>, "
        f"naturezaReceita: struct<{levels}>, "
        "listFonteRecursos: array<struct<codigo: bigint, denominacao: string, percentual: decimal(9,4)>>, "
        "exercicio: struct<exercicio: int>, "
        "listMovimentos: array<struct<dataMovimento: string, tipoMovimento: string, "
        "valorMovimento: decimal(18,2)>>>"
    )
    return T.StructType.fromDDL(
        "informacao string, ultimaAtualizacao string, totalRegistros bigint, "
        f"registros array<struct<registro: {record}>>"
    )

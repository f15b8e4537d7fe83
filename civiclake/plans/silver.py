"""Typed, deduplicated tables built from the raw ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.brazil import (
    brl_money,
    date_br,
    days,
    modality,
    pct,
    pct_band,
    split_payee,
    status_code,
)
from ..functions.pairs import pair_at, pair_by_keyword, pair_value
from ..functions.text import clean_text, normal_category, short_id, strip
from ..operators.dedupe import dedupe_latest
from ..operators.joins import valid_amendments
from ..operators.normalize import explode_rows
from ..sources.schemas import AMENDMENT_DOCUMENTS, LOAD_COLUMN

MONEY_COLUMNS = [c for c in AMENDMENT_DOCUMENTS if c.startswith("valor_")]
DOCUMENT_KEY = ["codigo_emenda", "codigo_documento"]


def silver_quotes(raw: DataFrame, tie_break: list[Column] | None = None) -> DataFrame:
    """Latest row per (text, author)."""
    renamed = raw.select(
        F.col("texto").alias("quote_text"), F.col("autor").alias("author_name"),
        "tags", "url_origem", "ingestion_at",
    )
    order = [F.col("ingestion_at").desc(), *(tie_break or [F.col("url_origem"), F.col("tags")])]
    return dedupe_latest(renamed, ["quote_text", "author_name"], order)


def latest_documents(raw: DataFrame) -> DataFrame:
    """Raw amendment documents reduced to the newest load of each natural key."""
    ties = [F.col(c).asc_nulls_first() for c in AMENDMENT_DOCUMENTS if c not in DOCUMENT_KEY and c in raw.columns]
    return dedupe_latest(raw, DOCUMENT_KEY, [F.col(LOAD_COLUMN).desc(), *ties])


def silver_amendments(raw: DataFrame) -> DataFrame:
    """Valid codes, newest load per document, typed money, dates and payee.

    The code filter comes before the shuffle, the parsing after it, so only rows that
    survive deduplication are parsed.
    """
    valid, _ = valid_amendments(raw)
    return typed_documents(latest_documents(valid))


def typed_documents(latest: DataFrame) -> DataFrame:
    """Typed money, dates and payee of raw amendment documents."""
    out = []
    for name in latest.columns:
        c = F.col(name)
        if name in MONEY_COLUMNS:
            out.append(brl_money(c).alias(name))
        elif name in ("ano", "sk_tipo_emenda"):
            out.append(c.try_cast("int").alias(name))
        elif name == "data_documento":
            out.append(date_br(c).alias(name))
        elif name == "favorecido":
            payee = split_payee(c)
            out += [payee["id"].alias("favorecido_id"), payee["name"].alias("favorecido_nome"),
                    payee["kind"].alias("favorecido_tipo")]
        else:
            out.append(c)
    return latest.select(*out)


# -- public works ---------------------------------------------------------------

SPENDING_RULES = {
    "valor_medio_acumulado": ["valor médio acumulado", "valor medio acumulado"],
    "valor_pago_periodo": ["período", "periodo"],
    "valor_pago_exercicio": ["exercício", "exercicio"],
}
GENERAL_FIELDS = [
    "modalidade_licitacao", "descricao_obra", "situacao", "etapa_obra", "percentual_concluido",
    "responsavel_inexecucao", "motivo_inexecucao", "data_prevista_reinicio",
]
CONTRACT_FIELDS = [
    "numero_contrato_principal", "data_inicio", "prazo", "valor_contratado", "data_conclusao_paralisacao",
]
WORK_SECTIONS = [
    "general_info", "contract", "contracted", "fiscal_year_expenditures", "contract_amendment",
    "cumulative_amount_paid",
]
AMENDMENT_FIELDS = ["prazo_aditado", "valor_aditado_acumulado"]


def pairs_only(pages: DataFrame, sections: list[str], keep: list[str]) -> DataFrame:
    """Section structs reduced to their pair lists, one column each.

    Kept as a projection of its own: the lists are read many times above it.
    """
    return pages.select(*keep, *[F.col(f"{s}.paired_data").alias(s) for s in sections])


def section_columns(pairs: Column, keys: dict[str, str]) -> list[Column]:
    """Values of chosen categories: output name -> lower-cased category."""
    return [pair_value(pairs, category).alias(name) for name, category in keys.items()]


def section_entries(df: DataFrame, keep: list[str], pairs: Column) -> DataFrame:
    """Long form of a section: one row per pair with its normalised category."""
    return explode_rows(df, keep, pairs, "p", position="pair_index").select(
        *keep, "pair_index", normal_category(F.col("p.category")).alias("category"), F.col("p.value").alias("value")
    )


def positional(section: str, names: list[str]) -> list[Column]:
    """Section whose pairs come in a fixed order: the n-th value feeds the n-th name."""
    return [pair_at(F.col(section), i, "value").alias(name) for i, name in enumerate(names)]


def contracted_columns() -> list[Column]:
    """Contractor section: label and value sides of its first two pairs all carry data."""
    pairs = F.col("contracted")
    return [
        pair_at(pairs, 0, "category").alias("numero_contrato_referencia"),
        pair_at(pairs, 0, "value").alias("cnpj_contratada"),
        pair_at(pairs, 1, "category").alias("data_inicio_contratada"),
        pair_at(pairs, 1, "value").alias("razao_social_contratada"),
    ]


def flatten_works(pages: DataFrame) -> DataFrame:
    """Public-works pages (section structs) to one flat typed row each, in one projection."""
    kept = [c for c in ("work_location", "source_url", "extraction_date") if c in pages.columns]
    spending = F.col("fiscal_year_expenditures")
    raw = pairs_only(pages, WORK_SECTIONS, kept).select(
        *positional("general_info", GENERAL_FIELDS),
        *positional("contract", CONTRACT_FIELDS),
        *contracted_columns(),
        *[pair_by_keyword(spending, SPENDING_RULES, t).alias(t) for t in SPENDING_RULES],
        *positional("contract_amendment", AMENDMENT_FIELDS),
        *positional("cumulative_amount_paid", ["valor_pago_acumulado"]),
        *kept,
    )
    typed: dict[str, Column] = {}
    for c in ("descricao_obra", "etapa_obra", "responsavel_inexecucao", "motivo_inexecucao",
              "numero_contrato_principal", "prazo", "prazo_aditado"):
        typed[c] = clean_text(F.col(c))
    for c in ("valor_contratado", "valor_medio_acumulado", "valor_pago_periodo", "valor_pago_exercicio",
              "valor_aditado_acumulado", "valor_pago_acumulado"):
        typed[c] = brl_money(F.col(c))
    for c in ("data_prevista_reinicio", "data_inicio"):
        typed[c] = date_br(F.col(c))
    typed["situacao"] = status_code(clean_text(F.col("situacao")))
    typed["percentual_concluido"] = pct(F.col("percentual_concluido"))
    typed["tipo_modalidade"] = modality(F.col("modalidade_licitacao"))
    typed["prazo_dias"] = days(F.col("prazo"))
    typed["obra_id"] = short_id(F.col("source_url"))
    return raw.withColumns(typed).withColumn("faixa_conclusao", pct_band(F.col("percentual_concluido")))


def work_documents(pages: DataFrame, only_http: bool = False) -> DataFrame:
    """One row per document link of a work; links without a target are skipped."""
    exploded = explode_rows(pages, ["source_url"], F.col("all_documents.paired_data"), "p").where(
        F.coalesce(F.col("p.value") != "", F.lit(False))
    )
    out = exploded.select(
        short_id(F.col("source_url")).alias("obra_id"),
        F.col("source_url").alias("obra_url"),
        clean_text(F.col("p.category")).alias("documento_titulo"),
        strip(F.col("p.value")).alias("documento_url"),
    )
    return out.where(F.col("documento_url").startswith("http")) if only_http else out

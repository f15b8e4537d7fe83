"""Paged API payloads and nested documents landed as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import explode_rows

MAP = "map<string,string>"


def explode_payload(df: DataFrame, payload: str, element: str | T.DataType = MAP) -> DataFrame:
    """``{recordsTotal, data: [...]}`` text to one row per element of ``data``.

    ``recordsTotal`` defaults to 0 and ``data`` to empty; text that is no JSON gives no rows.
    The element comes out as column ``record``, the rest of ``df`` is kept.
    """
    ddl = element if isinstance(element, str) else element.simpleString()
    parsed = F.from_json(payload, f"struct<recordsTotal: bigint, data: array<{ddl}>>")
    keep = [c for c in df.columns if c != payload]
    total = F.coalesce("_p.recordsTotal", F.lit(0).cast("bigint")).alias("records_total")
    return explode_rows(df.withColumn("_p", parsed), [*keep, total], F.col("_p.data"), "record")


def map_fields(record: Column, mapping: dict[str, str], null_when_missing: set[str] = frozenset()) -> list[Column]:
    """Rename the keys of a ``map<string,string>`` record into columns.

    A missing key gives '' (null for targets in ``null_when_missing``), an explicit null stays null.
    """
    out = []
    for field, target in mapping.items():
        absent = F.lit(None).cast("string") if target in null_when_missing else F.lit("")
        value = F.try_element_at(record, F.lit(field))
        out.append(F.when(F.map_contains_key(record, field), value).otherwise(absent).alias(target))
    return out


def page_plan(df: DataFrame, total: str, size: int = 1000) -> DataFrame:
    """One row per page still to be fetched: offsets 0, size, 2*size ... below ``total``."""
    last = F.col(total) - 1
    return df.where(F.col(total) > 0).withColumn(
        "page_offset", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(size).cast("bigint")))
    )


def document_request(df: DataFrame, size: int = 1000) -> DataFrame:
    """Request parameters of the document endpoint for every planned page."""
    params = {  # fixed values: parameter names and settings of the endpoint
        "paginacaoSimples": F.lit("false"),
        "tamanhoPagina": F.lit(str(size)),
        "offset": F.col("page_offset").cast("string"),
        "direcaoOrdenacao": F.lit("asc"),
        "colunaOrdenacao": F.lit("data"),
        "colunasSelecionadas": F.lit("data,fase,codigoDocumentoResumido,favorecido,valor"),
        "codigo": F.col("codigo_emenda"),
        "ano": F.col("ano"),
        "codigoFuncao": F.col("codigo_funcao"),
        "codigoSubfuncao": F.col("codigo_subfuncao"),
        "localidadeDoGasto": F.col("localidade_do_gasto"),
        "skTipoEmenda": F.col("sk_tipo_emenda"),
        "palavraChave": F.lit(""),
    }
    pairs = [x for name, value in params.items() for x in (F.lit(name), value)]
    return df.withColumn("params", F.create_map(*pairs))


def explode_revenue(files: DataFrame) -> DataFrame:
    """Revenue files to one row per record, keeping the nested classification."""
    return files.select(F.explode("registros.registro").alias("r")).select("r.*")


def revenue_movements(records: DataFrame, levels: list[str]) -> DataFrame:
    """One row per movement; records without movements stay, with nulls."""
    return records.select(
        F.col("receita.codigo").alias("receita"),
        F.col("unidadeGestora.codigo").alias("unidade"),
        F.col("unidadeGestora.denominacao").alias("unidade_nome"),
        F.col("exercicio.exercicio").alias("exercicio"),
        *[F.col(f"naturezaReceita.{lv}.denominacao").alias(lv) for lv in levels],
        F.explode_outer("listMovimentos").alias("m"),
    ).select("*", F.to_date("m.dataMovimento").alias("data_movimento"),
             F.col("m.tipoMovimento").alias("tipo_movimento"),
             F.col("m.valorMovimento").alias("valor_movimento")).drop("m")


def revenue_funds(records: DataFrame) -> DataFrame:
    """One row per funding source of a revenue record."""
    return records.select(
        F.col("receita.codigo").alias("receita"),
        F.explode_outer("listFonteRecursos").alias("f"),
    ).select("receita", F.col("f.codigo").alias("fonte"),
             F.col("f.denominacao").alias("fonte_nome"), F.col("f.percentual").alias("percentual"))


def unit_dictionary(df: DataFrame, payload: str) -> DataFrame:
    """``{pojo: {unidades: [{codigo, denominacaoPara}]}}`` to (code, name)."""
    unit = "struct<codigo: string, denominacaoPara: string>"
    parsed = F.from_json(payload, f"struct<pojo: struct<unidades: array<{unit}>>>")
    return explode_rows(df, [], parsed["pojo"]["unidades"], "u").select(
        F.col("u.codigo").alias("cod_unidade_gestora"),
        F.trim(F.replace("u.denominacaoPara", F.lit("para"), F.lit(""))).alias("nome_unidade_gestora"),
    )


def allowance_files(df: DataFrame, payload: str, base_url: str) -> DataFrame:
    """``{rows: [{arquivo, data_publicacao, descricao}]}`` to file records."""
    row = "struct<arquivo: string, data_publicacao: string, descricao: string>"
    parsed = F.from_json(payload, f"struct<rows: array<{row}>>")
    return explode_rows(df, [], parsed["rows"], "r").select(
        F.concat(F.lit(base_url), "r.arquivo").alias("url"),
        F.col("r.data_publicacao").alias("publication_date"),
        F.col("r.descricao").alias("description"),
        F.col("r.arquivo").alias("file_id"),
    )

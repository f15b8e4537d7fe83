"""Column functions over text derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators.profiling import date_category
from .registry import query, table

MONEY_TEXT = "translate(format_number(CAST(o_totalprice AS DECIMAL(18,2)), 2), ',.', '.,')"


def _orders(spark, d, text: str, out: Column, name: str) -> DataFrame:
    """Run a function over a text column derived from every order."""
    return table(spark, d, "orders").select("o_orderkey", F.expr(text).alias("raw")).select(
        "o_orderkey", out.alias(name)
    )




@query("brl_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (1, 2, 3, 4) THEN NULL
  ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS valor
FROM orders""")
def brl_parse(spark, d):
    text = f"""CASE o_orderkey % 10 WHEN 1 THEN '' WHEN 2 THEN '-' WHEN 3 THEN 'a definir'
      WHEN 4 THEN NULL WHEN 5 THEN 'R$ ' || {MONEY_TEXT} WHEN 6 THEN ' R$' || {MONEY_TEXT} || ' '
      ELSE {MONEY_TEXT} END"""
    return _orders(spark, d, text, fx.brl_money(F.col("raw")), "valor")


@query("pct_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (1, 2, 3) THEN NULL
  ELSE CAST(CAST(o_orderkey % 1000 AS DECIMAL(9,4)) / 10 AS DECIMAL(9,4)) END AS percentual
FROM orders""")
def pct_parse(spark, d):
    text = """CASE o_orderkey % 8 WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN '1.234,5%'
      ELSE CAST((o_orderkey % 1000) DIV 10 AS STRING) || ',' || CAST(o_orderkey % 10 AS STRING)
        || CASE WHEN o_orderkey % 2 = 0 THEN '%' ELSE ' % ' END END"""
    return _orders(spark, d, text, fx.pct(F.col("raw")), "percentual")


@query("date_parse_br", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (1, 2, 3) THEN NULL
  ELSE CAST(o_orderdate AS DATE) END AS data
FROM orders""")
def date_parse_br(spark, d):
    text = """CASE o_orderkey % 9 WHEN 1 THEN '31/02/2024' WHEN 2 THEN '-' WHEN 3 THEN '2024-01-05'
      WHEN 4 THEN date_format(o_orderdate, 'd/M/yyyy')
      ELSE date_format(o_orderdate, 'dd/MM/yyyy') END"""
    return _orders(spark, d, text, fx.date_br(F.col("raw")), "data")


@query("days_extract", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (1, 2) THEN NULL ELSE o_orderkey % 400 END AS dias
FROM orders""")
def days_extract(spark, d):
    text = """CASE o_orderkey % 6 WHEN 1 THEN 'indeterminado' WHEN 2 THEN '-'
      WHEN 3 THEN 'prazo de ' || (o_orderkey % 400) || ' DIAS corridos, depois 15 dias'
      WHEN 4 THEN (o_orderkey % 400) || 'dia'
      ELSE (o_orderkey % 400) || '  dias' END"""
    return _orders(spark, d, text, fx.days(F.col("raw")), "dias")


@query("clean_text", r"""
WITH c AS (SELECT doc_id, text AS raw FROM documents
  UNION ALL SELECT -1 - doc_id, CASE doc_id % 3 WHEN 0 THEN ' - ' WHEN 1 THEN '' ELSE chr(160) || ' a ' || chr(9) || chr(10) || 'b ' END FROM documents)
SELECT doc_id, nullif(nullif(regexp_replace(regexp_replace(regexp_replace(raw,
   '^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ''),
   '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', ''),
   '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'),
   ''), '-') AS texto
FROM c""")
def clean_text(spark, d):
    documents = table(spark, d, "documents")
    awkward = F.expr("CASE doc_id % 3 WHEN 0 THEN ' - ' WHEN 1 THEN '' ELSE concat(chr(160), ' a ', chr(9), chr(10), 'b ') END")
    raw = documents.select("doc_id", F.col("text").alias("raw")).union(documents.select(-1 - F.col("doc_id"), awkward))
    return raw.select("doc_id", fx.clean_text(F.col("raw")).alias("texto"))


@query("modality_type", """
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'PREGÃO' WHEN 1 THEN 'TOMADA DE PREÇO' WHEN 2 THEN 'CARTA PROPOSTA'
  WHEN 3 THEN 'CONVITE' WHEN 4 THEN 'DISPENSA' WHEN 5 THEN upper(split_part(o_orderpriority, ' ', 1))
  WHEN 6 THEN NULL ELSE 'PREGÃO' END AS modalidade
FROM orders""")
def modality_type(spark, d):
    text = """CASE o_orderkey % 8 WHEN 0 THEN 'Pregão Eletrônico ' || o_orderkey WHEN 1 THEN 'TP ' || o_orderkey || '/2020'
      WHEN 2 THEN ' cp 1' WHEN 3 THEN 'Cv' WHEN 4 THEN 'DISP 4/2021' WHEN 5 THEN o_orderpriority
      WHEN 6 THEN '' ELSE 'PREG 7' END"""
    return _orders(spark, d, text, fx.modality(F.col("raw")), "modalidade")


@query("doc_type", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'CNPJ' WHEN 1 THEN 'CPF' WHEN 2 THEN 'IRRGULAR'
  WHEN 3 THEN NULL ELSE 'CNPJ' END AS tipo
FROM orders""")
def doc_type(spark, d):
    text = """CASE o_orderkey % 5 WHEN 0 THEN lpad(o_orderkey, 8, '0') || '/0001-00'
      WHEN 1 THEN '123.' || lpad(o_orderkey % 1000, 3, '0') || '.789-00' WHEN 2 THEN 'isento'
      WHEN 3 THEN '' ELSE lpad(o_custkey, 14, '0') END"""
    return _orders(spark, d, text, fx.doc_kind(F.col("raw")), "tipo")


@query("payee_split", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 6 = 0 THEN '123' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '78900'
       WHEN o_orderkey % 6 IN (1, 2) THEN NULL
       ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '000199' END AS id,
  CASE WHEN o_orderkey % 6 = 0 THEN 'PESSOA ' || o_custkey WHEN o_orderkey % 6 = 1 THEN 'FAVORECIDO COLETIVO'
       WHEN o_orderkey % 6 = 2 THEN NULL WHEN o_orderkey % 6 = 3 THEN NULL
       ELSE 'FUNDO - ' || o_custkey END AS nome,
  CASE WHEN o_orderkey % 6 = 0 THEN 'CPF' WHEN o_orderkey % 6 = 1 THEN 'outro' WHEN o_orderkey % 6 = 2 THEN NULL
       ELSE 'CNPJ' END AS tipo
FROM orders""")
def payee_split(spark, d):
    base = "lpad(o_custkey, 8, '0')"
    dotted = f"substr({base},1,2) || '.' || substr({base},3,3) || '.' || substr({base},6,3) || '/0001-99'"
    text = f"""CASE o_orderkey % 6
      WHEN 0 THEN '123.' || lpad(o_orderkey % 1000, 3, '0') || '.789-00 - PESSOA ' || o_custkey
      WHEN 1 THEN 'FAVORECIDO COLETIVO' WHEN 2 THEN NULL WHEN 3 THEN {base} || '000199'
      ELSE {dotted} || ' - FUNDO - ' || o_custkey END"""
    out = table(spark, d, "orders").select("o_orderkey", fx.split_payee(F.expr(text)).alias("p"))
    return out.select("o_orderkey", F.col("p.id").alias("id"), F.col("p.name").alias("nome"), F.col("p.kind").alias("tipo"))


@query("status_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'CONCLUIDA' WHEN 'O' THEN 'EM_ANDAMENTO'
  ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'RESCINDIDA' WHEN o_orderkey % 3 = 1 THEN 'PARALISADA' END END AS situacao
FROM orders""")
def status_map(spark, d):
    text = """CASE o_orderstatus WHEN 'F' THEN 'Concluída' WHEN 'O' THEN 'em Andamento'
      ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Contrato Rescindido' WHEN 1 THEN 'Paralisada' ELSE 'Em projeto' END END"""
    return _orders(spark, d, text, fx.status_code(F.col("raw")), "situacao")


@query("bin_cut", """
WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL
   ELSE CAST(CAST(o_orderkey % 1100 AS DECIMAL(18,1)) / 10 AS DECIMAL(9,4)) END AS v FROM orders)
SELECT o_orderkey, CASE WHEN v <= 25 THEN '0-25%' WHEN v <= 50 THEN '25-50%' WHEN v <= 75 THEN '50-75%'
  WHEN v <= 100 THEN '75-100%' END AS faixa
FROM p""")
def bin_cut(spark, d):
    value = F.expr("CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(o_orderkey % 1100 AS DECIMAL(18,1)) / 10 AS DECIMAL(9,4)) END")
    return table(spark, d, "orders").select("o_orderkey", fx.pct_band(value).alias("faixa"))


@query("lattes_date", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d%m%Y') || 'x' WHEN 1 THEN ''
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS data
FROM orders""")
def lattes_date(spark, d):
    text = """CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'ddMMyyyy') || 'x' WHEN 1 THEN NULL
      ELSE date_format(o_orderdate, 'ddMMyyyy') END"""
    return _orders(spark, d, text, fx.compact_date(F.col("raw")), "data")


@query("doc_phase", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'N' THEN 'NE' WHEN 'A' THEN 'NS' ELSE 'OB' END AS tipo,
  CASE l_returnflag WHEN 'N' THEN 'Empenho' WHEN 'A' THEN 'Liquidação' ELSE 'Pagamento' END AS fase
FROM lineitem""")
def doc_phase(spark, d):
    code = F.expr("""date_format(l_shipdate, 'yyyy') || CASE l_returnflag WHEN 'N' THEN 'NE' WHEN 'A' THEN 'NS'
      ELSE 'OB' END || lpad(l_orderkey % 1000000, 6, '0')""")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", fx.document_type(code).alias("tipo"), fx.document_phase(code).alias("fase")
    )


# Text that is pure ISO-8859-1 but already proper stays; doubly encoded text is restored,
# so both variants must come back as the (stripped) original.
@query("mojibake_fix", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}]', '', 'g'),
   '^[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ''),
   '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '') AS texto
FROM documents""")
def mojibake_fix(spark, d):
    garbled = F.when(F.col("doc_id") % 2 == 0, F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", fx.fix_mojibake(garbled).alias("texto"))


CODE = """CASE WHEN o_orderkey % 7 = 0 THEN 'S/I' WHEN o_orderkey % 11 = 0 THEN 'REL. GERAL'
  ELSE year(o_orderdate) || lpad(CAST(o_custkey AS VARCHAR(20)), 5, '0')
       || lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 3, '0') END"""


@query("valid_code_filter", f"""
SELECT o_orderkey, codigo_emenda FROM (SELECT o_orderkey, {CODE} AS codigo_emenda FROM orders)
WHERE regexp_full_match(codigo_emenda, '[0-9]{{10,14}}')""")
def valid_code_filter(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.expr(CODE).alias("codigo_emenda"))
    return rows.where(fx.is_valid_code(F.col("codigo_emenda")))


@query("valid_code_rejects", f"""
SELECT codigo_emenda, count(*) AS linhas FROM (SELECT o_orderkey, {CODE} AS codigo_emenda FROM orders)
WHERE NOT regexp_full_match(codigo_emenda, '[0-9]{{10,14}}') GROUP BY codigo_emenda""")
def valid_code_rejects(spark, d):
    from ..operators.joins import valid_amendments

    rows = table(spark, d, "orders").select("o_orderkey", F.expr(CODE).alias("codigo_emenda"))
    _, rejected = valid_amendments(rows)
    return rejected.groupBy("codigo_emenda").agg(F.count("*").alias("linhas"))


@query("emenda_code_split", f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS ano, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS autor,
  lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS sequencial
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""")
def emenda_code_split(spark, d):
    rows = valid_code_filter(spark, d)
    parts = fx.split_amendment_code(F.col("codigo_emenda"))
    return rows.select("o_orderkey", parts["year"].alias("ano"), parts["author"].alias("autor"),
                       parts["sequence"].alias("sequencial"))


@query("code_name_split", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS codigo,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name || ' - ' || c_mktsegment END AS nome
FROM customer""")
def code_name_split(spark, d):
    text = F.expr("""lpad(c_custkey, 8, '0') || CASE WHEN c_custkey % 5 = 0 THEN ''
      ELSE ' - ' || c_name || ' - ' || c_mktsegment END""")
    parts = fx.code_name(text)
    return table(spark, d, "customer").select("c_custkey", parts["code"].alias("codigo"), parts["name"].alias("nome"))


@query("sha_id", "SELECT page_id, substr(sha256(url), 1, 16) AS obra_id FROM pages")
def sha_id(spark, d):
    return table(spark, d, "pages").select("page_id", fx.short_id(F.col("url")).alias("obra_id"))


@query("ingest_id", """
SELECT event_id, 'ingest_' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS ingest_id FROM events""")
def ingest_id(spark, d):
    return table(spark, d, "events").select("event_id", fx.ingest_id(F.col("event_type"), F.col("ts")).alias("ingest_id"))


DATE_FIELD = """CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN ' - '
  WHEN 2 THEN {date} || ' Rescisão unilateral (termo ' || o_custkey || ')' WHEN 3 THEN 'PARALISAÇÃO (' || {date} || ') REINÍCIO ' || {date}
  WHEN 4 THEN 'paralisacao em ' || {date} WHEN 5 THEN {date} WHEN 6 THEN 'em obras' ELSE {date} || ' ' END"""
SPARK_DATE_FIELD = DATE_FIELD.replace("{date}", "date_format(o_orderdate, 'dd/MM/yyyy')")
DUCK_DATE_FIELD = DATE_FIELD.replace("{date}", "strftime(o_orderdate, '%d/%m/%Y')")


@query("date_field_category", """
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'VAZIO_OU_HIFEN' WHEN 1 THEN 'VAZIO_OU_HIFEN'
  WHEN 2 THEN 'DATA_COM_TERMO_RESCISAO' WHEN 3 THEN 'HISTORICO_COMPLETO' WHEN 4 THEN 'DATA_COM_PARALISACAO'
  WHEN 6 THEN 'OUTRO_FORMATO' ELSE 'DATA_SIMPLES' END AS categoria
FROM orders""")
def date_field_category(spark, d):
    return _orders(spark, d, SPARK_DATE_FIELD, date_category(F.col("raw")), "categoria")

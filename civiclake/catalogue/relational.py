"""Joins, rollups, quality rules and profiles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins, profiling, quality, ranking, rollups
from ..operators.quality import Rule
from ..plans.silver import silver_amendments
from ..plans.upsert import read_silver, update_silver
from ..plans.wap import Ledger
from ..session import scratch_path
from ..sources import files, payload
from ..sources.schemas import REVENUE_LEVELS, revenue_file
from .parsing import DUCK_DATE_FIELD, MONEY_TEXT, SPARK_DATE_FIELD
from .registry import ORACLES, query, table

# Amendment side = orders, document side = lineitem; both derive the code from the order key.
VALID = "{k} % 7 <> 0 AND {k} % 11 <> 0"
CODE = """CASE WHEN {k} % 7 = 0 THEN 'S/I' WHEN {k} % 11 = 0 THEN 'REL. GERAL'
  ELSE '2024' || lpad(CAST({k} AS VARCHAR(20)), 10, '0') END"""
ORDER_CODE, LINE_CODE = CODE.format(k="o_orderkey"), CODE.format(k="l_orderkey")
PHASE = "CASE l_returnflag WHEN 'N' THEN 'Empenho' WHEN 'A' THEN 'Liquidação' ELSE 'Pagamento' END"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
PAYEE_BASE = "lpad(CAST(l_suppkey AS VARCHAR(20)), 8, '0')"


def _amendments(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.expr(ORDER_CODE).alias("codigo_emenda"), F.col("o_custkey").alias("autor"), F.col("o_orderpriority").alias("funcao"))


def _documents(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.expr(LINE_CODE).alias("codigo_emenda"), F.expr(PHASE).alias("fase_documento"), F.expr(PRICE).alias("valor"),
        F.col("l_linenumber").alias("documento"), "l_shipdate")


@query("amend_doc_join", f"""
SELECT '2024' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS codigo_emenda, o_custkey AS autor, o_orderpriority AS funcao,
  l_linenumber AS documento, {PHASE} AS fase_documento, {PRICE} AS valor, l_shipdate
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE {VALID.format(k="o_orderkey")}""")
def amend_doc_join(spark, d):
    return joins.amend_documents(_amendments(spark, d), _documents(spark, d))


@query("execution_rollup", f"""
SELECT '2024' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS codigo_emenda, count(*) AS documentos,
  CAST(sum({PRICE}) AS DECIMAL(28,2)) AS valor_total,
  CAST(coalesce(sum({PRICE}) FILTER ({PHASE} = 'Pagamento'), 0) AS DECIMAL(28,2)) AS valor_pago
FROM lineitem WHERE {VALID.format(k="l_orderkey")} GROUP BY l_orderkey""")
def execution_rollup(spark, d):
    valid, _ = joins.valid_amendments(_documents(spark, d))
    return rollups.execution_rollup(valid)


@query("phase_pivot", f"""
SELECT '2024' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS codigo_emenda,
  CAST(coalesce(sum({PRICE}) FILTER (l_returnflag = 'N'), 0) AS DECIMAL(28,2)) AS valor_empenho,
  CAST(coalesce(sum({PRICE}) FILTER (l_returnflag = 'A'), 0) AS DECIMAL(28,2)) AS valor_liquidacao,
  CAST(coalesce(sum({PRICE}) FILTER (l_returnflag = 'R'), 0) AS DECIMAL(28,2)) AS valor_pagamento
FROM lineitem WHERE {VALID.format(k="l_orderkey")} GROUP BY l_orderkey""")
def phase_pivot(spark, d):
    valid, _ = joins.valid_amendments(_documents(spark, d))
    return rollups.phase_pivot(valid)


def _establishments(spark, d) -> DataFrame:
    return table(spark, d, "supplier").selectExpr(
        "lpad(CAST(s_suppkey AS STRING), 8, '0') AS cnpj_basico", "'0001' AS cnpj_ordem", "'00' AS cnpj_dv",
        "s_name AS nome_fantasia", "CAST(s_nationkey AS STRING) AS uf")


@query("company_match", f"""
SELECT l_orderkey, l_linenumber, {PRICE} AS valor, {PAYEE_BASE} || '000100' AS cnpj, s_name AS nome_fantasia
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_orderkey % 10 <> 3 AND l_orderkey % 11 <> 4""")
def company_match(spark, d):
    payments = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(PRICE).alias("valor"),
        F.expr(f"""CASE WHEN l_orderkey % 10 = 3 THEN 'FAVORECIDO COLETIVO' WHEN l_orderkey % 11 = 4 THEN '123.456.789-00 - FULANO'
          ELSE substr({PAYEE_BASE},1,2) || '.' || substr({PAYEE_BASE},3,3) || '.' || substr({PAYEE_BASE},6,3) || '/0001-00 - FORNECEDOR' END""").alias("favorecido"))
    matched = joins.company_match(payments, _establishments(spark, d))
    return matched.select("l_orderkey", "l_linenumber", "valor", "cnpj", "nome_fantasia")


@query("partner_network", """
WITH sites AS (SELECT l_suppkey, count(*) AS establishments, count(DISTINCT l_returnflag) AS states FROM lineitem GROUP BY l_suppkey)
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS nome_socio, s_name AS razao_social,
  coalesce(establishments, 0) AS establishments, coalesce(states, 0) AS states
FROM customer JOIN supplier ON c_custkey = s_suppkey LEFT JOIN sites ON l_suppkey = s_suppkey
UNION ALL
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 'Pedido ' || o_orderkey, s_name, coalesce(establishments, 0), coalesce(states, 0)
FROM orders JOIN supplier ON o_custkey = s_suppkey LEFT JOIN sites ON l_suppkey = s_suppkey""")
def partner_network(spark, d):
    companies = table(spark, d, "supplier").selectExpr("lpad(CAST(s_suppkey AS STRING), 8, '0') AS cnpj_basico", "s_name AS razao_social")
    sites = table(spark, d, "lineitem").selectExpr("lpad(CAST(l_suppkey AS STRING), 8, '0') AS cnpj_basico", "l_returnflag AS uf")
    partners = table(spark, d, "customer").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 8, '0') AS cnpj_basico", "c_name AS nome_socio",
    ).unionByName(table(spark, d, "orders").selectExpr(
        "lpad(CAST(o_custkey AS STRING), 8, '0') AS cnpj_basico", "'Pedido ' || o_orderkey AS nome_socio"))
    return joins.partner_network(companies, sites, partners)


def _two_loads(old: DataFrame, new: DataFrame) -> DataFrame:
    """A registry that was loaded twice."""
    load = lambda df, day: df.withColumn("data_extracao", F.lit(day).cast("timestamp"))
    return load(old, "2024-01-01").unionByName(load(new, "2024-02-01"))


@query("company_match_repeats", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || ' (novo)' END AS nome_fantasia
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def company_match_repeats(spark, d):
    """Establishments of two monthly loads: the newer row of an id counts, one that was not loaded again stays."""
    payments = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(f"{PAYEE_BASE} || '000100'").alias("favorecido"))
    sites = _establishments(spark, d)
    again = sites.where("CAST(cnpj_basico AS INT) % 3 <> 0").withColumn("nome_fantasia", F.concat("nome_fantasia", F.lit(" (novo)")))
    matched = joins.company_match(payments, _two_loads(sites, again))
    return matched.select("l_orderkey", "l_linenumber", "nome_fantasia")


@query("partner_network_repeats", """
WITH sites AS (SELECT l_suppkey, count(*) AS establishments, count(DISTINCT l_returnflag) AS states FROM lineitem GROUP BY l_suppkey)
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico, 'Pedido ' || o_orderkey AS nome_socio, s_name || ' (novo)' AS razao_social,
  coalesce(establishments, 0) AS establishments, coalesce(states, 0) AS states
FROM orders JOIN supplier ON o_custkey = s_suppkey LEFT JOIN sites ON l_suppkey = s_suppkey""")
def partner_network_repeats(spark, d):
    """All three registries loaded twice, co-located on the company: nothing counts twice and nothing is shuffled but the result of the load."""
    key = "lpad(CAST({0} AS STRING), 8, '0') AS cnpj_basico"
    companies = table(spark, d, "supplier").selectExpr(key.format("s_suppkey"), "s_name AS razao_social")
    sites = table(spark, d, "lineitem").selectExpr(key.format("l_suppkey"), "l_returnflag AS uf")
    partners = table(spark, d, "orders").selectExpr(key.format("o_custkey"), "'Pedido ' || o_orderkey AS nome_socio")
    renamed = companies.withColumn("razao_social", F.concat("razao_social", F.lit(" (novo)")))
    root = scratch_path(spark, "registry-tables")
    loaded = {"empresas": _two_loads(companies, renamed), "estabelecimentos": _two_loads(sites, sites), "socios": _two_loads(partners, partners)}
    name = root.rsplit("-", 1)[1]
    tables = [files.write_colocated(df, f"{t}_{name}", "cnpj_basico", 8, f"{root}/{t}") for t, df in loaded.items()]
    return joins.partner_network(*tables).select("cnpj_basico", "nome_socio", "razao_social", "establishments", "states")


SECTOR = "9491000"


def _sector_sites(spark, d) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS cnpj_basico", "p_name AS nome_fantasia",
        "CASE p_size % 5 WHEN 0 THEN '9491000' ELSE '84' || lpad(CAST(p_size AS STRING), 5, '0') END AS cnae_fiscal_principal")


@query("sector_filter", "SELECT CAST(p_partkey AS VARCHAR) AS cnpj_basico, p_name AS nome_fantasia FROM part WHERE p_size % 5 = 0")
def sector_filter(spark, d):
    return joins.sector_filter(_sector_sites(spark, d), SECTOR).select("cnpj_basico", "nome_fantasia")


@query("sector_semi_join", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS cnpj_basico FROM lineitem
WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size % 5 = 0)""")
def sector_semi_join(spark, d):
    payments = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("cnpj_basico"))
    return joins.in_sector(payments, _sector_sites(spark, d), SECTOR)


@query("relationship_report", """
SELECT 'customer sem pedido' AS relacao, count(*) AS chaves, CAST(coalesce(sum(n), 0) AS BIGINT) AS linhas FROM
 (SELECT c_custkey, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY 1)
UNION ALL SELECT 'item sem pedido aberto', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM
 (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1)
UNION ALL SELECT 'documento sem rotulo', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM
 (SELECT doc_id, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1)""")
def relationship_report(spark, d):
    checks = {
        "customer sem pedido": ("customer", "c_custkey", table(spark, d, "orders"), "o_custkey"),
        "item sem pedido aberto": ("lineitem", "l_orderkey", table(spark, d, "orders").where("o_orderstatus = 'O'"), "o_orderkey"),
        "documento sem rotulo": ("documents", "doc_id", table(spark, d, "labels"), "doc_id"),
    }
    return rollups.union_all([
        joins.orphans(table(spark, d, child), key, parent, parent_key).agg(
            F.count("*").alias("chaves"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("linhas"),
        ).select(F.lit(name).alias("relacao"), "chaves", "linhas")
        for name, (child, key, parent, parent_key) in checks.items()
    ])


@query("unit_lookup", """
SELECT c_custkey, c_nationkey AS cod_unidade, n_name AS nome_unidade FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def unit_lookup(spark, d):
    facts = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("cod_unidade"))
    units = table(spark, d, "nation").select(F.col("n_nationkey").alias("cod_unidade"), F.col("n_name").alias("nome_unidade"))
    return joins.unit_lookup(facts, units, "cod_unidade")


ADHOC = """
SELECT r_name AS regiao, o_orderstatus AS situacao, count(*) AS pedidos, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS valor
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE o_orderpriority <> '5-LOW' GROUP BY r_name, o_orderstatus"""


@query("adhoc_sql", ADHOC)
def adhoc_sql(spark, d):
    for name in ("orders", "customer", "nation", "region"):
        table(spark, d, name).createOrReplaceTempView(name)
    return spark.sql(ADHOC)


CATALOGUED = sorted("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                    "labels conversations".split())


@query("catalog_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in CATALOGUED))
def catalog_tables(spark, d):
    for name in CATALOGUED:
        table(spark, d, name).createOrReplaceTempView(name)
    listed = [r["tableName"] for r in spark.sql("SHOW TABLES").collect() if r["isTemporary"]]
    return rollups.union_all([
        spark.table(t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in sorted(listed) if t in CATALOGUED
    ])


# -- revenue ---------------------------------------------------------------------

def _revenue_records(spark, d) -> DataFrame:
    """Revenue files, one per order, parsed and exploded to records."""
    money = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + i AS STRING)"
    levels = ", ".join(
        f"'{lv}', named_struct('codigo', '{n}', 'denominacao', concat('{lv[:3]} ', {'o_orderstatus' if n == 0 else 'o_orderpriority'}))"
        for n, lv in enumerate(REVENUE_LEVELS))
    body = f"""concat('{{"informacao":"Receita","totalRegistros":1,"registros":[{{"registro":', to_json(named_struct(
      'receita', named_struct('codigo', o_orderkey, 'tipoReceita', 'Bruta'),
      'unidadeGestora', named_struct('codigo', o_custkey, 'denominacao', concat('Fundo ', o_custkey)),
      'naturezaReceita', named_struct({levels}),
      'listFonteRecursos', array(named_struct('codigo', 101, 'denominacao', 'Próprios', 'percentual', 100.0D)),
      'exercicio', named_struct('exercicio', year(o_orderdate)))),
      '}}]}}')"""
    moves = f"""concat('"listMovimentos":[', array_join(transform(
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE sequence(1L, o_orderkey % 3) END, i -> concat('{{"dataMovimento":"',
      date_format(date_add(CAST(o_orderdate AS DATE), CAST(i AS INT)), 'yyyy-MM-dd'), '","tipoMovimento":"Arrecadação","valorMovimento":', {money}, '}}')), ','), '],')"""
    landed = table(spark, d, "orders").select(
        F.expr(body).alias("body"), F.expr(moves).alias("moves")
    ).select(F.concat(
        F.substring_index("body", '"exercicio":{', 1), "moves", F.lit('"exercicio":{'), F.substring_index("body", '"exercicio":{', -1),
    ).alias("body"))
    files = landed.select(F.from_json("body", revenue_file()).alias("f")).select("f.*")
    return payload.explode_revenue(files)


@query("revenue_explode", """
SELECT o_orderkey AS receita, o_custkey AS unidade, CAST(year(o_orderdate) AS INTEGER) AS exercicio, 'cat ' || o_orderstatus AS "categoriaEconomica",
  'ori ' || o_orderpriority AS origem, CASE WHEN g IS NULL THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(g AS INTEGER) END AS data_movimento,
  CASE WHEN g IS NULL THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + g AS DECIMAL(18,2)) END AS valor_movimento
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 3 = 0 THEN [NULL] ELSE generate_series(1, o_orderkey % 3) END) AS g FROM orders)""")
def revenue_explode(spark, d):
    moved = payload.revenue_movements(_revenue_records(spark, d), ["categoriaEconomica", "origem"])
    return moved.select("receita", "unidade", "exercicio", "categoriaEconomica", "origem", "data_movimento", "valor_movimento")


@query("revenue_funds", """
SELECT o_orderkey AS receita, CAST(101 AS BIGINT) AS fonte, 'Próprios' AS fonte_nome, CAST(100 AS DECIMAL(9,4)) AS percentual FROM orders""")
def revenue_funds(spark, d):
    return payload.revenue_funds(_revenue_records(spark, d))


@query("revenue_rollup", f"""
SELECT r_name AS regiao, n_name AS unidade, CAST(year(l_shipdate) AS INTEGER) AS ano,
  CAST(grouping(r_name) * 4 + grouping(n_name) * 2 + grouping(year(l_shipdate)) AS BIGINT) AS nivel,
  CAST(sum({PRICE}) AS DECIMAL(28,2)) AS valor, count(*) AS movimentos
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, year(l_shipdate))""")
def revenue_rollup(spark, d):
    moves = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("ano"), F.expr(PRICE).alias("valor"))
    units = table(spark, d, "supplier").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "s_suppkey", F.col("n_name").alias("unidade"), F.col("r_name").alias("regiao"))
    # totals per unit key first: the join then sees one row per unit and year
    per_unit = moves.groupBy("s_suppkey", "ano").agg(F.sum("valor").alias("valor"), F.count("valor").alias("n"))
    return rollups.revenue_rollup(per_unit.join(units, "s_suppkey"), ["regiao", "unidade", "ano"], "valor", "n")


# -- counts and profiles ------------------------------------------------------------

LABELLED = "documents LEFT JOIN labels ON documents.doc_id = labels.doc_id"
LABELLED_COLUMNS = {"doc_id": "documents.doc_id", **{c: c for c in ("text", "lang", "source", "n_chars", "quality", "toxic")}}


def _labelled(spark, d) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({q}) AS non_null, count(*) - count({q}) AS nulls FROM {LABELLED}"
    for c, q in LABELLED_COLUMNS.items()))
def null_counts(spark, d):
    return rollups.null_counts(_labelled(spark, d), list(LABELLED_COLUMNS))


@query("dup_keys", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark, d):
    return rollups.duplicate_keys(table(spark, d, "events"), ["user_id", "event_type"])


@query("dup_extra_rows", """
SELECT count(*) AS dup_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def dup_extra_rows(spark, d):
    return rollups.duplicate_summary(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


NOTE = "CASE WHEN quality IS NULL THEN NULL WHEN {k} % 5 = 0 THEN ' - ' WHEN {k} % 5 = 1 THEN 'NA' ELSE lang END"


def _duck_completeness() -> str:
    columns = {**LABELLED_COLUMNS, "nota": NOTE.format(k="documents.doc_id")}
    parts = []
    for name, c in columns.items():
        empty = f"count(*) FILTER (trim({c}) IN ('', '-', 'NA', 'None'))" if name in ("text", "lang", "source", "nota") else "0"
        parts.append(f"SELECT '{name}' AS column_name, count(*) AS t, count(*) FILTER (({c}) IS NULL) AS nulls, {empty} AS empty FROM {LABELLED}")
    union = " UNION ALL ".join(parts)
    return f"""SELECT column_name, t - nulls - empty AS valid, nulls, CAST(empty AS BIGINT) AS empty,
      CAST(round(CAST((t - nulls - empty) * 100 AS DECIMAL(24,6)) / CAST(t AS DECIMAL(12,0)), 2) AS DECIMAL(5,2)) AS pct_complete FROM ({union})"""


def _profiled(spark, d) -> DataFrame:
    return profiling.completeness(
        _labelled(spark, d).select(*LABELLED_COLUMNS, F.expr(NOTE.format(k="doc_id")).alias("nota")))


@query("completeness_profile", _duck_completeness())
def completeness_profile(spark, d):
    return _profiled(spark, d)


@query("completeness_low", f"SELECT column_name, pct_complete FROM ({_duck_completeness()}) WHERE pct_complete < 80")
def completeness_low(spark, d):
    return _profiled(spark, d).where("pct_complete < 80").select("column_name", "pct_complete")


def _dated(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.expr(SPARK_DATE_FIELD).alias("data_conclusao"))


@query("mixed_field_score", f"""
SELECT 'data_conclusao' AS column_name, CAST((CASE WHEN dt > 0 THEN 20 ELSE 0 END) + (CASE WHEN pr > 0 THEN 30 ELSE 0 END)
  + (CASE WHEN k1 + k2 + k3 + k4 + k5 > 0 THEN 25 ELSE 0 END) + (CASE WHEN un * 2 > total THEN 25 ELSE 0 END) AS INTEGER) AS score,
  dt AS with_date, pr AS with_parentheses, total, un AS distinct_values,
  'PARALISACAO=' || k3 || ';PARALISAÇÃO=' || k2 || ';RESCISÃO=' || k1 || ';TERMO=' || k4 || ';UNILATERAL=' || k5 AS keywords
FROM (SELECT count(*) FILTER (regexp_matches(v, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')) AS dt, count(*) FILTER (regexp_matches(v, '\\([^)]+\\)')) AS pr,
  count(*) FILTER (upper(v) LIKE '%RESCISÃO%') AS k1, count(*) FILTER (upper(v) LIKE '%PARALISAÇÃO%') AS k2,
  count(*) FILTER (upper(v) LIKE '%PARALISACAO%') AS k3, count(*) FILTER (upper(v) LIKE '%TERMO%') AS k4,
  count(*) FILTER (upper(v) LIKE '%UNILATERAL%') AS k5, count(v) AS total, count(DISTINCT v) AS un
  FROM (SELECT {DUCK_DATE_FIELD} AS v FROM orders))""")
def mixed_field_score(spark, d):
    scored = profiling.mixed_score(_dated(spark, d), "data_conclusao")
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("keywords")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return scored.withColumn("keywords", listed)


# Declared status against physical and financial progress of every order.
def _works(spark, d) -> DataFrame:
    paid = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.expr(PRICE)).cast("decimal(18,2)").alias("pago"))
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.expr("CASE o_orderstatus WHEN 'F' THEN 'Contrato rescindido' WHEN 'O' THEN 'em Andamento' END").alias("situacao"),
        F.expr("CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DECIMAL(9,4)) END").alias("percentual"),
        F.expr("CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2))").alias("contratado"),
        F.expr(SPARK_DATE_FIELD).alias("data_conclusao"))
    return orders.join(paid, "o_orderkey", "left")


def _flagged(spark, d) -> DataFrame:
    return profiling.status_flags(_works(spark, d), "situacao", "percentual", "contratado", "pago")


DUCK_FLAGGED = f"""
SELECT *, CAST(len(fl) AS INTEGER) AS severity FROM (SELECT *, list_filter([
    CASE WHEN rescindida AND percentual >= 95 THEN 'FISICA_COMPLETA' END, CASE WHEN rescindida AND fin >= 95 THEN 'FINANCEIRA_COMPLETA' END,
    CASE WHEN fin > 150 THEN 'VALOR_EXCEDIDO' END], lambda x: x IS NOT NULL) AS fl
 FROM (SELECT o_orderkey, o_orderstatus = 'F' AS rescindida, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 101 END AS percentual,
    CASE WHEN o_orderkey % 13 = 0 OR o_totalprice <= 0 THEN 0 ELSE coalesce(CAST(pago AS DOUBLE) * 100 / o_totalprice, 0) END AS fin
  FROM orders LEFT JOIN (SELECT l_orderkey, sum({PRICE}) AS pago FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)) WHERE len(fl) > 0"""


@query("status_inconsistency", f"""
SELECT o_orderkey, array_to_string(fl, ',') AS flags, severity, CAST(round(CAST(fin AS DECIMAL(18,4)), 0) AS BIGINT) AS financeiro,
  CASE WHEN list_contains(fl, 'FISICA_COMPLETA') THEN 'Rescindida mas ' || percentual || '.0% concluída' END AS descricao
FROM ({DUCK_FLAGGED})""")
def status_inconsistency(spark, d):
    physical = F.when(F.array_contains("flags", "FISICA_COMPLETA"), F.get("descriptions", F.lit(0)))
    return _flagged(spark, d).select(
        "o_orderkey", F.array_join("flags", ",").alias("flags"), "severity",
        F.round("financial_pct", 0).cast("bigint").alias("financeiro"), physical.alias("descricao"))


@query("top_severity", f"SELECT o_orderkey, severity FROM ({DUCK_FLAGGED}) ORDER BY severity DESC, o_orderkey LIMIT 3")
def top_severity(spark, d):
    return ranking.top_n(_flagged(spark, d).select("o_orderkey", "severity"), [F.desc("severity"), F.asc("o_orderkey")], 3)


@query("exec_summary", f"""
SELECT total, mixed_fields, full_histories, missing, n AS inconsistencies,
  CAST(round(CAST(n * 100 AS DECIMAL(24,6)) / CAST(total AS DECIMAL(12,0)), 1) AS DECIMAL(5,1)) AS pct_inconsistent
FROM (SELECT count(*) AS total, count(*) FILTER (o_orderkey % 8 IN (2, 3, 4, 5, 7)) AS mixed_fields,
   count(*) FILTER (o_orderkey % 8 = 3) AS full_histories,
   count(*) FILTER (coalesce(trim({DUCK_DATE_FIELD}), '-') IN ('', '-')) AS missing FROM orders), (SELECT count(*) AS n FROM ({DUCK_FLAGGED}))""")
def exec_summary(spark, d):
    return profiling.executive_summary(_dated(spark, d), "data_conclusao", _flagged(spark, d))


# -- rules and gate -------------------------------------------------------------------

NOW = datetime(2024, 3, 15)
NOT_NULL_RULES = [Rule("documents", c, "not_null", s) for c, s in
                  [("doc_id", "error"), ("source", "error"), ("quality", "error"), ("toxic", "warn")]]
UNIQUE_RULES = [Rule("documents", "doc_id", "unique"), Rule("events", "user_id", "unique", "warn"), Rule("documents", "text", "unique", "warn")]
FRESH_RULES = [Rule("events", "ts", "freshness", "warn", max_age_days=90), Rule("orders", "o_orderdate", "freshness", "warn", max_age_days=90)]
DUCK_STATUS = "CASE WHEN failures = 0 THEN 'PASS' WHEN severity = 'error' THEN 'FAIL' ELSE 'WARN' END AS status"


def _duck_rules(parts: list[tuple[str, str, str, str, str]]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS kind, '{s}' AS severity, CAST(({sql}) AS BIGINT) AS failures"
        for t, c, k, s, sql in parts)
    return f"SELECT *, {DUCK_STATUS} FROM ({union})"


def _duck_unique(t: str, c: str) -> str:
    return f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


DUCK_NOT_NULL = [("documents", c, "not_null", s, f"SELECT count(*) - count({q}) FROM {LABELLED}") for c, s, q in
                 [("doc_id", "error", "documents.doc_id"), ("source", "error", "source"), ("quality", "error", "quality"), ("toxic", "warn", "toxic")]]
DUCK_UNIQUE = [("documents", "doc_id", "unique", "error", _duck_unique("documents", "doc_id")),
               ("events", "user_id", "unique", "warn", _duck_unique("events", "user_id")),
               ("documents", "text", "unique", "warn", _duck_unique("documents", "text"))]
DUCK_FRESH = [("events", "ts", "freshness", "warn", "SELECT CAST(max(ts) < TIMESTAMP '2024-03-15' - INTERVAL 90 DAY AS INTEGER) FROM events"),
              ("orders", "o_orderdate", "freshness", "warn", "SELECT CAST(max(o_orderdate) < TIMESTAMP '2024-03-15' - INTERVAL 90 DAY AS INTEGER) FROM orders")]


def _audited(spark, d) -> dict[str, DataFrame]:
    return {"documents": _labelled(spark, d), "events": table(spark, d, "events"), "orders": table(spark, d, "orders")}


@query("not_null_report", _duck_rules(DUCK_NOT_NULL))
def not_null_report(spark, d):
    return quality.run_rules(_audited(spark, d), NOT_NULL_RULES)


@query("unique_report", _duck_rules(DUCK_UNIQUE))
def unique_report(spark, d):
    return quality.run_rules(_audited(spark, d), UNIQUE_RULES)


@query("freshness_report", _duck_rules(DUCK_FRESH))
def freshness_report(spark, d):
    return quality.run_rules(_audited(spark, d), FRESH_RULES, NOW)


@query("gate_report", f"""
SELECT count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warned,
  count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'FAIL') = 0 AS publish
FROM ({_duck_rules(DUCK_NOT_NULL + DUCK_UNIQUE + DUCK_FRESH)})""")
def gate_report(spark, d):
    return quality.gate(quality.run_rules(_audited(spark, d), NOT_NULL_RULES + UNIQUE_RULES + FRESH_RULES, NOW))


# -- flagship: raw amendment documents to the typed table ------------------------------

@query("silver_emendas", f"""
WITH raw AS (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-01-01 06:00:00' END AS carga,
    '2024' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS codigo_emenda,
    strftime(l_shipdate, '%Y') || 'OB' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS codigo_documento
  FROM lineitem WHERE {VALID.format(k="l_orderkey")})
SELECT carga AS data_extracao, codigo_emenda, codigo_documento, CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_linenumber % 6 AS INTEGER) AS sk_tipo_emenda,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE {PRICE} END AS valor_documento, CAST(l_shipdate AS DATE) AS data_documento,
  CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE {PAYEE_BASE} || '000100' END AS favorecido_id,
  CASE WHEN l_orderkey % 10 = 3 THEN 'FAVORECIDO COLETIVO' ELSE 'FORNECEDOR ' || l_partkey END AS favorecido_nome,
  CASE WHEN l_orderkey % 10 = 3 THEN 'outro' ELSE 'CNPJ' END AS favorecido_tipo
FROM raw QUALIFY row_number() OVER (PARTITION BY codigo_emenda, codigo_documento ORDER BY carga DESC, l_linenumber % 6, strftime(l_shipdate, '%d/%m/%Y'),
  CASE WHEN l_orderkey % 10 <> 3 THEN CAST(l_partkey AS VARCHAR) END,
  translate(format('{{:,.2f}}', CAST({PRICE} AS DOUBLE)), ',.', '.,')) = 1""")
def silver_emendas(spark, d):
    return silver_amendments(_raw_documents(spark, d))


@query("silver_incremental", ORACLES["silver_emendas"])
def silver_incremental(spark, d):
    """The same table from three loads, the newest first, each brought in by itself."""
    raw, root = _raw_documents(spark, d), scratch_path(spark, "silver")
    ledger, schema = Ledger(spark, f"{root}/lake"), raw.schema
    lots = ("data_extracao >= '2024-02-01' AND sk_tipo_emenda <> '4'", "data_extracao < '2024-02-01'", "sk_tipo_emenda = '4'")
    for n, lot in enumerate(lots):
        ledger.create_branch(f"carga_{n}")
        ledger.stage(raw.where(lot), "documentos", f"i{n}", f"carga_{n}")
        ledger.publish(f"carga_{n}")
        update_silver(ledger, "documentos", schema, f"{root}/silver")
    return read_silver(spark, f"{root}/silver")


def _raw_documents(spark, d) -> DataFrame:
    price = MONEY_TEXT.replace("o_totalprice", "l_extendedprice")
    raw = table(spark, d, "lineitem").select(
        F.expr("CAST(CASE WHEN l_linenumber % 2 = 0 THEN '2024-02-01 06:00:00' ELSE '2024-01-01 06:00:00' END AS TIMESTAMP)").alias("data_extracao"),
        F.expr(LINE_CODE).alias("codigo_emenda"),
        F.expr("date_format(l_shipdate, 'yyyy') || 'OB' || lpad(CAST(l_suppkey AS STRING), 6, '0')").alias("codigo_documento"),
        F.date_format("l_shipdate", "yyyy").alias("ano"), (F.col("l_linenumber") % 6).cast("string").alias("sk_tipo_emenda"),
        F.expr(f"CASE WHEN l_orderkey % 5 = 0 THEN '-' ELSE {price} END").alias("valor_documento"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("data_documento"),
        F.expr(f"""CASE WHEN l_orderkey % 10 = 3 THEN 'FAVORECIDO COLETIVO' ELSE substr({PAYEE_BASE},1,2) || '.' || substr({PAYEE_BASE},3,3)
          || '.' || substr({PAYEE_BASE},6,3) || '/0001-00 - FORNECEDOR ' || l_partkey END""").alias("favorecido"),
    )
    return raw

"""Scans and sinks: files are landed from the given tables, then read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..operators.normalize import year_window as window_of_years
from ..operators.ranking import sample_n, slice_by_rank, top_n
from ..operators.rollups import truncation_audit as audit_truncation
from ..session import scratch_path
from ..sources import archives, files, payload, web
from ..sources.schemas import COMPANIES
from .registry import query, table


@query("scan_jsonl_raw", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS codigo, CAST(o_custkey AS VARCHAR) AS cliente,
  o_orderstatus AS situacao, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS valor,
  '{"prioridade":"' || o_orderpriority || '"}' AS detalhe
FROM orders""")
def scan_jsonl_raw(spark, d):
    path = scratch_path(spark, "jsonl")
    landed = table(spark, d, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("codigo"), F.col("o_custkey").alias("cliente"),
        F.col("o_orderstatus").alias("situacao"), F.col("o_totalprice").cast("decimal(18,2)").alias("valor"),
        F.struct(F.col("o_orderpriority").alias("prioridade")).alias("detalhe"),
    )
    files.write_jsonl(landed, path)
    return files.read_jsonl(spark, path, ["codigo", "cliente", "situacao", "valor", "detalhe"])


def _land_registry_csv(spark, d) -> str:
    """Company-registry files in nested folders; every 10th line too long, every 10th too short."""
    root = scratch_path(spark, "registry")
    rows = table(spark, d, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cnpj_basico"),
        F.concat(F.lit('Ação "Ç"; '), "c_name").alias("razao_social"),
        F.lit("2135").alias("natureza_juridica"), F.lit("50").alias("qualificacao_responsavel"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(",00")).alias("capital_social"),
        F.col("c_mktsegment").alias("porte_empresa"), F.lit("-").alias("ente_federativo_responsavel"),
        (F.col("c_custkey") % 10).alias("_v"),
    )

    def land(part, folder):
        part.write.option("sep", ";").option("encoding", "ISO-8859-1").option("escape", '"').option(
            "quoteAll", "true").csv(f"{root}/{folder}")

    land(rows.where("_v NOT IN (3, 7)").select(*COMPANIES), "2023-05/full")
    land(rows.where("_v = 3").select(*COMPANIES, F.lit("sobra").alias("x")), "2023-06/long")
    land(rows.where("_v = 7").select(*COMPANIES[:5]), "2023-06/short")
    return root


@query("scan_csv_layout", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, 'Ação "Ç"; ' || c_name AS razao_social,
  '2135' AS natureza_juridica, '50' AS qualificacao_responsavel, c_nationkey || ',00' AS capital_social,
  CASE WHEN c_custkey % 10 <> 7 THEN c_mktsegment END AS porte_empresa,
  CASE WHEN c_custkey % 10 <> 7 THEN '-' END AS ente_federativo_responsavel
FROM customer WHERE c_custkey % 10 <> 3""")
def scan_csv_layout(spark, d):
    rows, _ = files.read_layout_csv(spark, _land_registry_csv(spark, d), "*.csv", columns=COMPANIES)
    return rows.drop("_file")


@query("csv_dead_letter", """
SELECT '"' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '";"Ação ""Ç""; ' || c_name || '";"2135";"50";"'
  || c_nationkey || ',00";"' || c_mktsegment || '";"-";"sobra"' AS raw
FROM customer WHERE c_custkey % 10 = 3""")
def csv_dead_letter(spark, d):
    _, rejects = files.read_layout_csv(spark, _land_registry_csv(spark, d), "*.csv", columns=COMPANIES)
    return rejects.drop("_file")


@query("scan_csv_header", """
SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name || ', "' || p_brand || '"' AS nome, p_type AS tipo FROM part""")
def scan_csv_header(spark, d):
    path = scratch_path(spark, "csv")
    files.write_csv_header(table(spark, d, "part").select(
        F.col("p_partkey").alias("codigo"),
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("nome"), F.col("p_type").alias("tipo"),
    ), path)
    return files.read_csv_header(spark, path, ["codigo", "nome", "tipo"])


@query("scan_json_array", """
SELECT c_custkey AS numero, c_name AS vencedor, CAST(c_acctbal AS DECIMAL(18,2)) AS valor FROM customer""")
def scan_json_array(spark, d):
    path = scratch_path(spark, "array")
    files.write_json_arrays(table(spark, d, "customer").select(
        F.col("c_custkey").alias("numero"), F.col("c_name").alias("vencedor"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("valor"),
    ), path)
    return files.read_json_documents(spark, path, "numero bigint, vencedor string, valor decimal(18,2)")


@query("partitioned_write", "SELECT event_id, user_id, event_type, ts FROM events")
def partitioned_write(spark, d):
    path = scratch_path(spark, "partitioned")
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    files.write_table(events, path, partition_by=["event_type"], sort_by=["ts"])
    return spark.read.schema(events.schema).parquet(path)


@query("json_per_unit", """
SELECT c_custkey AS numero, c_name AS nome, c_nationkey AS codigo_unidade FROM customer""")
def json_per_unit(spark, d):
    path = scratch_path(spark, "units")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("numero"), F.col("c_name").alias("nome"), F.col("c_nationkey").alias("codigo_unidade"))
    files.write_jsonl(rows, path, partition_by=["codigo_unidade"])
    return spark.read.schema("numero bigint, nome string, codigo_unidade int").json(path)


@query("per_file_counts", "SELECT source, count(*) AS rows FROM documents GROUP BY source")
def per_file_counts(spark, d):
    path = scratch_path(spark, "files")
    documents = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    files.write_table(documents, path, partition_by=["source"])
    landed = spark.read.schema("doc_id bigint, n_chars bigint, source string").parquet(path)
    per_file = files.count_by_file(landed.withColumn("_file", F.col("_metadata.file_path")))
    folder = F.regexp_extract("file_name", "source=([^/]+)", 1)
    return per_file.groupBy(folder.alias("source")).agg(F.sum("rows").alias("rows"))


def _zip_batches(df, member_suffix: str, key: str, text: str):
    """``binaryFile``-shaped rows: one archive per row holding ``text`` as its member."""
    def pack(batches):
        for batch in batches:
            out = []
            for name, body in zip(batch[key], batch[text]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"{name}{member_suffix}", body)
                out.append((f"landing/{name}.zip", buffer.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    return df.select(key, text).mapInPandas(pack, "path string, content binary")


@query("zip_csv_unpack", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, 'K' || c_custkey || '.EMPRECSV' AS member, g AS line_no,
  'Razao "' || g || '"; social' AS razao_social, CAST(c_nationkey AS VARCHAR) AS capital_social
FROM (SELECT c_custkey, c_nationkey, unnest(generate_series(0, c_custkey % 3)) AS g FROM customer)""")
def zip_csv_unpack(spark, d):
    key = F.col("c_custkey")
    line = lambda g: F.concat(
        F.lit('"'), F.lpad(key.cast("string"), 8, "0"), F.lit('";"Razao ""'), g.cast("string"),
        F.lit('""; social";'), F.col("c_nationkey").cast("string"),
    )
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), key % 3), line), "\r\n")
    source = table(spark, d, "customer").select(F.concat(F.lit("K"), key.cast("string")).alias("name"), text.alias("body"))
    rows, _ = archives.parse_zip_csv(
        _zip_batches(source, ".EMPRECSV", "name", "body"), ["cnpj_basico", "razao_social", "capital_social"]
    )
    return rows.drop("archive")


@query("xml_profile", """
WITH c AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey,
  CASE c_nationkey % 6 WHEN 0 THEN 'PE' WHEN 1 THEN 'BA' WHEN 2 THEN 'SP' WHEN 3 THEN 'CE' WHEN 4 THEN 'RJ' END AS uf FROM customer)
SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS id_lattes,
  CASE WHEN c_custkey % 4 = 0 THEN '2024-02-01' ELSE '0102024' END AS data_atualizacao, '101010' AS hora_atualizacao,
  CASE WHEN c_custkey % 9 = 0 THEN 'N/A' ELSE 'José ' || c_name END AS nome, uf AS uf_atuacao,
  CAST(c_custkey % 3 AS INTEGER) AS projetos,
  CASE WHEN c_custkey % 3 > 0 THEN 'Ação 1 de ' || c_custkey END AS primeiro_projeto,
  'resumo ' || c_custkey AS resumo
FROM c WHERE uf IN ('PE', 'BA', 'CE') AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 17 <> 0""")
def xml_profile(spark, d):
    project = "transform(sequence(1, c_custkey % 3), i -> concat('<PROJETO-DE-PESQUISA NOME=\"Ação ', i, ' de ', c_custkey, '\"/>'))"
    body = F.expr(f"""CASE WHEN c_custkey % 17 = 0 THEN '<quebrado>' ELSE concat(
      '<CURRICULO-VITAE DATA-ATUALIZACAO="', CASE WHEN c_custkey % 4 = 0 THEN '01022024' ELSE '0102024' END,
      '" HORA-ATUALIZACAO="101010"><DADOS-GERAIS',
      CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN concat(' NOME-COMPLETO="JosÃ© ', c_name, '"')
        ELSE concat(' NOME-COMPLETO="José ', c_name, '"') END,
      '><RESUMO-CV TEXTO="resumo ', c_custkey, '"/>',
      CASE c_nationkey % 6 WHEN 5 THEN '' ELSE concat('<ENDERECO><ENDERECO-PROFISSIONAL UF="',
         element_at(array('PE', 'BA', 'SP', 'CE', 'RJ'), c_nationkey % 6 + 1), '"/></ENDERECO>') END,
      '<MESTRADO STATUS-DO-CURSO="', CASE c_mktsegment WHEN 'BUILDING' THEN 'CONCLUIDO' ELSE 'INCOMPLETO' END, '"/>',
      '<DOUTORADO STATUS-DO-CURSO="', CASE c_mktsegment WHEN 'MACHINERY' THEN 'EM_ANDAMENTO' ELSE '' END, '"/>',
      '</DADOS-GERAIS>', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE array_join({project}, '') END,
      '</CURRICULO-VITAE>') END""")
    source = table(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("name"), body.alias("body"))
    profiles, _ = archives.parse_profiles(_zip_batches(source, ".xml", "name", "body"))
    return profiles.select(
        "id_lattes", "data_atualizacao", "hora_atualizacao", "nome", "uf_atuacao",
        F.size("research_projects").alias("projetos"),
        F.get("research_projects", F.lit(0))["attributes"]["NOME"].alias("primeiro_projeto"),
        F.col("general_data.children")["RESUMO-CV"]["TEXTO"].alias("resumo"),
    )


@query("xml_profile_json", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS id_lattes,
  '{"NOME":"' || c_name || '","FILHO":{"B":"2"},"VAZIO":{}}' AS general_data,
  '[' || CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '{"I":"Ação"}' ELSE '{"I":"Ação"},{"VINCULO":{"A":"' || c_nationkey || '"}}' END || ']' AS professional_performances
FROM customer""")
def xml_profile_json(spark, d):
    """Nodes as the raw table holds them: attributes and children in one object, the last child of a name instead of all before."""
    body = F.expr("""concat('<C><DADOS-GERAIS NOME="', c_name, '" FILHO="a"><FILHO A="1"/><FILHO B="2"/><VAZIO><X UF="PE"/></VAZIO></DADOS-GERAIS>',
      '<ENDERECO-PROFISSIONAL UF="PE"/><MESTRADO STATUS-DO-CURSO="CONCLUIDO"/>',
      CASE WHEN c_custkey % 3 > 0 THEN '<ATUACAO-PROFISSIONAL I="AÃ§Ã£o"/>' ELSE '' END,
      CASE WHEN c_custkey % 3 = 2 THEN concat('<ATUACAO-PROFISSIONAL><VINCULO A="', c_nationkey, '"/></ATUACAO-PROFISSIONAL>') ELSE '' END, '</C>')""")
    source = table(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("name"), body.alias("body"))
    profiles, _ = archives.parse_profiles(_zip_batches(source, ".xml", "name", "body"))
    return archives.profile_json(profiles).select("id_lattes", "general_data", "professional_performances")


@query("paged_payload_explode", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 4 + 1 END AS records_total,
  o_orderkey || '-' || g AS codigo, CASE WHEN g = 2 THEN NULL ELSE o_orderstatus END AS fase
FROM (SELECT *, unnest(generate_series(0, o_orderkey % 4)) AS g FROM orders WHERE o_orderkey % 13 <> 0)""")
def paged_payload_explode(spark, d):
    pages = table(spark, d, "orders").select("o_orderkey", F.expr("""CASE WHEN o_orderkey % 13 = 0 THEN '<html>502</html>'
      ELSE concat('{', CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('"recordsTotal":', o_orderkey % 4 + 1, ',') END,
       '"data":[', array_join(transform(sequence(0L, o_orderkey % 4), g -> concat('{"codigo":"', o_orderkey, '-', g, '","fase":',
       CASE WHEN g = 2 THEN 'null' ELSE concat('"', o_orderstatus, '"') END, '}')), ','), ']}') END""").alias("body"))
    rows = payload.explode_payload(pages, "body")
    return rows.select("o_orderkey", "records_total", *payload.map_fields(F.col("record"), {"codigo": "codigo", "fase": "fase"}))


@query("page_plan", """
SELECT o_custkey, records_total, unnest(generate_series(0, records_total - 1, 10)) AS page_offset
FROM (SELECT o_custkey, count(*) AS records_total FROM orders GROUP BY o_custkey)""")
def page_plan(spark, d):
    totals = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("records_total"))
    return payload.page_plan(totals, "records_total", 10)


@query("request_plan", """
SELECT codigo, ano, CAST(o AS VARCHAR) AS "offset", '1000' AS tamanho FROM (SELECT CAST(o_orderkey AS VARCHAR) AS codigo,
  CAST(year(o_orderdate) AS VARCHAR) AS ano, unnest(generate_series(0, o_custkey % 2500 - 1, 1000)) AS o FROM orders)""")
def request_plan(spark, d):
    amendments = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("codigo_emenda"), F.date_format("o_orderdate", "yyyy").alias("ano"),
        F.lit("08").alias("codigo_funcao"), F.lit("244").alias("codigo_subfuncao"), F.lit("PE").alias("localidade_do_gasto"),
        F.lit("2").alias("sk_tipo_emenda"), (F.col("o_custkey") % 2500).alias("records_total"))
    planned = payload.document_request(payload.page_plan(amendments, "records_total"))
    picked = {"codigo": "codigo", "ano": "ano", "offset": "offset", "tamanhoPagina": "tamanho"}
    return planned.select(*[F.col("params")[k].alias(v) for k, v in picked.items()])


@query("truncation_audit", """
SELECT o_custkey, fetched, announced, fetched >= announced AS complete,
  fetched < announced AND fetched % 5 = 0 AS truncated
FROM (SELECT o_custkey, count(*) AS fetched, o_custkey % 25 + 1 AS announced FROM orders GROUP BY o_custkey)""")
def truncation_audit(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", (F.col("o_custkey") % 25 + 1).alias("records_total"))
    return audit_truncation(rows, "o_custkey", "records_total", 5)


@query("manifest_select", """
SELECT 'https://dados.example.org/cnpj/' || strftime(o_orderdate, '%Y-%m') || '/' || f || o_orderkey || '.zip' AS file_url,
  f || o_orderkey || '.zip' AS file_name, strftime(o_orderdate, '%Y-%m') AS target_dir, f || o_orderkey AS member
FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'Empresas' WHEN 1 THEN 'Estabelecimentos' WHEN 2 THEN 'Socios'
   WHEN 3 THEN 'Cnaes' ELSE 'Motivos' END AS f FROM orders)
WHERE f IN ('Empresas', 'Estabelecimentos', 'Socios') AND o_orderkey % 7 <> 0 AND year(o_orderdate) >= 2000""")
def manifest_select(spark, d):
    listing = table(spark, d, "orders").select(
        F.expr("""concat('https://dados.example.org/cnpj/', CASE WHEN o_orderkey % 7 = 0 THEN 'temp'
          ELSE date_format(o_orderdate, 'yyyy-MM') END, CASE WHEN o_orderkey % 2 = 0 THEN '/' ELSE '' END)""").alias("directory"),
        F.expr("""concat(element_at(array('Empresas', 'Estabelecimentos', 'Socios', 'Cnaes', 'Motivos'),
          CAST(o_orderkey % 5 + 1 AS INT)), o_orderkey, '.zip')""").alias("href"),
    )
    return web.manifest(listing, "directory", "href")


@query("html_links", """
SELECT url AS page_url, CAST(i - 1 AS INTEGER) AS position, hrefs[i] AS href
FROM (SELECT url, hrefs, unnest(generate_series(1, len(hrefs))) AS i
  FROM (SELECT url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages))""")
def html_links(spark, d):
    return web.links(table(spark, d, "pages"), "url", "html")


JSON_ROWS = "transform(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), (h, i) -> {})"


@query("allowance_rows", """
SELECT 'http://transparencia.example.org/cotas/' || h AS url, 'pag ' || page_id AS publication_date,
  'cota ' || url AS description, h AS file_id
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS h FROM pages)""")
def allowance_rows(spark, d):
    rows = JSON_ROWS.format("named_struct('arquivo', h, 'data_publicacao', concat('pag ', page_id), 'descricao', concat('cota ', url))")
    landed = table(spark, d, "pages").select(F.expr(f"to_json(named_struct('rows', {rows}))").alias("body"))
    return payload.allowance_files(landed, "body", "http://transparencia.example.org/cotas/")


@query("unit_dictionary", """
SELECT CAST(page_id * 1000 + i AS VARCHAR) AS cod_unidade_gestora,
  trim('Fundo ' || replace(hs[i + 1], 'para', '')) AS nome_unidade_gestora
FROM (SELECT page_id, hs, unnest(generate_series(0, len(hs) - 1)) AS i
  FROM (SELECT page_id, regexp_extract_all(html, 'href="/([a-z]*)"', 1) AS hs FROM pages))""")
def unit_dictionary(spark, d):
    units = """transform(regexp_extract_all(html, 'href="/([a-z]*)"', 1), (h, i) ->
      named_struct('codigo', page_id * 1000 + i, 'denominacaoPara', concat('para Fundo ', h, ' ')))"""
    landed = table(spark, d, "pages").select(F.expr(f"to_json(named_struct('pojo', named_struct('unidades', {units})))").alias("body"))
    return payload.unit_dictionary(landed, "body")


@query("year_window", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def year_window(spark, d):
    return window_of_years(table(spark, d, "orders"), "o_orderdate", 1996, 1998, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("ordered_scan", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def ordered_scan(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("preview_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def preview_limit(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_n(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("sample_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 10""")
def sample_rows(spark, d):
    return sample_n(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", 10)


@query("offset_slice", "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def offset_slice(spark, d):
    return slice_by_rank(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "doc_id", 100, 50)

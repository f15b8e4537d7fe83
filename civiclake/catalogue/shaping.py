"""Normalisation, appends, deduplication and page sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import dedupe, normalize, rollups
from ..plans import silver, wap
from ..session import scratch_path
from ..sources import files, payload, web
from .registry import query, table

DAY = "CAST(ts AS DATE)"


@query("rename_coerce", """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS usuario,
  CASE WHEN event_id % 4 = 0 THEN '{"k":null,"tipo":"' || event_type || '"}'
    ELSE '{"k":' || regexp_extract(props, '[0-9]+') || ',"tipo":"' || event_type || '"}' END AS detalhes,
  CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS valor
FROM events""")
def rename_coerce(spark, d):
    k = F.when(F.col("event_id") % 4 != 0, F.from_json("props", "k int")["k"])
    landed = table(spark, d, "events").select(
        F.col("event_id").alias("id"), "user_id", F.struct(k.alias("k"), F.col("event_type").alias("tipo")).alias("detail"),
        F.when(F.col("event_id") % 4 != 1, F.col("value").cast("decimal(18,2)")).alias("valor"),
    )
    return normalize.rename_coerce(landed, {"user_id": "usuario", "detail": "detalhes", "absent": "x"})


@query("load_stamp", """
SELECT TIMESTAMP '2024-03-01 06:00:00' AS data_extracao, c_custkey, c_name FROM customer""")
def load_stamp(spark, d):
    return normalize.stamp(table(spark, d, "customer").select("c_custkey", "c_name"), F.lit("2024-03-01 06:00:00"))


@query("map_fields_default", """
SELECT CASE WHEN o_orderkey % 2 = 1 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS codigo_emenda,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS funcao,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS subfuncao,
  CAST(o_orderkey AS VARCHAR) AS numero_emenda
FROM orders""")
def map_fields_default(spark, d):
    body = F.expr("""concat('{"numeroEmenda":', o_orderkey,
      CASE WHEN o_orderkey % 2 = 1 THEN '' ELSE concat(',"codigoEmenda":"', o_orderkey, '"') END,
      CASE WHEN o_orderkey % 3 = 0 THEN ',"funcao":null' ELSE concat(',"funcao":"', o_orderstatus, '"') END,
      CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(',"subfuncao":"', o_orderpriority, '"') END, '}')""")
    record = table(spark, d, "orders").select(F.from_json(body, "map<string,string>").alias("r"))
    mapping = {"codigoEmenda": "codigo_emenda", "funcao": "funcao", "subfuncao": "subfuncao", "numeroEmenda": "numero_emenda"}
    return record.select(*payload.map_fields(F.col("r"), mapping, {"subfuncao"}))


APPENDED = """
SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT c_custkey, upper(c_name), NULL FROM customer WHERE c_nationkey < 5"""


def _two_orders(spark, d) -> list[DataFrame]:
    customer = table(spark, d, "customer")
    first = customer.select("c_mktsegment", "c_custkey", "c_name")
    second = customer.where("c_nationkey < 5").select(F.upper("c_name").alias("c_name"), "c_custkey")
    return [first, second]


@query("append_by_name", APPENDED)
def append_by_name(spark, d):
    path = scratch_path(spark, "append")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    for frame in _two_orders(spark, d):
        files.write_table(normalize.conform(frame, columns), path, mode="append")
    return spark.read.schema("c_custkey bigint, c_name string, c_mktsegment string").parquet(path)


@query("append_main", APPENDED)
def append_main(spark, d):
    ledger = wap.Ledger(spark, scratch_path(spark, "main"))
    ledger.create_branch("direct")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    for n, frame in enumerate(_two_orders(spark, d)):
        ledger.write(normalize.conform(frame, columns), "clientes", f"lote_{n}")
    ledger.mark_staged("direct", [("clientes", "lote_0"), ("clientes", "lote_1")])
    ledger.publish("direct")
    schema = "c_custkey bigint, c_name string, c_mktsegment string"
    return ledger.read_ref("clientes", schema).select(*columns)


@query("table_contract", """
SELECT TIMESTAMP '2024-03-01 06:00:00' AS data_extracao, CAST(c_custkey AS VARCHAR) AS numero, c_name AS nome FROM customer""")
def table_contract(spark, d):
    location = scratch_path(spark, "contract")
    name = f"contract_{location.rsplit('-', 1)[-1]}"
    for _ in range(2):  # the second call must change nothing
        files.create_table_if_missing(spark, name, ["numero", "nome"], location)
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("numero"), F.col("c_name").alias("nome"))
    normalize.stamp(rows, F.lit("2024-03-01 06:00:00")).write.insertInto(name)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
    return spark.read.schema(schema).parquet(location)


@query("drop_all_null", """
SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 6 <> 0""")
def drop_all_null(spark, d):
    rows = table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return normalize.drop_all_null(rows, rows.columns)


@query("silver_dedupe_latest", """
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def silver_dedupe_latest(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return dedupe.dedupe_latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("silver_table", """
SELECT o_orderstatus || ' ' || o_orderpriority AS quote_text, o_custkey AS author_name, o_orderkey AS tags, o_orderdate AS ingestion_at FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority, o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def silver_table(spark, d):
    raw = table(spark, d, "orders").select(
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("texto"), F.col("o_custkey").alias("autor"),
        F.col("o_orderkey").alias("tags"), F.lit("u").alias("url_origem"), F.col("o_orderdate").alias("ingestion_at"))
    path = scratch_path(spark, "silver")
    files.write_table(silver.silver_quotes(raw).drop("url_origem"), path, sort_by=["author_name"])
    return spark.read.parquet(path)


@query("bronze_latest_by_key", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""")
def bronze_latest_by_key(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity"]
    return dedupe.dedupe_latest(rows, ["l_orderkey", "l_linenumber"], order)


@query("dedupe_exact", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS dia FROM
(SELECT * FROM events UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15')""")
def dedupe_exact(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", F.expr(DAY).alias("dia"))
    again = table(spark, d, "events").where("ts >= TIMESTAMP_NTZ '2024-01-15'").select(*[
        "user_id", "event_type", F.expr(DAY).alias("dia")])
    return dedupe.dedupe_exact(rows.unionByName(again))


@query("batch_diff", f"""
SELECT user_id, event_type FROM events WHERE {DAY} = DATE '2024-01-16'
EXCEPT SELECT user_id, event_type FROM events WHERE {DAY} = DATE '2024-01-15'""")
def batch_diff(spark, d):
    def day(low: str, high: str):
        return table(spark, d, "events").where(
            f"ts >= TIMESTAMP_NTZ '{low}' AND ts < TIMESTAMP_NTZ '{high}'").select("user_id", "event_type")

    return dedupe.batch_diff(day("2024-01-16", "2024-01-17"), day("2024-01-15", "2024-01-16"))


# -- sections of detail pages ------------------------------------------------------

NAV = {"nav": web.Section(values=web.tag_attribute("a", "href"), categories=web.tag_text("a"))}
BODY = {"body": web.Section(values=web.tag_text("p"), categories=web.tag_text("a"))}
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _duck_clean(c: str) -> str:
    bare = f"replace(regexp_replace({c}, '<[^>]*>', '', 'g'), chr(10), '')"
    return f"regexp_replace(regexp_replace(regexp_replace({bare}, '^{BLANK}', ''), '{BLANK}$', ''), '{BLANK}', ' ', 'g')"


def _duck_list(pattern: str) -> str:
    cleaned = _duck_clean("x")
    return f"list_filter(list_transform(regexp_extract_all(html, '{pattern}', 1), lambda x: {cleaned}), lambda y: y <> '')"


DUCK_LINKS = _duck_list(r"(?s)<a\b[^>]*?\bhref=\"([^\"]*)\"").replace('\\"', '"')
DUCK_LABELS = _duck_list(r"(?s)<a\b[^>]*>(.*?)</a>")
DUCK_PARAGRAPHS = _duck_list(r"(?s)<p\b[^>]*>(.*?)</p>")


@query("html_text", f"SELECT page_id, {_duck_clean('html')} AS texto FROM pages")
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", fx.strip_html(F.col("html")).alias("texto"))


@query("html_pairs", f"""
SELECT url AS source_url, CAST(i - 1 AS INTEGER) AS pair_index, labels[i] AS category, links[i] AS value,
  'high' AS confidence
FROM (SELECT *, unnest(generate_series(1, least(len(labels), len(links)))) AS i
  FROM (SELECT url, {DUCK_LABELS} AS labels, {DUCK_LINKS} AS links FROM pages))""")
def html_pairs(spark, d):
    pages = web.extract_sections(table(spark, d, "pages"), "url", "html", NAV)
    return normalize.explode_rows(pages, ["source_url"], F.col("nav.paired_data"), "p").select("source_url", "p.*")


@query("pair_zip", f"""
SELECT url AS source_url, CAST(n AS INTEGER) AS total_pairs, n || '/' || nv AS paired_ratio,
  CASE WHEN nc = nv THEN 'excellent' WHEN n * 10 > greatest(nc, nv) * 8 THEN 'good' ELSE 'poor' END AS pairing_quality,
  CAST(greatest(nv - nc, 0) AS INTEGER) AS unpaired, CASE WHEN nv > nc THEN vals[nc + 1] END AS first_unpaired,
  CASE WHEN n > 0 THEN labels[n] || '=' || vals[n] END AS last_pair
FROM (SELECT *, len(labels) AS nc, len(vals) AS nv, least(len(labels), len(vals)) AS n
  FROM (SELECT url, {DUCK_LABELS} AS labels, {DUCK_PARAGRAPHS} AS vals FROM pages))""")
def pair_zip(spark, d):
    s = web.extract_sections(table(spark, d, "pages"), "url", "html", BODY)
    last = F.try_element_at("body.paired_data", F.lit(-1))
    return s.select(
        "source_url", "body.total_pairs", "body.paired_ratio", "body.pairing_quality",
        F.size("body.unpaired_values").alias("unpaired"),
        F.get("body.unpaired_values", F.lit(0)).alias("first_unpaired"),
        F.concat(last["category"], F.lit("="), last["value"]).alias("last_pair"),
    )


@query("pair_quality", f"""
SELECT page_id, CASE WHEN n = 0 THEN 'no_data' WHEN k * 10 > n * 7 THEN 'good' ELSE 'needs_review' END AS status,
  CASE WHEN n = 0 THEN CAST(0 AS DECIMAL(5,2)) ELSE CAST(floor(CAST(k AS DECIMAL(12,0)) * 1000 / n / 10 + 0.5) / 100 AS DECIMAL(5,2)) END AS score,
  CASE WHEN n > 0 THEN k > 0 END AS complete
FROM (SELECT page_id, len(r) AS n, len(list_filter(list_transform(r, lambda x: {_duck_clean('x')}), lambda y: y <> '')) AS k
  FROM (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN [] ELSE
    list_transform(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), lambda h: CASE WHEN length(h) % 3 = 0 THEN '<b> </b>' ELSE h END) END AS r FROM pages))""")
def pair_quality(spark, d):
    raw = F.expr("""CASE WHEN page_id % 9 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE
      transform(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), h -> CASE WHEN length(h) % 3 = 0 THEN '<b> </b>' ELSE h END) END""")
    graded = fx.list_quality(F.col("raw"), fx.clean_html_list(F.col("raw")))
    return table(spark, d, "pages").select("page_id", raw.alias("raw")).select("page_id", graded.alias("q")).select("page_id", "q.*")


DEEP = {"card": web.Section(values=web.tag_text("div", "card-info"), categories=web.tag_text("div", "card-title"))}


@query("nested_elements", """
SELECT CAST(o_orderkey AS VARCHAR) AS source_url, unnest(['Nível', 'Outro']) AS category,
  unnest([o_orderstatus || ' fim ' || CAST(o_custkey AS VARCHAR), o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN 'aberto' ELSE '' END]) AS value
FROM orders""")
def nested_elements(spark, d):
    """Pages with up to eleven levels of one element in a selected one, comments, void, stray and unclosed tags."""
    html = """concat('<main><div class="card-title">Nível</div><div class="card-info"><!-- <div> -->', repeat('<div class="x">', o_orderkey % 12),
      o_orderstatus, repeat('</div>', o_orderkey % 12), '<br> fim ', o_custkey, '</div>', if(o_orderkey % 3 = 0, '</div>', ''),
      '<DIV CLASS="b card-title">Outro</DIV><div class="card-info b"><div/> ', o_orderpriority, if(o_orderkey % 5 = 0, '<div>aberto', '</div>'), '</main>')"""
    pages = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("url"), F.expr(html).alias("html"))
    found = web.extract_sections(pages, "url", "html", DEEP)
    return normalize.explode_rows(found, ["source_url"], F.col("card.paired_data"), "p").select("source_url", "p.category", "p.value")


SUMMARY_SECTIONS = {
    "nav": NAV["nav"],
    "body": BODY["body"],
    "title": web.Section(values=web.tag_text("h1")),
    "images": web.Section(values=web.tag_attribute("img", "src")),
}


@query("section_summary", """
SELECT url AS source_url, CAST(4 AS BIGINT) AS processed, ok AS successful, 4 - ok AS failed,
  CAST(CAST(ok AS DECIMAL(12,0)) / 4 AS DECIMAL(5,2)) AS success_rate,
  CASE WHEN ok * 10 >= 36 THEN 'excelent' WHEN ok * 10 >= 28 THEN 'good' ELSE 'needs_improvement' END AS grade
FROM (SELECT url, CAST(regexp_matches(html, '(?s)<a\\b[^>]*?\\bhref="([^"]*)"') AS BIGINT)
  + CAST(regexp_matches(html, '(?s)<p\\b[^>]*>(.*?)</p>') AS BIGINT)
  + CAST(regexp_matches(html, '(?s)<h1\\b[^>]*>(.*?)</h1>') AS BIGINT)
  + CAST(regexp_matches(html, '(?s)<img\\b[^>]*?\\bsrc="([^"]*)"') AS BIGINT) AS ok FROM pages)""")
def section_summary(spark, d):
    s = web.extract_sections(table(spark, d, "pages"), "url", "html", SUMMARY_SECTIONS, require_values=True)
    return s.select("source_url", "extraction_summary.*")


def _duck_details(name: str, labels: str | None, values: str, raw: str) -> str:
    """One row of ``section_details`` per page from SQL lists: cleaned labels, cleaned and raw values."""
    n, k = f"len(regexp_extract_all(html, '{raw}', 1))", f"len({values})"
    found, mapped = (f"len({labels})", f"least(len({labels}), {k})") if labels else ("NULL", "NULL")
    return f"""SELECT url AS source_url, '{name}' AS section, CASE WHEN {k} = 0 AND {n} = 0 THEN 'failed' WHEN {k} = 0 THEN 'failed' ELSE '{"paired_data" if labels else "list"}' END AS method,
  {found} AS categories_found, {k} AS values_found, {mapped} AS mapped,
  CASE WHEN {n} = 0 THEN 'no_data' WHEN {k} * 10 > {n} * 7 THEN 'good' ELSE 'needs_review' END AS values_status,
  CASE WHEN {k} = 0 THEN 'Erro na seção {name}: nenhum valor na página' END AS error FROM pages"""


@query("section_details", f"""
{_duck_details("nav", DUCK_LABELS, DUCK_LINKS, '(?s)<a[^>]*?href="([^"]*)"')}
UNION ALL {_duck_details("title", None, _duck_list("(?s)<h1[^>]*>(.*?)</h1>"), "(?s)<h1[^>]*>(.*?)</h1>")}
UNION ALL SELECT url, 'broken', 'failed', NULL, NULL, NULL, NULL, 'Erro na seção broken: sem seletor de valores' FROM pages""")
def section_details(spark, d):
    """How each section of a page was extracted, failed ones with their error."""
    config = {"nav": NAV["nav"], "title": SUMMARY_SECTIONS["title"], "broken": web.Section(values=None, categories=web.tag_text("p"))}
    s = web.extract_sections(table(spark, d, "pages"), "url", "html", config, require_values=True, details=True)
    rows = s.select("source_url", F.explode("section_details").alias("section", "x"))
    return rows.select("source_url", "section", "x.method", "x.categories_found", "x.values_found", "x.mapped",
                       F.col("x.values.status").alias("values_status"), "x.error")


# Page sections as a detail-page parser leaves them, derived from every order.
PAIRS = """array_compact(array(
  named_struct('category', 'Situação', 'value', CASE o_orderstatus WHEN 'F' THEN 'Concluída' ELSE 'em Andamento' END),
  named_struct('category', 'Valor Médio Acumulado R$', 'value', CAST(o_custkey AS STRING)),
  named_struct('category', 'Valor pago Acumulado no Período R$', 'value', CAST(o_orderkey AS STRING)),
  CASE WHEN o_orderkey % 3 = 0 THEN named_struct('category', 'SITUAÇÃO', 'value', 'Paralisada') END,
  CASE WHEN o_orderkey % 4 <> 0 THEN named_struct('category', 'Exercicio: valor médio acumulado', 'value', o_orderpriority) END,
  CASE WHEN o_orderkey % 5 <> 0 THEN named_struct('category', 'valor pago no exercício!', 'value', o_orderstatus) END))"""


def _sections(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.expr(PAIRS).alias("pairs"))


@query("section_pivot", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Paralisada' WHEN o_orderstatus = 'F' THEN 'Concluída'
  ELSE 'em Andamento' END AS situacao,
  CAST(o_custkey AS VARCHAR) AS valor_medio, CAST(NULL AS VARCHAR) AS ausente
FROM orders""")
def section_pivot(spark, d):
    keys = {"situacao": "situação", "valor_medio": "valor médio acumulado r$", "ausente": "prazo"}
    return _sections(spark, d).select("o_orderkey", *silver.section_columns(F.col("pairs"), keys))


@query("section_entries", """
SELECT category, count(*) AS n, count(DISTINCT value) AS valores FROM (
  SELECT 'situação' AS category, CASE o_orderstatus WHEN 'F' THEN 'Concluída' ELSE 'em Andamento' END AS value FROM orders
  UNION ALL SELECT 'valor_médio_acumulado_r', CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'valor_pago_acumulado_no_período_r', CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'situação', 'Paralisada' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT 'exercicio_valor_médio_acumulado', o_orderpriority FROM orders WHERE o_orderkey % 4 <> 0
  UNION ALL SELECT 'valor_pago_no_exercício', o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0)
GROUP BY category""")
def section_entries(spark, d):
    long = silver.section_entries(_sections(spark, d), ["o_orderkey"], F.col("pairs"))
    return long.groupBy("category").agg(F.count("*").alias("n"), F.count_distinct("value").alias("valores"))


@query("pair_position", """
SELECT o_orderkey, 'Situação' AS categoria_0, CAST(o_custkey AS VARCHAR) AS valor_1,
  CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 THEN o_orderstatus END AS valor_5
FROM orders""")
def pair_position(spark, d):
    pairs = F.col("pairs")
    return _sections(spark, d).select(
        "o_orderkey", fx.pair_at(pairs, 0, "category").alias("categoria_0"),
        fx.pair_at(pairs, 1, "value").alias("valor_1"), fx.pair_at(pairs, 5, "value").alias("valor_5"),
    )


@query("pair_keyword", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS valor_medio_acumulado,
  CAST(o_orderkey AS VARCHAR) AS valor_pago_periodo,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS valor_pago_exercicio
FROM orders""")
def pair_keyword(spark, d):
    rules = silver.SPENDING_RULES
    return _sections(spark, d).select(
        "o_orderkey", *[fx.pair_by_keyword(F.col("pairs"), rules, t).alias(t) for t in rules])


@query("exists_any", """
SELECT page_id FROM pages WHERE len(list_filter(regexp_extract_all(html, 'href="/([^"]*)"', 1),
  lambda h: h IN ('the', 'The', 'of', 'and'))) > 0""")
def exists_any(spark, d):
    words = web.find_all(F.col("html"), 'href="/([^"]*)"')
    return table(spark, d, "pages").where(F.exists(words, lambda w: w.isin("the", "The", "of", "and"))).select("page_id")


PUBLIC_WORK_HTML = """concat(
  '<div class="row-details introducao"><div class="group-title">Modalidade</div><div class="card-info"> TP ', id, '/2020 </div>',
  '<div class="group-title">Descrição</div><div class="card-info"><b>Obra</b>  ', setor, '</div>',
  '<div class="group-title">Situação</div><div class="card-info">', CASE situ WHEN 'F' THEN 'Concluída' WHEN 'O' THEN 'em Andamento' ELSE 'Contrato Rescindido' END, '</div>',
  '<div class="group-title">Etapa</div><div class="card-info">-</div>',
  '<div class="group-title">Concluído</div><div class="card-info">', id % 100, ',5%</div></div>',
  '<div class="row-group bigCard contrato"><div class="row-cards">',
  '<div class="row-card"><div class="card-title">Contrato</div><div class="card-info">', id, '/2019</div></div>',
  '<div class="row-card"><div class="card-title">Início</div><div class="card-info">', date_format(inicio, 'dd/MM/yyyy'), '</div></div>',
  '<div class="row-card"><div class="card-title">Prazo</div><div class="card-info">', id % 300, ' dias</div></div>',
  '<div class="row-card"><div class="card-title">Valor</div><div class="card-info">R$ ', {money}, '</div></div></div></div>',
  '<div class="row-group bigCard contratado"><div class="row-cards">',
  '<div class="row-card"><div class="card-title">CNPJ</div><div class="card-info">00.000.', lpad(id % 1000, 3, '0'), '/0001-00</div></div>',
  CASE WHEN id % 2 = 0 THEN '' ELSE concat('<div class="row-card"><div class="card-title">Razão social</div><div class="card-info">EMPRESA ', id, '</div></div>') END, '</div></div>',
  '<div class="row-group bigCard valorPagoAcum"><div class="group-title">Pago</div><div class="card-info">',
  CASE WHEN id % 5 = 0 THEN '-' ELSE {money} END, '</div></div>',
  '<section class="description-obra allDocuments">', array_join(transform(sequence(1L, id % 3 + 1), i ->
    concat('<div class="attachment"><p class="cardTitle"> Doc  ', i, '</p><div class="button"><a href="', CASE WHEN i = 3 THEN '' ELSE concat('https://obras.example.org/', id, '/', i, '.pdf') END, '">Abrir</a></div></div>')), ''), '</section>')"""


def _work_pages(spark, d) -> DataFrame:
    """Public-works detail pages derived from every customer, with their sections extracted.

    A customer is a few bytes and its page thousands, so customers are dealt to all cores first: a file of millions of them may be one
    task, and the adaptive planner would leave it one.
    """
    customers = table(spark, d, "customer")
    tasks = max(3 * spark.sparkContext.defaultParallelism, customers.rdd.getNumPartitions())
    html = F.expr(PUBLIC_WORK_HTML.replace("{money}", "translate(format_number(valor, 2), ',.', '.,')"))
    landed = customers.repartition(tasks, "c_custkey").selectExpr(
        "c_custkey AS id", "c_mktsegment AS setor", "CAST(c_acctbal AS DECIMAL(18,2)) AS valor",
        "substr('FOP', c_nationkey % 3 + 1, 1) AS situ", "date_add(DATE '2020-01-01', CAST(c_custkey % 1000 AS INT)) AS inicio",
    ).select(
        F.concat(F.lit("https://obras.example.org/obra/"), F.col("id").cast("string")).alias("url"), html.alias("html"))
    return web.extract_sections(landed, "url", "html", web.PUBLIC_WORK_SECTIONS)


DUCK_WORKS = """(SELECT c_custkey AS id, c_mktsegment AS setor, CAST(c_acctbal AS DECIMAL(18,2)) AS valor,
  substr('FOP', c_nationkey % 3 + 1, 1) AS situ, DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS inicio FROM customer)"""
DUCK_WORK_ID = "substr(sha256('https://obras.example.org/obra/' || id), 1, 16)"


@query("works_flatten", f"""
SELECT {DUCK_WORK_ID} AS obra_id, 'TOMADA DE PREÇO' AS tipo_modalidade, 'Obra ' || setor AS descricao_obra,
  CASE situ WHEN 'F' THEN 'CONCLUIDA' WHEN 'O' THEN 'EM_ANDAMENTO' ELSE 'RESCINDIDA' END AS situacao,
  CAST(NULL AS VARCHAR) AS etapa_obra, CAST(CAST(id % 100 AS DECIMAL(9,4)) + 0.5 AS DECIMAL(9,4)) AS percentual_concluido,
  CASE WHEN id % 100 < 25 THEN '0-25%' WHEN id % 100 < 50 THEN '25-50%' WHEN id % 100 < 75 THEN '50-75%'
    WHEN id % 100 < 100 THEN '75-100%' END AS faixa_conclusao,
  id || '/2019' AS numero_contrato_principal, id || '/2019' AS numero_contrato_referencia, inicio AS data_inicio, id % 300 AS prazo_dias,
  valor AS valor_contratado,
  '00.000.' || lpad(CAST(id % 1000 AS VARCHAR), 3, '0') || '/0001-00' AS cnpj_contratada,
  CASE WHEN id % 2 <> 0 THEN 'EMPRESA ' || id END AS razao_social_contratada,
  CASE WHEN id % 5 <> 0 THEN valor END AS valor_pago_acumulado
FROM {DUCK_WORKS}""")
def works_flatten(spark, d):
    return silver.flatten_works(_work_pages(spark, d)).select(
        "obra_id", "tipo_modalidade", "descricao_obra", "situacao", "etapa_obra", "percentual_concluido",
        "faixa_conclusao", "numero_contrato_principal", "numero_contrato_referencia", "data_inicio", "prazo_dias", "valor_contratado",
        "cnpj_contratada", "razao_social_contratada", "valor_pago_acumulado",
    )


DUCK_DOCUMENTS = f"""SELECT id, {DUCK_WORK_ID} AS obra_id, 'Doc ' || i AS documento_titulo,
  'https://obras.example.org/' || id || '/' || i || '.pdf' AS documento_url
  FROM (SELECT *, unnest(generate_series(1, least(id % 3 + 1, 2))) AS i FROM {DUCK_WORKS})"""


@query("docs_explode", f"SELECT obra_id, documento_titulo, documento_url FROM ({DUCK_DOCUMENTS})")
def docs_explode(spark, d):
    return silver.work_documents(_work_pages(spark, d), only_http=True).select(
        "obra_id", "documento_titulo", "documento_url")


@query("left_doc_join", f"""
SELECT d.obra_id, d.documento_url, CASE WHEN o.situ = 'F' THEN 'CONCLUIDA' WHEN o.situ = 'O' THEN 'EM_ANDAMENTO' END AS situacao,
  CASE WHEN o.situ <> 'P' THEN o.valor END AS valor_contratado
FROM ({DUCK_DOCUMENTS}) d LEFT JOIN {DUCK_WORKS} o ON d.id = o.id""")
def left_doc_join(spark, d):
    from ..operators.joins import documents_with_works

    # sections are landed once, as the extraction job does; both sides then read columns of it
    path = scratch_path(spark, "works")
    files.write_table(_work_pages(spark, d), path)
    pages = spark.read.parquet(path)
    works = silver.flatten_works(pages).where("situacao <> 'RESCINDIDA'")
    documents = silver.work_documents(pages).select("obra_id", "documento_url")
    return documents_with_works(documents, works, ["situacao", "valor_contratado"])


@query("union_counts", """
SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents""")
def union_counts(spark, d):
    return dedupe.union_counts({t: table(spark, d, t) for t in ("orders", "lineitem", "events", "documents")})


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(spark, d):
    return rollups.value_counts(table(spark, d, "orders"), "o_orderpriority")

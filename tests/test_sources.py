import io
import json
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from civiclake.operators import normalize
from civiclake.sources import archives, files, payload, schemas, web


def test_jsonl_keeps_raw_text(spark, tmp_path):
    (tmp_path / "lote_1.jsonl").write_text(
        '{"numero":"0008","ano":2026,"lista":[{"a":1,"b":null}],"vazio":null}\n', encoding="utf-8")
    row = files.read_jsonl(spark, f"{tmp_path}/lote_*.jsonl", ["numero", "ano", "lista", "vazio", "ausente"]).first()
    assert tuple(row) == ("0008", "2026", '[{"a":1,"b":null}]', None, None)


def test_empty_glob_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_jsonl(spark, f"{tmp_path}/none_*.jsonl", ["a"])


def test_layouts():
    assert [len(schemas.layout_for(p)) for p in ("*.EMPRECSV", "*.ESTABELE", "*.SOCIOCSV", "Socios0.csv")] == [7, 30, 11, 11]
    assert len(schemas.AMENDMENT_DOCUMENTS) == 26
    assert list(schemas.AMENDMENT_FIELDS.values()) == schemas.AMENDMENT
    with pytest.raises(ValueError):
        schemas.layout_for("*.PAISCSV")


def land(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("iso-8859-1"))


def test_layout_csv(spark, tmp_path):
    land(tmp_path / "a/b/K1.EMPRECSV", '"1";"AÇÃO ""X""; Ltda";"2";"3";"4,00";"5";""\n"2";"NA";"2"\n')
    land(tmp_path / "K2.EMPRECSV", '"3";"b";"2";"3";"4";"5";"6";"sobra"\n"4";"a;b;c;d;e;f;g;h";"2"\n"5";"x";"2";"3";"4";"5";"6";\n')
    land(tmp_path / "other.txt", "ignored\n")
    rows, rejects = files.read_layout_csv(spark, str(tmp_path), "*.EMPRECSV")
    got = {r["cnpj_basico"]: r for r in rows.collect()}
    assert sorted(got) == ["1", "2", "4"]
    assert got["1"]["razao_social"] == 'AÇÃO "X"; Ltda' and got["1"]["ente_federativo_responsavel"] is None
    assert got["2"]["razao_social"] == "NA" and got["2"]["capital_social"] is None
    assert sorted(r["raw"][:3] for r in rejects.collect()) == ['"3"', '"5"']
    assert rejects.count() == 2 and rows.count() == 3
    per_file = {r["file_name"]: r["rows"] for r in files.count_by_file(rows).collect()}
    assert per_file == {"K1.EMPRECSV": 2, "K2.EMPRECSV": 1}
    tokens, _ = files.read_layout_csv(spark, str(tmp_path), "*.EMPRECSV", na_tokens=["NA", "NULL"])
    assert tokens.where("cnpj_basico = '2'").first()["razao_social"] is None


def test_layout_csv_multi_line(spark, tmp_path):
    land(tmp_path / "K.EMPRECSV", '"1";"linha\nquebrada";"2";"3";"4";"5";"6"\n')
    rows, _ = files.read_layout_csv(spark, str(tmp_path), "*.EMPRECSV", multi_line=True)
    assert rows.first()["razao_social"] == "linha\nquebrada"


def test_json_array_round_trip(spark, tmp_path):
    df = spark.range(0, 20, 1, 3).select("id", F.when(F.col("id") != 3, F.lit("x")).alias("t"))
    files.write_json_arrays(df, f"{tmp_path}/out")
    assert all(json.loads(p.read_text()) is not None for p in (tmp_path / "out").glob("part-*"))
    back = files.read_json_documents(spark, f"{tmp_path}/out", "id bigint, t string")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_zstd_parquet(spark, tmp_path):
    files.write_table(spark.range(10), f"{tmp_path}/t")
    assert all(".zstd." in p.name for p in (tmp_path / "t").glob("*.parquet"))


A1 = {
    "draw": 1, "recordsTotal": 1200, "data": [
        {"autor": "7100 - AUTORA FICTICIA", "codigoEmenda": "202571000042", "skTipoEmenda": 2, "ano": 2025, "numeroEmenda": "0042",
         "valorPago": "2.718.281,82", "funcao": None},
        {"codigoEmenda": "S/I"}, {"codigoEmenda": "REL. GERAL"},
    ],
}


def test_amendment_page(spark):
    pages = spark.createDataFrame([(1, json.dumps(A1)), (2, "<html>"), (3, "{}"), (4, '{"data": null}')], "page int, body string")
    rows = payload.explode_payload(pages, "body")
    assert rows.count() == 3
    flat = rows.select("page", "records_total", *payload.map_fields(F.col("record"), schemas.AMENDMENT_FIELDS, schemas.NULL_WHEN_MISSING))
    row = flat.where("codigo_emenda = '202571000042'").first()
    assert (row["records_total"], row["sk_tipo_emenda"], row["numero_emenda"], row["valor_total_a1"]) == (1200, "2", "0042", "2.718.281,82")
    assert row["programa"] == "" and row["subfuncao"] is None and row["funcao"] is None
    from civiclake.operators.joins import valid_amendments

    valid, rejected = valid_amendments(flat)
    assert (valid.count(), rejected.count()) == (1, 2)
    plan = payload.document_request(payload.page_plan(valid, "records_total"))
    offsets = sorted((r["page_offset"], r["params"]["offset"], r["params"]["codigo"]) for r in plan.collect())
    assert offsets == [(0, "0", "202571000042"), (1000, "1000", "202571000042")]


def test_page_plan_empty(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1000), ("c", 1001)], "k string, n bigint")
    got = sorted((r["k"], r["page_offset"]) for r in payload.page_plan(df, "n").collect())
    assert got == [("b", 0), ("c", 0), ("c", 1000)]


def test_revenue_files(spark, tmp_path):
    level = {"codigo": "1", "denominacao": "Receitas Correntes"}
    record = {"receita": {"codigo": 275, "tipoReceita": "Bruta"}, "unidadeGestora": {"codigo": 43014, "denominacao": "Fundo"},
              "naturezaReceita": {lv: level for lv in schemas.REVENUE_LEVELS},
              "listFonteRecursos": [{"codigo": 101, "denominacao": "MSC", "percentual": 100.0}],
              "exercicio": {"exercicio": 2024},
              "listMovimentos": [{"dataMovimento": "2024-05-09", "tipoMovimento": "x", "valorMovimento": 183500.37}]}
    bare = {**record, "listMovimentos": []}
    (tmp_path / "u1.json").write_text(json.dumps({"totalRegistros": 2, "registros": [{"registro": record}, {"registro": bare}]}, indent=2))
    (tmp_path / "u2.json").write_text(json.dumps({"totalRegistros": 0, "registros": []}))
    records = payload.explode_revenue(files.read_json_documents(spark, str(tmp_path), schemas.revenue_file()))
    moves = payload.revenue_movements(records, ["categoriaEconomica"]).orderBy(F.col("valor_movimento").asc_nulls_first()).collect()
    assert [str(m["valor_movimento"]) for m in moves] == ["None", "183500.37"]
    assert str(moves[1]["data_movimento"]) == "2024-05-09" and moves[1]["categoriaEconomica"] == "Receitas Correntes"
    assert payload.revenue_funds(records).count() == 2


def test_small_payloads(spark):
    d = json.dumps({"pojo": {"unidades": [{"codigo": "3012", "denominacaoPara": "para Fundo A "}]}})
    assert tuple(payload.unit_dictionary(spark.createDataFrame([(d,)], "b string"), "b").first()) == ("3012", "Fundo A")
    a = json.dumps({"rows": [{"arquivo": "f.pdf", "data_publicacao": "01/01/2024", "descricao": "x"}]})
    assert tuple(payload.allowance_files(spark.createDataFrame([(a,)], "b string"), "b", "http://u/").first()) == (
        "http://u/f.pdf", "01/01/2024", "x", "f.pdf")


def zip_bytes(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return buffer.getvalue()


def curriculum(uf="PE", status="CONCLUIDO", name="JosÃ© da Silva"):
    address = f'<ENDERECO-PROFISSIONAL UF="{uf}"/>' if uf else ""
    return (f'<CURRICULO-VITAE DATA-ATUALIZACAO="01022024" HORA-ATUALIZACAO="101112"><DADOS-GERAIS NOME-COMPLETO="{name}">'
            f'<RESUMO-CV T="r"/><ENDERECO>{address}</ENDERECO><DOUTORADO STATUS-DO-CURSO="{status}"/>'
            f'<ATUACAO-PROFISSIONAL I="UFPE"><VINCULOS A="1"/></ATUACAO-PROFISSIONAL></DADOS-GERAIS>'
            f'<ARTIGO-PUBLICADO ANO="2020"/></CURRICULO-VITAE>').encode()


def test_curriculum_archives(spark, tmp_path):
    cases = {"1": curriculum(), "2": curriculum(uf="SP"), "3": curriculum(uf=None), "4": curriculum(status="X"), "5": b"<broken"}
    for key, body in cases.items():
        (tmp_path / f"{key}.zip").write_bytes(zip_bytes({f"{key}.xml": body}))
    (tmp_path / "6.zip").write_bytes(b"no zip")
    (tmp_path / "7.zip").write_bytes(zip_bytes({"other.xml": curriculum()}))
    profiles, rejects = archives.read_zip_profiles(spark, str(tmp_path))
    rows = profiles.collect()
    assert [r["id_lattes"] for r in rows] == ["1"]
    r = rows[0]
    assert (r["nome"], r["data_atualizacao"], r["hora_atualizacao"], r["uf_atuacao"]) == ("José da Silva", "2024-02-01", "101112", "PE")
    assert r["general_data"]["children"]["RESUMO-CV"] == {"T": "r"}
    assert r["professional_performances"][0]["attributes"] == {"I": "UFPE"}
    assert r["professional_performances"][0]["children"] == {"VINCULOS": {"A": "1"}}
    assert len(r["bibliographic_productions"]) == 1 and r["research_projects"] == []
    assert sorted(x["id_lattes"] for x in rejects.collect()) == ["5", "6", "7"]


def test_zip_csv(spark, tmp_path):
    body = '"1";"AÇÃO; X"\n"2";"y";"sobra"\n"3"\n'.encode("latin-1")
    (tmp_path / "Empresas0.zip").write_bytes(zip_bytes({"K.EMPRECSV": body}))
    (tmp_path / "bad.zip").write_bytes(b"x")
    rows, rejects = archives.read_zip_csv(spark, str(tmp_path), ["a", "b"])
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [("1", "AÇÃO; X"), ("3", None)]
    assert sorted(r["archive"] for r in rejects.collect()) == ["Empresas0.zip", "bad.zip"]


WORK_PAGE = """<div class="row-details introducao"><div class="group-title">Modalidade</div><div class="card-info"><p>TP 1/2020</p></div>
<div class="group-title">Situação</div><div class="card-info">Paralisada</div></div>
<div class="row-group bigCard contrato"><div class="row-cards"><div class="row-card"><div class="card-title">Contrato</div>
<div class="card-info"> 12/2019 </div></div></div></div>
<div class="row-group bigCard valorPagoAcum"><div class="group-title">Pago</div><div class="card-info">R$ 10,00</div></div>
<section class="description-obra allDocuments"><div class="attachment"><p class="cardTitle">Edital</p>
<div class="button"><a target="_blank" href="https://x/1.pdf">Abrir</a></div></div></section><a href="/fora">x</a>"""


def test_work_page_sections(spark):
    pages = spark.createDataFrame([("u", WORK_PAGE)], "url string, html string")
    row = web.extract_sections(pages, "url", "html", web.PUBLIC_WORK_SECTIONS, require_values=True).first()
    assert [(p["category"], p["value"]) for p in row["general_info"]["paired_data"]] == [("Modalidade", "TP 1/2020"), ("Situação", "Paralisada")]
    assert [(p["category"], p["value"]) for p in row["contract"]["paired_data"]] == [("Contrato", "12/2019")]
    assert row["contracted"]["paired_data"] == []
    assert [(p["category"], p["value"]) for p in row["all_documents"]["paired_data"]] == [("Edital", "https://x/1.pdf")]
    assert row["work_location"] == ["https://x/1.pdf"]
    s = row["extraction_summary"]
    assert (s["processed"], s["successful"], s["failed"], str(s["success_rate"]), s["grade"]) == (8, 5, 3, "0.63", "needs_improvement")
    config = {**web.PUBLIC_WORK_SECTIONS, "broken": web.Section(values=None, categories="x")}
    row = web.extract_sections(pages, "url", "html", config).first()
    s = row["extraction_summary"]
    assert (s["processed"], s["successful"], s["failed"], str(s["success_rate"]), s["grade"]) == (9, 8, 1, "0.89", "good")
    assert "broken" not in row.asDict()


def test_listing_links(spark):
    html = '<a class="box status" href="/1">x</a><a href="/2"></a><div><a class="next page-numbers" href="/p2">n</a></div>'
    pages = spark.createDataFrame([("u", html), ("v", "")], "url string, html string")
    got = [(r["page_url"], r["position"], r["href"]) for r in web.links(pages, "url", "html", "box status").collect()]
    assert got == [("u", 0, "/1")]
    assert [r[0] for r in pages.select(web.next_page(F.col("html"))).collect()] == ["/p2", None]


def test_manifest(spark):
    rows = [("https://h/cnpj/2024-05/", "Empresas0.zip"), ("https://h/cnpj/2024-05", "Cnaes.zip"), ("https://h/cnpj/temp/", "Socios1.zip")]
    got = web.manifest(spark.createDataFrame(rows, "d string, f string"), "d", "f").collect()
    assert [tuple(r) for r in got] == [("https://h/cnpj/2024-05/Empresas0.zip", "Empresas0.zip", "2024-05", "Empresas0")]


def test_normalise(spark):
    df = spark.createDataFrame([(1, [("x", None)], None)], "a int, b array<struct<k: string, v: string>>, c string")
    out = normalize.rename_coerce(df, {"a": "id", "zz": "q"})
    assert out.columns == ["id", "b", "c"] and tuple(out.first()) == ("1", '[{"k":"x","v":null}]', None)
    stamped = normalize.stamp(out, datetime(2024, 3, 1, 6, tzinfo=timezone.utc))
    assert stamped.columns[0] == "data_extracao" and stamped.select(F.date_format("data_extracao", "yyyy-MM-dd HH")).first()[0] == "2024-03-01 06"
    assert normalize.conform(out, ["c", "id", "novo"]).columns == ["c", "id", "novo"]
    both = normalize.append_by_name([out.select("c", "id"), out.select("id")], ["id", "c"])
    assert both.count() == 2


def test_year_window(spark):
    df = spark.createDataFrame([("2024-05-01", 2024, "2024"), ("2026-01-01", 2026, "x")], "d string, y int, t string").withColumn("d", F.to_date("d"))
    for column in ("d", "y", "t"):
        assert normalize.year_window(df, column, 2023, 2024, ["y"]).collect()[0]["y"] == 2024


def test_table_contract(spark, tmp_path):
    for _ in range(2):
        files.create_table_if_missing(spark, "t_contract", ["a", "b"], f"{tmp_path}/tc")
    assert [f.simpleString() for f in spark.table("t_contract").schema] == ["data_extracao:timestamp", "a:string", "b:string"]
    spark.sql("DROP TABLE t_contract")


def test_jsonl_per_unit(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "unidade int, nome string")
    files.write_jsonl(df, f"{tmp_path}/u", partition_by=["unidade"])
    assert sorted(p.name for p in (tmp_path / "u").iterdir() if p.is_dir()) == ["unidade=1", "unidade=2"]
    back = spark.read.schema("nome string, unidade int").json(f"{tmp_path}/u")
    assert sorted((r["unidade"], r["nome"]) for r in back.collect()) == [(1, "a"), (2, None)]


def test_selection_is_nested_quoted_and_repeated(spark):
    page = """<main><DIV CLASS='a card-info b'>A <div>inner <div>deep</div></div> tail</DIV><div class="card-infos">no</div>
      <section id=x class='group one'><p class="t">1</p><a href='u?"1"'>x</a></section><p class="t">out</p>
      <section class="one group"><p class='t'>2</p><A class=z HREF="v">y</A></section>"""
    df = spark.createDataFrame([("u", page)], "url string, html string")
    pages = web.extract_sections(df, "url", "html", {
        "info": web.Section(values=web.tag_text("div", "card-info")),
        "group": web.Section(values=web.tag_attribute("a", "href"), categories=web.tag_text("p", "t"),
                             scope=web.opening("section", "group"), scope_end=r"(?i)</section\s*>"),
        "crossed": web.Section(values=web.tag_text("p", "t"), scope=web.opening("section", "one"), scope_end="</section>",
                               categories=web.tag_text("div", "card-info"), category_scope=web.opening("main"))}).first()
    assert pages["info"] == ["A inner deep tail"]
    assert [(p["category"], p["value"]) for p in pages["group"]["paired_data"]] == [("1", 'u?"1"'), ("2", "v")]
    assert pages["crossed"]["paired_data"][0]["category"] == "A inner deep tail"
    inside = web.links(df, "url", "html", container=web.opening("section", "one"), container_end="</section>").collect()
    assert [r["href"] for r in inside] == ['u?"1"', "v"]


@pytest.mark.parametrize("page, want", [
    ('<div class="c">a' + "<div>x" * 40 + "</div>" * 40 + 'b</div><p>no</p><div class="c">2</div>', ["ax" + "x" * 39 + "b", "2"]),
    ('<DIV CLASS="b c">1<div class=\'c\'>in</div></DIV>', ["1in", "in"]),  # an outer element before those in it
    ('</div><div class="c">a</div></div>b<div class="c">d</div>', ["a", "d"]),  # closing tags without an opening one
    ('<div class="c">open <div>never', ["open never"]),
    ('<div class="c"><br>a<img src="x"><div/>b</div>c', ["ab"]),  # empty elements do not count
    ('<div class="c"/>t<div class="c">u</div>', ["", "u"]),
    ('<!-- <div class="c">no</div> --><div class="c"><!-- <div> -->yes</div>', ["yes"]),
    ('<script>"<div>"</script><div class="c">a</div><style>div </style>', ["a"]),
    ('<div class="c">a<divider>b</divider></div>c', ["ab"]),
    ('<div class="cc">a</div><section class="c">b</section>', []),
    ("", []), ("no tags < at > all", []),
])
def test_elements_by_depth(spark, page, want):
    found = web.find_all(F.col("html"), web.tag_text("div", "c"))
    bare = F.transform(found, lambda x: F.regexp_replace(x, "<[^>]*>|<!--.*?-->", ""))
    assert spark.createDataFrame([(page,)], "html string").select(bare).first()[0] == want


def test_void_elements_and_missing_pages(spark):
    df = spark.createDataFrame([("<br><hr class='c'>",), (None,)], "html string").coalesce(1)
    got = df.select(web.find_all(F.col("html"), web.tag_text("hr", "c")), web.find_all(F.col("html"), web.tag_text("div"))).collect()
    assert [tuple(r) for r in got] == [([""], []), (None, None)]


def test_section_details(spark):
    page = '<h1> </h1><a href="1">x</a><a href="2"> </a><a href="3">z</a>'
    df = spark.createDataFrame([("u", page)], "url string, html string")
    config = {"nav": web.Section(values=web.tag_attribute("a", "href"), categories=web.tag_text("a")),
              "title": web.Section(values=web.tag_text("h1")), "broken": web.Section(values=None)}
    for strict in (False, True):
        row = web.extract_sections(df, "url", "html", config, require_values=strict, details=True).first()
        found = row["section_details"]
        nav, title, broken = (found[k] for k in ("nav", "title", "broken"))
        assert (nav["method"], nav["categories_found"], nav["values_found"], nav["mapped"], nav["error"]) == ("paired_data", 2, 3, 2, None)
        assert (nav["categories"]["status"], str(nav["categories"]["score"]), nav["values"]["status"]) == ("needs_review", "0.67", "good")
        assert (title["method"], title["values"]["status"], title["values"]["complete"], title["categories"]) == (
            "failed" if strict else "list", "needs_review", False, None)
        assert broken["method"] == "failed" and broken["error"].startswith("Erro na seção broken") and broken["values"] is None
        assert (title["error"] is not None) == strict and "broken" not in row.asDict()
    assert "section_details" not in web.extract_sections(df, "url", "html", config).columns

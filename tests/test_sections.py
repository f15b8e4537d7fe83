"""Sections of many pages: what is shared between them gives what each gives by itself."""

from pyspark.sql import functions as F

from civiclake.catalogue import shaping
from civiclake.functions.text import clean_html_list, clean_html_lists
from civiclake.sources import web

WORK_PAGE = """<div class="row-details introducao"><div class="group-title">Modalidade</div><div class="card-info"><p>TP 1/2020</p></div></div>
<div class="row-group bigCard contrato"><div class="card-title">Contrato</div><div class="card-info"> 12/2019 </div></div>
<section class="description-obra allDocuments"><p class="cardTitle">Edital</p><a href="https://x/1.pdf">Abrir</a></section><a href="/fora">x</a>"""


def test_areas_of_tags_are_those_of_each_scope(spark):
    group = '<div class="bigCard contrato">a<div class="card-info">1</div></div>'
    pages = [
        "", None, "x" + group, group * 3 + "<section>" + group + "</section>" + group, group + "<SECTION class='allDocuments x'>s</SECTION >t",
        group.replace("contrato", "aditivo") + group + '<div class="contrato  bigCard">n</div>', WORK_PAGE,
        # tags whose end or attributes are in doubt, the mark itself, more pieces than are put together
        '<div title="a > b" class="bigCard contrato">q' + group, '<div title="<div class=\'bigCard contrato\'>" class="bigCard contrato">r' + group,
        '<div class="bigCard > <div class="bigCard contrato">u' + group, "<div t=' class=\"bigCard contrato'>" + group + "'",
        '<div title="x class=" class="bigCard contrato">' + group, "\x01" + group + "a\x01<div>", group + "<section", group * 1200,
    ]
    scopes = {(s.scope, s.scope_end): f"a{i}" for i, s in enumerate(web.PUBLIC_WORK_SECTIONS.values())}
    scopes |= {(web.opening("div", "contrato"), None): "open", (r"(?i)<div class=\"(big)Card", "</div>"): "plain", (None, None): "whole"}
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = web.areas(df, "html", scopes).orderBy("i").collect()
    want = df.select("i", *[web.area(F.col("html"), *scope).alias(name) for scope, name in scopes.items()]).orderBy("i").collect()
    for g, w in zip(got, want, strict=True):
        assert {name: g[name] for name in scopes.values()} == {name: w[name] for name in scopes.values()}, pages[g["i"]]


def test_a_pattern_runs_once_however_many_sections_share_it(spark):
    pages = spark.createDataFrame([("u", WORK_PAGE)], "url string, html string")
    plan = web.extract_sections(pages, "url", "html", web.PUBLIC_WORK_SECTIONS)._jdf.queryExecution().optimizedPlan().toString()
    # three elements, the links and the titles of documents
    assert plan.count("regexp_extract_all(") == 5


def test_lists_are_cleaned_as_each_by_itself(spark):
    lists = [[" a  b ", "<b>c</b>\n d", "<i></i>", ""], [], [" e  f", "1 < 2", "3 > 2", "\x1c-\t"], ["x"]]
    rows = [(lists,), ([["p\x01q", " r "], ["\x02"]],), ([[" s"], None],), ([None],), ([],), ([[]],)]
    df = spark.createDataFrame(rows, "v array<array<string>>").coalesce(1)
    got = df.select(clean_html_lists(F.col("v")), F.transform("v", clean_html_list)).collect()
    assert [r[0] for r in got] == [r[1] for r in got]
    assert got[0][0] == [["a b", "c d"], [], ["e f", "1 < 2", "3 > 2", "-"], ["x"]]


def test_pages_of_one_file_are_made_by_all_cores(spark, tmp_path):
    rows = [(i, f"n{i}", i % 25, i * 1.5, "BUILDING") for i in range(40)]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(
        f"{tmp_path}/customer.parquet")
    assert shaping._work_pages(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert shaping.left_doc_join(spark, str(tmp_path)).count() == sum(min(i % 3 + 1, 2) for i in range(40))

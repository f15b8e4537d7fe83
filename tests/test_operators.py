import random
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from civiclake.operators import dedupe, joins, profiling, quality, ranking, rollups, skew
from civiclake.operators.quality import Rule
from civiclake.plans import silver


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedupe_latest_brute_force(spark):
    rng = random.Random(7)
    data = [(rng.choice("aaaab"), rng.randrange(3), rng.randrange(5), i) for i in range(500)]
    df = spark.createDataFrame(data, "k string, g int, t int, i int")
    got = rows_of(dedupe.dedupe_latest(df, ["k", "g"], [F.desc("t"), F.desc("i")]))
    want = {}
    for r in data:
        if r[:2] not in want or (r[2], r[3]) > want[r[:2]][2:]:
            want[r[:2]] = r
    assert got == sorted(want.values(), key=str)


def test_silver_quotes(spark):
    raw = spark.createDataFrame(
        [("t", "a", "x", "u1", 1), ("t", "a", "y", "u2", 2), ("t", "b", "z", "u3", 1), (None, "b", "z", "u4", 1)],
        "texto string, autor string, tags string, url_origem string, ingestion_at int")
    got = rows_of(silver.silver_quotes(raw).select("quote_text", "author_name", "tags"))
    assert got == sorted([("t", "a", "y"), ("t", "b", "z"), (None, "b", "z")], key=str)


def test_batch_diff_and_same_rows(spark):
    cur = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    prev = spark.createDataFrame([(2, None), (3, "x")], "k int, v string")
    assert rows_of(dedupe.batch_diff(cur, prev)) == [(1, "a"), (3, "c")]
    assert tuple(dedupe.same_rows(cur, cur).first()) == (0, True)
    assert tuple(dedupe.same_rows(cur, cur.dropDuplicates()).first()) == (1, False)


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (5, "e"), (5, "e")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (5, "e")], "k int, v string")
    got = {r["k"]: (r["change"], r["rows_added"], r["rows_removed"]) for r in dedupe.snapshot_diff(old, new, ["k"]).collect()}
    assert got == {2: ("changed", 1, 1), 3: ("removed", 0, 1), 4: ("added", 1, 0), 5: ("changed", 0, 1)}
    one, two = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert tuple(dedupe.snapshot_diff(one, two, ["k"]).first()) == (1, "changed", 1, 0)
    assert tuple(dedupe.snapshot_diff(two, one, ["k"]).first()) == (1, "changed", 0, 1)


def test_skew_join_keeps_every_row(spark):
    many = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"))
    one = spark.createDataFrame([("hot", 1), ("2", 2), ("absent", 3)], "k string, v int")
    keys, null_is_hot = skew.hot_keys(many, "k", fraction=1.0)
    assert keys == ["hot"] and null_is_hot
    for how in ("inner", "left"):
        plain = many.join(one, "k", how).select("k", "n", "v")
        salted = skew.skew_join(many, one, "k", how, min_share=0.01).select("k", "n", "v")
        assert rows_of(salted) == rows_of(plain)
        assert "_salt" in salted._jdf.queryExecution().toString()


def test_skew_join_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
        one = spark.range(-1, 20000).select(F.col("id").alias("k"))
        sizes = skew.skew_join(many, one, "k", min_share=0.01).groupBy(F.spark_partition_id()).count().collect()
        assert max(s["count"] for s in sizes) < 20000 / 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_amend_documents(spark):
    a1 = spark.createDataFrame([("202571000042", "A"), ("202571000043", "B"), ("S/I", "C")], "codigo_emenda string, autor string")
    a2 = spark.createDataFrame([("202571000042", 1), ("202571000042", 2), ("S/I", 3)], "codigo_emenda string, doc int")
    assert rows_of(joins.amend_documents(a1, a2)) == [("202571000042", 1, "A"), ("202571000042", 2, "A")]


def test_company_match_and_network(spark):
    est = spark.createDataFrame([("12345678", "0001", "95", "PE"), ("12345678", "0002", "17", "BA")],
                                "cnpj_basico string, cnpj_ordem string, cnpj_dv string, uf string")
    pay = spark.createDataFrame([("12.345.678/0001-95 - FUNDO", 1), ("123.456.789-00 - M", 2), ("texto", 3), (None, 4)], "favorecido string, n int")
    got = joins.company_match(pay, est).collect()
    assert [(r["n"], r["uf"]) for r in got] == [(1, "PE")]
    companies = spark.createDataFrame([("12345678", "FUNDO"), ("1", "SEM")], "cnpj_basico string, razao_social string")
    partners = spark.createDataFrame([("12345678", "p1"), ("12345678", "p2"), ("1", "p3"), ("9", "p4")], "cnpj_basico string, socio string")
    got = {r["socio"]: (r["razao_social"], r["establishments"], r["states"]) for r in joins.partner_network(companies, est, partners).collect()}
    assert got == {"p1": ("FUNDO", 2, 2), "p2": ("FUNDO", 2, 2), "p3": ("SEM", 0, 0)}
    assert rows_of(joins.orphans(partners, "cnpj_basico", companies, "cnpj_basico")) == [("9", 1)]


def test_rollups(spark):
    docs = spark.createDataFrame([("e", "Empenho", Decimal("10.00")), ("e", "Pagamento", Decimal("4.00")), ("f", "Outra", None)],
                                 "codigo_emenda string, fase_documento string, valor decimal(18,2)")
    d = Decimal
    assert rows_of(rollups.execution_rollup(docs)) == [("e", 2, d("14.00"), d("4.00")), ("f", 1, None, d("0.00"))]
    assert rows_of(rollups.phase_pivot(docs)) == [("e", d("10.00"), d("0.00"), d("4.00")), ("f", d("0.00"), d("0.00"), d("0.00"))]
    got = rows_of(rollups.revenue_rollup(docs, ["codigo_emenda", "fase_documento"], "valor").where("nivel = 3").select("valor", "movimentos"))
    assert got == [(d("14.00"), 2)]
    assert rows_of(rollups.truncation_audit(spark.createDataFrame([("a", 5)] * 2 + [("b", 1)], "k string, t int"), "k", "t", 2)) == [
        ("a", 2, 5, False, True), ("b", 1, 1, True, False)]
    assert rows_of(rollups.value_counts(docs, "codigo_emenda")) == [("e", 2), ("f", 1)]
    assert rows_of(rollups.null_counts(docs, ["valor", "codigo_emenda"])) == [("codigo_emenda", 3, 0), ("valor", 2, 1)]
    assert tuple(rollups.duplicate_summary(docs, ["codigo_emenda"]).first()) == (1, 1)


def test_slice_by_rank(spark):
    rng = random.Random(3)
    keys = rng.sample(range(100000), 3000)
    df = spark.createDataFrame([(f"{k:06d}.zip", k) for k in keys], "name string, k int").repartition(7)
    want = sorted(f"{k:06d}.zip" for k in keys)
    for offset, size in ((0, 10), (1234, 500), (2990, 100), (5000, 10)):
        assert [r["name"] for r in ranking.slice_by_rank(df, "name", offset, size).orderBy("name").collect()] == want[offset:offset + size]
    holes = spark.createDataFrame([(None,), (1,), (2,), (3,), (None,)], "k int")
    assert [r["k"] for r in ranking.slice_by_rank(holes, "k", 0, 2).collect()] == [1, 2]
    assert ranking.slice_by_rank(holes.where("k is null"), "k", 0, 2).collect() == []
    indexed = ranking.global_index(df.select("name"), [F.col("name")]).collect()
    assert sorted((r["_index"], r["name"]) for r in indexed) == list(enumerate(want))


def test_rules_and_gate(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), (None, 2, "x")], "k string, p int, v string").withColumn(
        "data_extracao", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    parent = spark.createDataFrame([(1,)], "id int")
    rules = [
        Rule("t", "k", "not_null"), Rule("t", "v", "not_null", "warn"), Rule("t", "data_extracao", "not_null"),
        Rule("t", "k", "unique", "warn"), Rule("t", "p", "relationships", parent=("par", "id")),
        Rule("t", "data_extracao", "freshness", "warn", max_age_days=90),
    ]
    now = datetime(2024, 3, 31, tzinfo=timezone.utc)
    results = quality.run_rules({"t": df, "par": parent}, rules, now)
    got = {(r["kind"], r["column_name"]): (r["failures"], r["status"]) for r in results.collect()}
    assert got == {("not_null", "k"): (1, "FAIL"), ("not_null", "v"): (1, "WARN"), ("not_null", "data_extracao"): (0, "PASS"),
                   ("unique", "k"): (1, "WARN"), ("relationships", "p"): (2, "FAIL"), ("freshness", "data_extracao"): (0, "PASS")}
    assert tuple(quality.gate(results).first()) == (2, 2, 2, False)
    only = quality.select_rules(rules, names=["not_null_t_v"])
    assert tuple(quality.gate(quality.run_rules({"t": df}, only)).first()) == (0, 1, 0, True)
    late = quality.run_rules({"t": df}, rules[-1:], datetime(2024, 4, 1, tzinfo=timezone.utc)).first()
    assert late["status"] == "WARN"
    assert len(quality.BRONZE_RULES) == 19


def test_completeness(spark):
    df = spark.createDataFrame([("a", 1), (" - ", None), ("NA", 3), (None, 4)], "s string, n int")
    got = {r["column_name"]: tuple(r)[1:] for r in profiling.completeness(df).collect()}
    assert got == {"s": (1, 1, 2, Decimal("25.00")), "n": (3, 1, 0, Decimal("75.00"))}


def test_mixed_score(spark):
    df = spark.createDataFrame([("10/10/2020 (termo)",), ("rescisão",), ("x",), (None,)], "c string")
    row = profiling.mixed_score(df, "c").first()
    assert tuple(row) == ("c", 100, 1, 1, {"RESCISÃO": 1, "TERMO": 1}, 3, 3)
    empty = profiling.mixed_score(df.where("c IS NULL"), "c").first()
    assert (empty["score"], empty["total"]) == (0, 0)


def test_status_flags(spark):
    d = Decimal
    data = [("RESCINDIDA", d("97.00"), d("100.00"), d("160.00")), ("Rescindida", None, d("100.00"), d("95.00")),
            ("CONCLUIDA", d("100"), d("100.00"), d("151.00")), ("RESCINDIDA", d("10"), d("0.00"), d("50.00")), (None, d("99"), None, None)]
    df = spark.createDataFrame(data, "s string, p decimal(9,4), c decimal(18,2), v decimal(18,2)")
    got = profiling.status_flags(df, "s", "p", "c", "v").orderBy(F.desc("severity"), "v").collect()
    assert [(r["flags"], r["severity"]) for r in got] == [
        (["FISICA_COMPLETA", "FINANCEIRA_COMPLETA", "VALOR_EXCEDIDO"], 3), (["FINANCEIRA_COMPLETA"], 1), (["VALOR_EXCEDIDO"], 1)]
    assert got[0]["descriptions"] == ["Rescindida mas 97.0% concluída", "Rescindida mas 160.0% executada", "Valor pago >> valor contratado"]


def test_flatten_and_documents(spark):
    pair = "struct<category: string, value: string>"
    names = ["general_info", "contract", "contracted", "fiscal_year_expenditures", "contract_amendment", "cumulative_amount_paid", "all_documents"]
    ddl = ", ".join(f"{n} struct<paired_data: array<{pair}>>" for n in names) + ", source_url string"
    general = ["PREGÃO 1", " obra  x ", "Contrato Rescindido", "-", "45,5%", "", None, "01/02/2024"]
    row = (
        ([(str(i), v) for i, v in enumerate(general)],),
        ([("", "12"), ("", "01/01/2020"), ("", "120 dias"), ("", "R$ 1.000,00"), ("", "10/10/2020 RESCISÃO")],),
        ([("34/2019", "12.345.678/0001-95")],), ([("Valor médio acumulado", "1,00")],), ([],), ([("Pago", "900,00")],),
        ([("Edital", " http://a "), ("", "ftp://b"), ("vazio", ""), ("nulo", None)],), "u",
    )
    df = spark.createDataFrame([row, (None,) * 7 + ("v",)], ddl)
    got = silver.flatten_works(df).where("source_url = 'u'").first()
    assert (got["tipo_modalidade"], got["descricao_obra"], got["situacao"], got["etapa_obra"], got["faixa_conclusao"]) == (
        "PREGÃO", "obra x", "RESCINDIDA", None, "25-50%")
    assert (got["prazo_dias"], got["valor_contratado"], got["cnpj_contratada"], got["razao_social_contratada"]) == (
        120, Decimal("1000.00"), "12.345.678/0001-95", None)
    assert (got["valor_medio_acumulado"], got["valor_pago_periodo"], got["valor_pago_acumulado"]) == (Decimal("1.00"), None, Decimal("900.00"))
    assert silver.flatten_works(df).count() == 2
    docs = silver.work_documents(df)
    assert rows_of(docs.select("documento_titulo", "documento_url")) == [("Edital", "http://a"), (None, "ftp://b")]
    assert silver.work_documents(df, only_http=True).count() == 1


def test_silver_amendments(spark):
    cols = "data_extracao timestamp, codigo_emenda string, codigo_documento string, ano string, valor_documento string, data_documento string, favorecido string"
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    df = spark.createDataFrame([
        (t1, "202571000042", "2026OB1", "2026", "1,00", "13/04/2026", "x"),
        (t2, "202571000042", "2026OB1", "2026", "500.000,00", "13/04/2026", "12.345.678/0001-95 - FUNDO"),
        (t2, "S/I", "2026OB1", "2026", "1,00", "13/04/2026", "x")], cols)
    got = silver.silver_amendments(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["ano"], r["valor_documento"], str(r["data_documento"]), r["favorecido_id"], r["favorecido_nome"], r["favorecido_tipo"]) == (
        2026, Decimal("500000.00"), "2026-04-13", "12345678000195", "FUNDO", "CNPJ")

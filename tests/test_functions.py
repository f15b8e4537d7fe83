from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from civiclake import functions as fx
from civiclake.operators.profiling import date_category


def test_money(apply):
    got = apply(fx.brl_money, ["R$ 1.234,56", "1.653.375,00", "0,00", "-", "", None, "abc", "R$ 7,5 ", "1234.5"])
    assert got == [Decimal("1234.56"), Decimal("1653375.00"), Decimal("0.00"), None, None, None, None,
                   Decimal("7.50"), Decimal("12345.00")]


def test_percent(apply):
    got = apply(fx.pct, ["45,5%", "100%", " 7 % ", "-", "", None, "1.234,5%", "3.5"])
    assert got == [Decimal("45.5000"), Decimal("100.0000"), Decimal("7.0000"), None, None, None, None, Decimal("3.5000")]


def test_dates(apply):
    got = apply(fx.date_br, ["13/04/2026", "31/02/2024", "1/2/2024", "-", "", None, "2024-01-01"])
    assert got == [date(2026, 4, 13), None, date(2024, 2, 1), None, None, None, None]


def test_days(apply):
    assert apply(fx.days, ["120 dias", "1 DIA", "prazo 30dias", "-", "", None, "dias"]) == [120, 1, 30, None, None, None, None]


def test_clean_text(apply):
    got = apply(fx.clean_text, ["  a \n\t b ", "-", " - ", "", None, " x  y "])
    assert got == ["a b", None, None, None, None, "x y"]


def test_modality(apply):
    got = apply(fx.modality, ["Pregão Eletrônico 12", "TP 3/2020", "cv", "xyz 1", "", None, "  "])
    assert got == ["PREGÃO", "TOMADA DE PREÇO", "CONVITE", "XYZ", None, None, None]


def test_document_kind(apply):
    got = apply(fx.doc_kind, ["123.456.789-00", "12.345.678/0001-95", "x", "", None])
    assert got == ["CPF", "CNPJ", "IRRGULAR", None, None]


def test_payee(apply):
    got = apply(fx.split_payee, [
        "12.345.678/0001-95 - FUNDO MUNICIPAL - SAUDE", "123.456.789-00 - MARIA", "***.456.789-** - JOSE",
        "MULTIPLOS FAVORECIDOS", None, "12345678000195",
    ])
    assert [tuple(r) for r in got] == [
        ("12345678000195", "FUNDO MUNICIPAL - SAUDE", "CNPJ"), ("12345678900", "MARIA", "CPF"),
        ("456789", "JOSE", "CPF"), (None, "MULTIPLOS FAVORECIDOS", "outro"), (None, None, None),
        ("12345678000195", None, "CNPJ"),
    ]


def test_payee_cnpj_agrees_with_split(apply):
    texts = ["12.345.678/0001-95 - A", "12345678000195", "123.456.789-00 - M", "texto", None, " 12345678000195 - B"]
    split = [r["id"] if r["kind"] == "CNPJ" else None for r in apply(fx.split_payee, texts)]
    from civiclake.functions.brazil import payee_cnpj

    assert apply(payee_cnpj, texts) == split


def test_status_and_bands(apply):
    assert apply(fx.status_code, ["Concluída", "em Andamento", "Contrato Rescindido", "Paralisada", "Outra", None]) == [
        "CONCLUIDA", "EM_ANDAMENTO", "RESCINDIDA", "PARALISADA", None, None]
    values = [Decimal(v) for v in ("0", "25", "25.1", "50", "75", "100", "100.1", "-1")] + [None]
    assert apply(fx.pct_band, values, "decimal(9,4)") == [
        "0-25%", "0-25%", "25-50%", "25-50%", "50-75%", "75-100%", None, None, None]


def test_compact_date(apply):
    assert apply(fx.compact_date, ["01022024", "99999999", "123", "", None]) == ["2024-02-01", "9999-99-99", "123", "", ""]


def test_valid_code(apply):
    got = apply(fx.is_valid_code, ["202571000042", "2026390000", "S/I", "REL. GERAL", "", None, "123456789", "1" * 15, "2026390000\n"])
    assert got == [True, True, False, False, False, False, False, False, False]


def test_code_parts(apply):
    assert tuple(apply(fx.split_amendment_code, ["202571000042"])[0]) == ("2025", "71000", "042")
    assert [tuple(r) for r in apply(fx.code_name, ["3900 - ADRIANO - BALDY", "S/I"])] == [("3900", "ADRIANO - BALDY"), ("S/I", None)]
    assert apply(fx.document_type, ["2025OB271828", "x"]) == ["OB", None]
    assert apply(fx.document_phase, ["2026NE1", "2026NS1", "2026OB1", "2026XX1", None]) == ["Empenho", "Liquidação", "Pagamento", None, None]


def test_mojibake(apply):
    got = apply(fx.fix_mojibake, ["JosÃ©", "José", "日本", "a\x00b\x1f ", None, "Ação  ", "ÃÃ"])
    assert got == ["José", "José", "日本", "ab", None, "Ação", "ÃÃ"]


def test_html(apply):
    assert apply(fx.strip_html, ["<b>Obra</b>\n x  <i>y</i> ", "<br>"]) == ["Obra x y", ""]
    assert apply(fx.clean_html_list, [["<b>a</b>", "<br/>", " c "]], "array<string>") == [["a", "c"]]
    assert apply(fx.normal_category, [" Valor Médio (R$) "]) == ["valor_médio_r"]


def test_short_id(apply):
    import hashlib

    url = "https://example.org/obra/1"
    assert apply(fx.short_id, [url]) == [hashlib.sha256(url.encode()).hexdigest()[:16]]


def zipped(spark, cats, vals):
    df = spark.createDataFrame([(cats, vals)], "c array<string>, v array<string>")
    return df.select(fx.zip_pairs(F.col("c"), F.col("v")).alias("z")).first()["z"]


def test_zip_pairs(spark):
    z = zipped(spark, ["a", "b"], ["1", "2"])
    assert (z["pairing_quality"], z["paired_ratio"], z["total_pairs"], z["unpaired_values"]) == ("excellent", "2/2", 2, [])
    assert [tuple(p) for p in z["paired_data"]] == [("a", "1", 0, "high"), ("b", "2", 1, "high")]
    z = zipped(spark, ["a"], ["1", "2", "3"])
    assert (z["pairing_quality"], z["paired_ratio"], z["unpaired_values"]) == ("poor", "1/3", ["2", "3"])
    z = zipped(spark, list("abcdef"), list("12345"))
    assert (z["pairing_quality"], z["paired_ratio"], z["unpaired_values"]) == ("good", "5/5", [])
    z = zipped(spark, [], [])
    assert (z["pairing_quality"], z["paired_ratio"], z["total_pairs"]) == ("excellent", "0/0", 0)
    z = zipped(spark, ["", " "], ["x", "y"])
    assert [p["confidence"] for p in z["paired_data"]] == ["low", "medium"]


def test_pair_lookup(spark):
    pairs = [("Valor Médio Acumulado no período", "1"), ("Pago no PERÍODO", "2"), ("exercicio e periodo", "3"), ("Exercício", "4")]
    df = spark.createDataFrame([(pairs,)], "p array<struct<category: string, value: string>>")
    from civiclake.plans.silver import SPENDING_RULES

    row = df.select(
        *[fx.pair_by_keyword(F.col("p"), SPENDING_RULES, t).alias(t) for t in SPENDING_RULES],
        fx.pair_at(F.col("p"), 9, "value").alias("none"), fx.pair_value(F.col("p"), "exercício").alias("key"),
    ).first()
    assert tuple(row) == ("1", "3", "4", None, "4")


def test_list_quality(spark):
    df = spark.createDataFrame([([], []), (["a", "b", "c"], ["a"]), (["a"], ["a"])], "r array<string>, c array<string>")
    got = [tuple(r["q"]) for r in df.select(fx.list_quality(F.col("r"), F.col("c")).alias("q")).collect()]
    assert got == [("no_data", Decimal("0.00"), None), ("needs_review", Decimal("0.33"), True), ("good", Decimal("1.00"), True)]


def test_date_category(apply):
    got = apply(date_category, [None, " ", "-", "10/10/2020 Rescisão unilateral", "PARALISAÇÃO (01/02/2020) REINÍCIO 03/04/2020",
                                "paralisacao", " 01/01/2020 ", "01/01/2020 x"])
    assert got == ["VAZIO_OU_HIFEN", "VAZIO_OU_HIFEN", "VAZIO_OU_HIFEN", "DATA_COM_TERMO_RESCISAO", "HISTORICO_COMPLETO",
                   "DATA_COM_PARALISACAO", "DATA_SIMPLES", "OUTRO_FORMATO"]

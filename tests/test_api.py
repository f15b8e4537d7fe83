import json
from datetime import datetime, timezone

from civiclake.api import *  # noqa: F403
from civiclake.api import AMENDMENT_DOCUMENTS, BRONZE_RULES, Ledger, PipelineSpec, bronze, run_pipeline, select_rules, silver_amendments


def test_amendments_from_file_to_silver(spark, tmp_path):
    """The whole path: landed lots of two months, audit, publication, typed table."""
    base = {c: "" for c in AMENDMENT_DOCUMENTS}
    row = {**base, "codigo_emenda": "202571000042", "codigo_documento": "2025OB271828", "fase_documento": "Pagamento",
           "data_documento": "13/04/2026", "favorecido": "12.345.678/0001-95 - FUNDO DE TESTE",
           "valor_documento": "500.000,00", "ano": 2026, "sk_tipo_emenda": 2, "numero_emenda": "0042"}
    landing = tmp_path / "landing"
    landing.mkdir()
    spec = PipelineSpec(name="cgu", source=f"{landing}/lote_*.jsonl", table="cgu_emendas_parlamentares", columns=AMENDMENT_DOCUMENTS,
                        rules=select_rules(BRONZE_RULES, tables=["cgu_emendas_parlamentares"]))
    ledger = Ledger(spark, str(tmp_path / "lake"))
    for month, value in ((1, "500.000,00"), (2, "600.000,00")):
        lines = [{**row, "valor_documento": value}, {**row, "codigo_emenda": "S/I", "favorecido": None}]
        (landing / "lote_1.jsonl").write_text("\n".join(json.dumps(r) for r in lines))
        result = run_pipeline(spark, spec, ledger, datetime(2026, month, 1, tzinfo=timezone.utc))
        assert result["published"] and (result["verdict"]["passed"], result["verdict"]["warned"]) == (4, 1)
    raw = ledger.read_ref("cgu_emendas_parlamentares", bronze(AMENDMENT_DOCUMENTS))
    assert raw.count() == 4
    typed = silver_amendments(raw.drop("_ingest_id")).collect()
    assert len(typed) == 1 and str(typed[0]["valor_documento"]) == "600000.00" and typed[0]["numero_emenda"] == "0042"
    assert (typed[0]["sk_tipo_emenda"], typed[0]["favorecido_id"]) == (2, "12345678000195")

"""Write-audit-publish, time travel and incremental ingestion over the events table.

The events are staged by every query, one ingest per day, with a ledger next to them.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import same_rows
from ..operators.dedupe import snapshot_diff as diff_snapshots
from ..operators.quality import Rule
from ..plans.compact import compact
from ..plans.diff import ref_diff
from ..plans.profiles import ref_profile, write_profile
from ..plans.spec import CsvTable, PipelineSpec, run_pipeline
from ..plans.wap import INGEST, Ledger
from ..session import scratch_path
from ..sources.files import write_jsonl
from ..sources.schemas import bronze
from ..streaming.ingest import stream_pipeline
from .registry import query, table

EVENTS = "eventos"
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def _utc(month: int, day: int) -> datetime:
    return datetime(2024, month, day, tzinfo=timezone.utc)


def _lake(spark: SparkSession, d: str, tag: str) -> tuple[Ledger, list[str]]:
    """A ledger over the staged events, nothing published yet, and the ids of the days."""
    root = scratch_path(spark, f"lake-{tag}")
    events = table(spark, d, "events").select(*COLUMNS, F.date_format("ts", "yyyyMMdd").alias("_day"))
    days = sorted(r[0] for r in events.select(F.concat(F.lit("d"), "_day")).distinct().collect())  # one id per calendar day
    staged = events.withColumn(INGEST, F.concat(F.lit("d"), "_day")).drop("_day")
    staged.hint("rebalance", F.col(INGEST)).write.partitionBy(INGEST).option("compression", "zstd").parquet(f"{root}/{EVENTS}")
    return Ledger(spark, root), days


def _publish(ledger: Ledger, days: list[str], branch: str, at: datetime) -> None:
    then = ledger.at(at)
    then.create_branch(branch)
    then.mark_staged(branch, [(EVENTS, i) for i in days])
    then.publish(branch)
    then.delete_branch(branch)


def _published_twice(spark, d, tag: str) -> tuple[Ledger, list[str]]:
    """Days up to the 10th published on 1 February, the others on 1 March."""
    ledger, days = _lake(spark, d, tag)
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    _publish(ledger, [i for i in days if i > "d20240110"], "carga_2", _utc(3, 1))
    return ledger, days


ROWS = "SELECT event_id, ts, user_id, event_type, value FROM events"


def _rows(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


@query("snapshot_history", """
SELECT 'd' || strftime(ts, '%Y%m%d') AS ingest_id,
  CASE WHEN min(ts) < TIMESTAMP '2024-01-11' THEN 'carga_1' ELSE 'carga_2' END AS branch,
  CASE WHEN min(ts) < TIMESTAMP '2024-01-11' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01' END AS committed_at, count(*) AS linhas
FROM events GROUP BY 1""")
def snapshot_history(spark, d):
    ledger, _ = _published_twice(spark, d, "history")
    rows = ledger.read_ref(EVENTS, SCHEMA).groupBy(F.col(INGEST).alias("ingest_id")).agg(F.count("*").alias("linhas"))
    return ledger.history(EVENTS).drop("seq").join(rows, "ingest_id")


@query("branch_read", f"{ROWS} WHERE ts < TIMESTAMP '2024-01-16'")
def branch_read(spark, d):
    ledger, days = _lake(spark, d, "read")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    ledger.at(_utc(2, 2)).create_branch("revisao")
    ledger.at(_utc(2, 2)).mark_staged("revisao", [(EVENTS, i) for i in days if "d20240110" < i <= "d20240115"])
    _publish(ledger, [i for i in days if i > "d20240120"], "outra", _utc(2, 3))  # later merges do not leak in
    return _rows(ledger.read_ref(EVENTS, SCHEMA, "revisao"))


@query("branch_merge", ROWS)
def branch_merge(spark, d):
    ledger, _ = _published_twice(spark, d, "merge")
    return _rows(ledger.read_ref(EVENTS, SCHEMA))


@query("isolation_check", """
SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-11') AS main_antes, count(*) AS branch_antes, count(*) AS main_depois, CAST(0 AS BIGINT) AS differing_rows, true AS equal FROM events""")
def isolation_check(spark, d):
    ledger, days = _lake(spark, d, "isolation")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    ledger.at(_utc(2, 2)).create_branch("isolada")
    ledger.at(_utc(2, 2)).mark_staged("isolada", [(EVENTS, i) for i in days if i > "d20240110"])
    before = ledger.read_ref(EVENTS, SCHEMA)
    branch = ledger.read_ref(EVENTS, SCHEMA, "isolada")
    ledger.at(_utc(3, 1)).publish("isolada")
    after = ledger.read_ref(EVENTS, SCHEMA)
    # one-row frames side by side as a union, then summed
    counts = None
    for name, frame in {"main_antes": before, "branch_antes": branch, "main_depois": after}.items():
        row = frame.agg(F.count("*").alias("n")).select(
            *[(F.col("n") if c == name else F.lit(0).cast("bigint")).alias(c) for c in ("main_antes", "branch_antes", "main_depois")],
            F.lit(0).cast("bigint").alias("differing_rows"))
        counts = row if counts is None else counts.unionByName(row)
    difference = same_rows(_rows(branch), _rows(after)).select(
        *[F.lit(0).cast("bigint").alias(c) for c in ("main_antes", "branch_antes", "main_depois")], "differing_rows")
    total = counts.unionByName(difference)
    return total.agg(*[F.sum(c).alias(c) for c in total.columns]).withColumn("equal", F.col("differing_rows") == 0)


@query("ref_compare", """
SELECT 'eventos' AS table_name, count(*) FILTER (ts < TIMESTAMP '2024-01-11') AS rows_a,
  count(*) AS rows_b, count(*) FILTER (ts < TIMESTAMP '2024-01-11') = count(*) AS equal FROM events""")
def ref_compare(spark, d):
    ledger, days = _lake(spark, d, "compare")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    ledger.at(_utc(2, 2)).create_branch("revisao")
    ledger.at(_utc(2, 2)).mark_staged("revisao", [(EVENTS, i) for i in days if i > "d20240110"])
    return ledger.compare("main", "revisao")


def _compacted(spark, d, tag: str) -> Ledger:
    """Five days published at a time and compacted as soon as three folders of a level are there; a tag after the tenth."""
    ledger, days = _lake(spark, d, tag)
    for n in range(0, len(days), 5):
        then = ledger.at(_utc(1, 1) + timedelta(days=n))
        _publish(ledger, days[n:n + 5], f"carga_{n}", then.clock())
        compact(then, EVENTS, SCHEMA, 3)
        if n == 5:
            then.tag("dez_dias")
    return ledger


@query("compacted_read", f"""
SELECT 'agora' AS estado, 'd' || strftime(ts, '%Y%m%d') AS ingest_id, count(*) AS linhas FROM events GROUP BY ALL
UNION ALL SELECT e.*, 'd' || strftime(ts, '%Y%m%d'), count(*) FROM events, (VALUES ('tag'), ('antes')) e WHERE ts < TIMESTAMP '2024-01-11' GROUP BY ALL""")
def compacted_read(spark, d):
    """Main, a tag and an earlier point in time of a table that is compacted while it grows."""
    ledger = _compacted(spark, d, "compacted")
    states = {"agora": ledger.read_ref(EVENTS, SCHEMA), "tag": ledger.read_ref(EVENTS, SCHEMA, "dez_dias"),
              "antes": ledger.read_as_of(EVENTS, SCHEMA, _utc(1, 6))}
    return reduce(DataFrame.union, [rows.groupBy(F.lit(name).alias("estado"), F.col(INGEST).alias("ingest_id")).agg(F.count("*").alias("linhas"))
                                    for name, rows in states.items()])


@query("tag_read", f"{ROWS} WHERE ts < TIMESTAMP '2024-01-11'")
def tag_read(spark, d):
    ledger, days = _lake(spark, d, "tag")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    ledger.at(_utc(2, 10)).tag("relatorio_2024_02")
    _publish(ledger, [i for i in days if i > "d20240110"], "carga_2", _utc(3, 1))
    return _rows(ledger.read_ref(EVENTS, SCHEMA, "relatorio_2024_02"))


@query("as_of_read", f"{ROWS} WHERE ts < TIMESTAMP '2024-01-11'")
def as_of_read(spark, d):
    ledger, _ = _published_twice(spark, d, "asof")
    return _rows(ledger.read_as_of(EVENTS, SCHEMA, _utc(2, 15)))


@query("snapshot_diff", """
WITH cur AS (SELECT user_id, CASE WHEN event_id % 10 = 3 THEN 'revisto' ELSE event_type END AS t FROM events WHERE user_id % 10 <> 7),
 old AS (SELECT user_id, event_type AS t FROM events WHERE ts < TIMESTAMP '2024-01-11'),
 counted AS (SELECT user_id, t, sum(n) AS n, sum(o) AS o FROM (
   SELECT user_id, t, 1 AS n, 0 AS o FROM cur UNION ALL SELECT user_id, t, 0, 1 FROM old) GROUP BY 1, 2)
SELECT user_id, CASE WHEN sum(o) = 0 THEN 'added' WHEN sum(n) = 0 THEN 'removed' ELSE 'changed' END AS change,
  CAST(sum(greatest(n - o, 0)) AS BIGINT) AS rows_added, CAST(sum(greatest(o - n, 0)) AS BIGINT) AS rows_removed
FROM counted GROUP BY user_id HAVING sum(abs(n - o)) > 0""")
def snapshot_diff(spark, d):
    """Keys with several rows in both states."""
    ledger, _ = _published_twice(spark, d, "diff")
    before = ledger.read_as_of(EVENTS, SCHEMA, _utc(2, 15)).select("user_id", "event_type")
    after = ledger.read_ref(EVENTS, SCHEMA).where("user_id % 10 <> 7").select(
        "user_id", F.expr("CASE WHEN event_id % 10 = 3 THEN 'revisto' ELSE event_type END").alias("event_type"))
    return diff_snapshots(before, after, ["user_id"])


@query("snapshot_diff_refs", """
WITH cur AS (SELECT user_id, event_type AS t FROM events WHERE ts < TIMESTAMP '2024-01-11' OR ts >= TIMESTAMP '2024-01-21'),
 old AS (SELECT user_id, event_type AS t FROM events WHERE ts < TIMESTAMP '2024-01-16'),
 counted AS (SELECT user_id, t, sum(n) AS n, sum(o) AS o FROM (
   SELECT user_id, t, 1 AS n, 0 AS o FROM cur UNION ALL SELECT user_id, t, 0, 1 FROM old) GROUP BY 1, 2)
SELECT user_id, CASE WHEN sum(o) = 0 THEN 'added' WHEN sum(n) = 0 THEN 'removed' ELSE 'changed' END AS change,
  CAST(sum(greatest(n - o, 0)) AS BIGINT) AS rows_added, CAST(sum(greatest(o - n, 0)) AS BIGINT) AS rows_removed
FROM counted GROUP BY user_id HAVING sum(abs(n - o)) > 0""")
def snapshot_diff_refs(spark, d):
    """A branch against main, both with days of their own: shared days are read for keys only."""
    ledger, days = _lake(spark, d, "diff-refs")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(2, 1))
    ledger.create_branch("revisao")
    ledger.mark_staged("revisao", [(EVENTS, i) for i in days if "d20240110" < i <= "d20240115"])
    _publish(ledger, [i for i in days if i > "d20240120"], "outra", _utc(2, 3))
    states = (ledger.ingest_ids(EVENTS, ref) for ref in ("revisao", "main"))
    return ref_diff(ledger, EVENTS, SCHEMA, ["user_id"], *states, columns=["user_id", "event_type"])


@query("ref_completeness", """
SELECT c AS column_name, count(*) - count(*) FILTER (v IS NULL) - count(*) FILTER (v IN ('', '-', 'NA', 'None')) AS valid,
  count(*) FILTER (v IS NULL) AS nulls, count(*) FILTER (v IN ('', '-', 'NA', 'None')) AS empty,
  CAST(round(CAST((count(*) - count(*) FILTER (v IS NULL) - count(*) FILTER (v IN ('', '-', 'NA', 'None'))) * 100 AS DECIMAL(24,6)) / CAST(count(*) AS DECIMAL(12,0)), 2) AS DECIMAL(5,2)) AS pct_complete,
  true AS distinct_near
FROM (SELECT 'tipo' AS c, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '-' ELSE event_type END AS v FROM events
  UNION ALL SELECT 'usuario', CAST(user_id AS VARCHAR) FROM events) GROUP BY c""")
def ref_completeness(spark, d):
    """Completeness of main from the profiles stored with its ingests, compacted in between; no row is read again."""
    root = scratch_path(spark, "profiles")
    ledger, schema = Ledger(spark, root), "usuario bigint, tipo string, dia string"
    events = table(spark, d, "events").select(F.col("user_id").alias("usuario"), F.expr(
        "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '-' ELSE event_type END").alias("tipo"), F.date_format("ts", "d").alias("dia"))
    for n in range(4):
        ledger.create_branch(f"carga_{n}")
        ledger.stage(events.where(F.col("dia").cast("int") % 4 == n), EVENTS, f"i{n}", f"carga_{n}")
        write_profile(ledger, EVENTS, schema, f"i{n}", ["usuario", "tipo"])
        ledger.publish(f"carga_{n}")
        compact(ledger, EVENTS, schema, 3)
    exact = events.agg(F.count_distinct("usuario").alias("usuario"), F.count_distinct(F.when(F.col("tipo") != "-", F.col("tipo"))).alias("tipo")).first()
    near = F.abs(F.col("distinct_estimate") - F.when(F.col("column_name") == "tipo", exact["tipo"]).otherwise(exact["usuario"])) <= 0.05 * max(exact)
    return ref_profile(ledger, EVENTS).withColumn("distinct_near", near).drop("distinct_estimate", "median_estimate")


@query("backfill_as_of", f"{ROWS} WHERE ts < TIMESTAMP '2024-01-11'")
def backfill_as_of(spark, d):
    """A load dated before the last commit is published after it and does not change the past."""
    ledger, days = _lake(spark, d, "backfill")
    _publish(ledger, [i for i in days if i <= "d20240110"], "carga_1", _utc(3, 1))
    _publish(ledger, [i for i in days if i > "d20240120"], "outra", _utc(4, 1))
    _publish(ledger, [i for i in days if "d20240110" < i <= "d20240120"], "retroativa", _utc(2, 1))
    return _rows(ledger.read_as_of(EVENTS, SCHEMA, _utc(3, 15)))


@query("rerun_load", """
SELECT TIMESTAMP '2024-02-01 00:00:00' AS data_extracao, CAST(c_custkey AS VARCHAR) AS codigo, c_name AS nome FROM customer""")
def rerun_load(spark, d):
    """A run repeated with its date, on landed rows that break a rule, changes nothing."""
    root = scratch_path(spark, "rerun")
    spec = PipelineSpec(name="clientes", source=f"{root}/landing/*", table="clientes", columns=["codigo", "nome"],
                        rename={"c_name": "nome"}, rules=[Rule("clientes", "codigo", "not_null")])
    ledger = Ledger(spark, f"{root}/lake")
    customer = table(spark, d, "customer")
    for lot, code in (("a", "c_custkey"), ("b", "CAST(NULL AS BIGINT)")):
        write_jsonl(customer.select(F.expr(code).alias("codigo"), "c_name"), f"{root}/landing/{lot}")
        run_pipeline(spark, spec, ledger, _utc(2, 1))
    run_pipeline(spark, spec, ledger, _utc(3, 1))  # a run of its own is refused
    return ledger.read_ref("clientes", bronze(spec.columns)).select("data_extracao", *spec.columns)


@query("batch_incremental", "SELECT CAST(o_orderkey AS VARCHAR) AS codigo, o_orderpriority AS nome FROM orders")
def batch_incremental(spark, d):
    """Three batch runs over a landing folder that only grows load every file once."""
    root = scratch_path(spark, "batch")
    spec = PipelineSpec(name="pedidos", source=f"{root}/landing/*", table="pedidos", columns=["codigo", "nome"],
                        rules=[Rule("pedidos", "codigo", "not_null")])
    ledger = Ledger(spark, f"{root}/lake")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("codigo"), F.col("o_orderpriority").alias("nome"))
    for month, condition in ((1, "codigo % 2 = 0"), (2, "codigo % 2 = 1"), (3, None)):
        if condition:
            write_jsonl(orders.where(condition), f"{root}/landing/lote_{month}")
        run_pipeline(spark, spec, ledger, _utc(month, 1))
    return ledger.read_ref("pedidos", bronze(spec.columns)).select(*spec.columns)


@query("csv_pipeline_load", """
SELECT 'linhas' AS parte, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS texto FROM customer WHERE c_custkey % 7 NOT IN (1, 2)
UNION ALL SELECT 'rejeitos', NULL, CASE c_custkey % 7 WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ';a;b;c;d;e;f;g;h'
  ELSE '"' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ';aberta' END FROM customer WHERE c_custkey % 7 IN (1, 2)""")
def csv_pipeline_load(spark, d):
    """Rows and dead letters of a CSV load with lines that are too long and lines with an open quote."""
    root = scratch_path(spark, "csv-load")
    key = "lpad(CAST(c_custkey AS STRING), 8, '0')"
    table(spark, d, "customer").select(F.expr(f"""CASE c_custkey % 7 WHEN 1 THEN concat({key}, ';a;b;c;d;e;f;g;h')
      WHEN 2 THEN concat('"', {key}, ';aberta') ELSE concat({key}, ';', c_name, ';;;;;') END""")).write.text(f"{root}/landing/K.EMPRECSV")
    for_csv = CsvTable("part-*", "empresas_csv", layout="*.EMPRECSV")
    spec = PipelineSpec(name="rfb", csv_root=f"{root}/landing", csv_tables=[for_csv], rules=[Rule("empresas_csv", "cnpj_basico", "not_null")])
    ledger = Ledger(spark, f"{root}/lake")
    run_pipeline(spark, spec, ledger, _utc(2, 1))
    rows = ledger.read_ref("empresas_csv", bronze(for_csv.columns)).select(
        F.lit("linhas").alias("parte"), "cnpj_basico", F.col("razao_social").alias("texto"))
    rejects = ledger.read_ref("empresas_csv_dead_letters", "raw string").select(F.lit("rejeitos"), F.lit(None).cast("string"), "raw")
    return rows.union(rejects)


@query("audited_load", """
SELECT TIMESTAMP '2024-02-01 00:00:00' AS data_extracao, CAST(c_custkey AS VARCHAR) AS codigo, c_name AS nome FROM customer
UNION ALL SELECT TIMESTAMP '2024-03-01 00:00:00', CAST(c_custkey AS VARCHAR), upper(c_name) FROM customer""")
def audited_load(spark, d):
    """Three monthly loads of a landing folder; the second breaks an error rule and stays out."""
    root = scratch_path(spark, "audited")
    spec = PipelineSpec(
        name="clientes", source=f"{root}/landing/*", table="clientes", columns=["codigo", "nome"], rename={"c_name": "nome"},
        rules=[Rule("clientes", "codigo", "not_null"), Rule("clientes", "codigo", "unique", "warn"), Rule("clientes", "data_extracao", "not_null")])
    ledger = Ledger(spark, f"{root}/lake")
    customer = table(spark, d, "customer")
    lots = [
        customer.select(F.col("c_custkey").alias("codigo"), "c_name"),
        customer.select(F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_custkey END").alias("codigo"), "c_name"),
        customer.select(F.col("c_custkey").alias("codigo"), F.upper("c_name").alias("c_name")),
    ]
    for lot, at in zip(lots, (_utc(2, 1), _utc(2, 15), _utc(3, 1))):
        write_jsonl(lot, f"{root}/landing/lote")
        run_pipeline(spark, spec, ledger, at)
    return ledger.read_ref("clientes", bronze(spec.columns)).select("data_extracao", *spec.columns)


@query("incremental_ingest", """
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS momento, event_type AS tipo FROM events""")
def incremental_ingest(spark, d):
    root = scratch_path(spark, "stream")
    landed = table(spark, d, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), F.col("event_type").alias("tipo"), "ts")
    spec = PipelineSpec(
        name="eventos", source=f"{root}/landing/*", table=EVENTS, columns=["event_id", "momento", "tipo"],
        rename={"ts_text": "momento"}, rules=[Rule(EVENTS, "event_id", "not_null"), Rule(EVENTS, "tipo", "not_null", "warn")],
    )
    ledger = Ledger(spark, f"{root}/lake")
    lots = {"lote_1": "ts < TIMESTAMP_NTZ '2024-01-16'", "lote_2": "ts >= TIMESTAMP_NTZ '2024-01-16'"}
    for lot, condition in lots.items():
        write_jsonl(landed.where(condition).drop("ts"), f"{root}/landing/{lot}")
        stream_pipeline(spark, spec, ledger, f"{root}/checkpoint", load_ts=_utc(3, 1)).awaitTermination()
    return ledger.read_ref(EVENTS, bronze(spec.columns)).select(*spec.columns)


ORDERS = "SELECT CAST(o_orderkey AS VARCHAR) AS codigo, o_orderpriority AS nome FROM orders"


def _orders_spec(root: str, **changes) -> PipelineSpec:
    return PipelineSpec(name="pedidos", source=f"{root}/landing/*", table="pedidos", columns=["codigo", "nome"],
                        rules=[Rule("pedidos", "codigo", "not_null")], **changes)


def _land_orders(spark: SparkSession, d: str, root: str, lot: str, condition: str) -> None:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("codigo"), F.col("o_orderpriority").alias("nome"))
    write_jsonl(orders.where(condition), f"{root}/landing/{lot}")


@query("concurrent_loads", ORDERS)
def concurrent_loads(spark, d):
    """Four batch runs at a time over one folder, then one more for what the losers left: every row is there once."""
    root = scratch_path(spark, "concurrent")
    spec, ledger = _orders_spec(root), Ledger(spark, f"{root}/lake")
    for rest in (0, 1):
        _land_orders(spark, d, root, f"lote_{rest}", f"codigo % 2 = {rest}")
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda _: run_pipeline(spark, spec, Ledger(spark, f"{root}/lake")), range(4)))
    run_pipeline(spark, spec, ledger)
    return ledger.read_ref("pedidos", bronze(spec.columns)).select(*spec.columns)


@query("stream_then_batch", ORDERS)
def stream_then_batch(spark, d):
    """A stream and batch runs in turn over one folder, with one record of what is loaded; published files are archived."""
    root = scratch_path(spark, "in-turn")
    spec, ledger = _orders_spec(root), Ledger(spark, f"{root}/lake")
    for rest in range(4):
        _land_orders(spark, d, root, f"lote_{rest}", f"codigo % 4 = {rest}")
        if rest % 2 == 0:
            stream_pipeline(spark, spec, ledger, f"{root}/checkpoint").awaitTermination()
        run_pipeline(spark, spec, ledger, archive_dir=f"{root}/processed" if rest == 3 else None)
    stream_pipeline(spark, spec, ledger, f"{root}/other").awaitTermination()  # a stream that begins anew finds nothing to load
    return ledger.read_ref("pedidos", bronze(spec.columns)).select(*spec.columns)


def _land_archives(rows: DataFrame, folder: str, members: int) -> None:
    """Text lines to archives in the shared folder, each of several members."""

    def pack(batches):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        system.create_dir(inner, recursive=True)
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                for k in range(members):
                    archive.writestr(f"K{k}.EMPRECSV", "\n".join(batch["line"][k::members]).encode("latin-1"))
            name = hashlib.sha256(buffer.getvalue()).hexdigest()[:16]  # the same if a task is repeated
            with system.open_output_stream(f"{inner}/Empresas_{name}.zip") as out:
                out.write(buffer.getvalue())
            yield pd.DataFrame({"archive": [name]})

    rows.mapInPandas(pack, "archive string").count()


@query("zip_member_load", """
SELECT 'linhas' AS parte, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name || '; "Ação"' AS texto FROM customer WHERE c_custkey % 7 <> 1
UNION ALL SELECT 'rejeitos', NULL, lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ';a;b;c;d;e;f;g;h' FROM customer WHERE c_custkey % 7 = 1""")
def zip_member_load(spark, d):
    """A load of archives, member by member, with its dead letters; a second run finds them loaded."""
    root = scratch_path(spark, "zip-load")
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    good = F.concat(key, F.lit(';"'), "c_name", F.lit('; ""Ação""'), F.lit('";;;;;'))
    line = F.when(F.col("c_custkey") % 7 == 1, F.concat(key, F.lit(";a;b;c;d;e;f;g;h"))).otherwise(good)
    _land_archives(table(spark, d, "customer").select(line.alias("line")), f"{root}/landing", 4)
    archives = CsvTable("Empresas*.zip", "empresas_zip", layout="*.EMPRECSV", zipped=True)
    spec = PipelineSpec(name="rfb", csv_root=f"{root}/landing", csv_tables=[archives], rules=[Rule("empresas_zip", "cnpj_basico", "not_null")])
    ledger = Ledger(spark, f"{root}/lake")
    for month in (2, 3):
        run_pipeline(spark, spec, ledger, _utc(month, 1))
    rows = ledger.read_ref("empresas_zip", bronze(archives.columns)).select(
        F.lit("linhas").alias("parte"), "cnpj_basico", F.col("razao_social").alias("texto"))
    rejects = ledger.read_ref("empresas_zip_dead_letters", "raw string").select(F.lit("rejeitos"), F.lit(None).cast("string"), "raw")
    return rows.union(rejects)

"""Declarative data-quality rules and the publish gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import orphans
from .rollups import duplicate_keys, short_key, union_all

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    """A check on one column: ``not_null``, ``unique``, ``relationships`` or ``freshness``."""

    table: str
    column: str
    kind: str
    severity: str = ERROR
    parent: tuple[str, str] | None = None  # relationships: (table, column)
    max_age_days: int = 90                 # freshness

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def select_rules(rules: list[Rule], tables: list[str] | None = None, names: list[str] | None = None) -> list[Rule]:
    return [r for r in rules if (not tables or r.table in tables) and (not names or r.name in names)]


def not_null(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All not-null rules of a table from a single scan."""
    flat = df.agg(*[F.count_if(F.col(r.column).isNull()).alias(r.name) for r in rules])
    return flat.unpivot([], [r.name for r in rules], "rule", "failures")


def unique(df: DataFrame, rule: Rule) -> DataFrame:
    """Repeated non-null keys."""
    c = F.col(rule.column)
    key = short_key(c) if isinstance(df.schema[rule.column].dataType, T.StringType) else c
    keyed = df.where(c.isNotNull()).select(key.alias("key"))
    return duplicate_keys(keyed, ["key"]).agg(F.count("*").alias("failures")).select(
        F.lit(rule.name).alias("rule"), "failures"
    )


def relationships(df: DataFrame, rule: Rule, parent: DataFrame) -> DataFrame:
    """Rows whose key has no parent."""
    lost = orphans(df, rule.column, parent, rule.parent[1])
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(rule.name).alias("rule"), "failures"
    )


def freshness(df: DataFrame, rule: Rule, now: datetime) -> DataFrame:
    """1 if the newest load is older than allowed (or there is none)."""
    return df.agg(_stale(rule, now).alias("failures")).select(F.lit(rule.name).alias("rule"), "failures")


def _stale(rule: Rule, now: datetime) -> Column:
    # a naive ``now`` is UTC; the oldest load allowed is an instant, not a calendar day
    now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    oldest = F.timestamp_seconds(F.lit((now - timedelta(days=rule.max_age_days)).timestamp()))
    fresh = F.coalesce(F.max(F.col(rule.column).cast("timestamp")) >= oldest, F.lit(False))
    return (~fresh).cast("bigint")


def observed(df: DataFrame, rules: list[Rule], now: datetime) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` that counts the failures of its not-null and freshness rules while it is written.

    The second value gives them by rule after the write; a rule that it lacks has to be run.
    """
    metrics = [F.count_if(F.col(r.column).isNull()).alias(r.name) for r in rules if r.kind == "not_null"]
    metrics += [_stale(r, now).alias(r.name) for r in rules if r.kind == "freshness"]
    if not metrics:
        return df, dict
    observation = Observation()
    return df.observe(observation, *metrics), lambda: {k: v for k, v in observation.get.items() if v is not None}


def run_rules(tables: dict[str, DataFrame], rules: list[Rule], now: datetime | None = None,
              known: dict[str, int] | None = None) -> DataFrame:
    """(table_name, column_name, kind, severity, failures, status) per rule.

    A failing rule has status FAIL if its severity is error, WARN otherwise.  ``known`` has the failures of rules that
    were counted already (``observed``); the tables of such rules are not read for them.
    """
    known = {r.name: known[r.name] for r in rules if r.name in (known or {})}
    names = [r.name for r in rules]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"rules named twice: {', '.join(twice)}")
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.kind not in ("not_null", "unique", "relationships", "freshness"):
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        if rule.name not in known:
            by_table.setdefault(rule.table, []).append(rule)
    spark = SparkSession.active()
    parts = [spark.createDataFrame(list(known.items()), "rule string, failures bigint")] if known else []
    for table, own in by_table.items():
        df = tables[table]
        plain = [r for r in own if r.kind == "not_null"]
        if plain:
            parts.append(not_null(df, plain))
        for rule in own:
            if rule.kind == "unique":
                parts.append(unique(df, rule))
            elif rule.kind == "relationships":
                parts.append(relationships(df, rule, tables[rule.parent[0]]))
            elif rule.kind == "freshness":
                parts.append(freshness(df, rule, now or datetime.now(timezone.utc)))
    results = union_all(parts)
    facts = results.sparkSession.createDataFrame(
        [(r.name, r.table, r.column, r.kind, r.severity) for r in rules],
        "rule string, table_name string, column_name string, kind string, severity string")
    out = results.join(facts, "rule").select("table_name", "column_name", "kind", "severity", "failures")
    failing = F.col("failures") > 0
    return out.withColumn(
        "status",
        F.when(~failing, "PASS").when(F.col("severity") == ERROR, "FAIL").otherwise("WARN"),
    )


def gate(results: DataFrame) -> DataFrame:
    """Verdict row: counts per status; any FAIL blocks publication, warnings do not."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    ).withColumn("publish", F.col("failed") == 0)


# Rules of the raw tables (fixed values).
BRONZE_RULES = [
    Rule("lattes_raw", "data_extracao", "not_null"),
    Rule("lattes_raw", "id_lattes", "not_null"),
    Rule("lattes_raw", "id_lattes", "unique", WARN),
    Rule("lattes_raw", "nome", "not_null", WARN),
    Rule("rfb_cnpj_empresas", "data_extracao", "not_null"),
    Rule("rfb_cnpj_empresas", "cnpj_basico", "not_null"),
    Rule("rfb_cnpj_estabelecimentos", "data_extracao", "not_null"),
    Rule("rfb_cnpj_estabelecimentos", "cnpj_basico", "not_null"),
    Rule("rfb_cnpj_estabelecimentos", "cnae_fiscal_principal", "not_null", WARN),
    Rule("rfb_cnpj_socios", "data_extracao", "not_null"),
    Rule("rfb_cnpj_socios", "cnpj_basico", "not_null"),
    Rule("cgu_emendas_parlamentares", "data_extracao", "not_null"),
    Rule("cgu_emendas_parlamentares", "codigo_emenda", "not_null"),
    Rule("cgu_emendas_parlamentares", "codigo_documento", "not_null"),
    Rule("cgu_emendas_parlamentares", "fase_documento", "not_null"),
    Rule("cgu_emendas_parlamentares", "favorecido", "not_null", WARN),
    *[Rule(t, "data_extracao", "freshness", WARN, max_age_days=90)
      for t in ("rfb_cnpj_empresas", "rfb_cnpj_estabelecimentos", "rfb_cnpj_socios")],
]

# Rules of the Silver quotes (fixed values).
SILVER_RULES = [
    Rule("quotes", "quote_text", "not_null"),
    Rule("quotes", "quote_text", "unique"),
    Rule("quotes", "author_name", "not_null"),
]

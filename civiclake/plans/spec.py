"""Pipeline description and its batch run: read, normalise, stage, audit, publish."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import conform, drop_all_null, rename_coerce, stamp
from ..operators.quality import Rule, gate, observed, run_rules
from ..sources.archives import read_zip_csv
from ..sources.files import FILE_ID, archive_files, landed_files, read_jsonl, read_layout_csv, without_tokens
from ..sources.schemas import bronze, layout_for
from .wap import MAIN, FilesTaken, Ledger

#: What the table of a CSV table's rejected lines is called.
DEAD_LETTERS = "_dead_letters"


@dataclass(frozen=True)
class CsvTable:
    """One target of a CSV load: files matching ``pattern`` go to ``table``."""

    pattern: str
    table: str
    separator: str = ";"
    encoding: str = "ISO-8859-1"
    multi_line: bool = False
    na_tokens: tuple[str, ...] = ()
    layout: str | None = None  # file pattern whose published layout applies, if not ``pattern``
    zipped: bool = False  # ``pattern`` names archives whose members are the CSV files

    @property
    def columns(self) -> list[str]:
        return layout_for(self.layout or self.pattern)


@dataclass(frozen=True)
class PipelineSpec:
    """A load job.

    Either ``source`` (JSON Lines glob) with ``table`` and ``columns``, or ``csv_root``
    with ``csv_tables``.  ``branching`` isolates every run until its rules pass.
    """

    name: str
    source: str | None = None
    table: str | None = None
    columns: list[str] = field(default_factory=list)
    rename: dict[str, str] = field(default_factory=dict)
    csv_root: str | None = None
    csv_tables: list[CsvTable] = field(default_factory=list)
    rules: list[Rule] = field(default_factory=list)
    branching: bool = True
    from_ref: str = MAIN
    first_year: int | None = None
    last_year: int | None = None
    year_column: str = "ano"

    def check(self) -> None:
        """Contradictory settings are refused before anything runs."""
        if self.branching and not self.source and not self.csv_root:
            raise ValueError(f"{self.name}: branching needs a JSON Lines or a CSV load")
        if self.csv_root and not self.branching:
            raise ValueError(f"{self.name}: a CSV load only runs on an isolated branch")
        if self.source and not (self.table and self.columns):
            raise ValueError(f"{self.name}: a JSON Lines load needs table and columns")

    @property
    def source_columns(self) -> list[str]:
        """Names as they appear in the landed file (before renaming)."""
        back = {new: old for old, new in self.rename.items()}
        return [back.get(c, c) for c in self.columns]

    def targets(self) -> dict[str, list[str]]:
        out = {t.table: t.columns for t in self.csv_tables}
        if self.source:
            out[self.table] = list(self.columns)
        return out


def run_id(spec: PipelineSpec, at: datetime) -> str:
    return f"ingest_{spec.name}_{at:%Y%m%d_%H%M%S}"


def normalise(spec: PipelineSpec, raw: DataFrame, load_ts: datetime) -> DataFrame:
    """Landed JSON Lines rows to the raw-table contract."""
    named = conform(rename_coerce(raw, spec.rename), list(spec.columns))
    if spec.first_year is not None or spec.last_year is not None:
        year = F.col(spec.year_column).try_cast("int")
        named = named.where(year.between(spec.first_year or 0, spec.last_year or 9999))
    return stamp(named, load_ts)


def landed(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """``(target, path, *FILE_ID)`` of every landed file; a source without files is an error."""
    sources = [(spec.table, spec.source, None)] if spec.source else []
    sources += [(t.table, spec.csv_root, t.pattern) for t in spec.csv_tables]
    files = reduce(DataFrame.union, [landed_files(spark, path, pattern).select(F.lit(table).alias("target"), "path", *FILE_ID)
                                     for table, path, pattern in sources])
    found = {r[0] for r in files.select("target").distinct().collect()}
    for table, path, pattern in sources:
        if table not in found:
            raise FileNotFoundError(f"{spec.name}: no file matches {path}" + (f" with a name like {pattern}" if pattern else ""))
    return files


def load(spark: SparkSession, spec: PipelineSpec, load_ts: datetime,
         files: dict[str, list[str]]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Target table -> normalised rows, and dead-letter table -> lines that are none."""
    out, dead = {}, {}
    if files.get(spec.table or ""):
        out[spec.table] = normalise(spec, read_jsonl(spark, files[spec.table], spec.source_columns), load_ts)
    for target in spec.csv_tables:
        if not files.get(target.table):
            continue
        rows, rejects = read_csv_table(spark, spec, target, files[target.table])
        business = rows.select(*target.columns)
        out[target.table] = stamp(drop_all_null(business, target.columns), load_ts)
        dead[f"{target.table}{DEAD_LETTERS}"] = stamp(rejects, load_ts)
    return out, dead


def read_csv_table(spark: SparkSession, spec: PipelineSpec, target: CsvTable, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV target, and what is no row: ``(raw, _file)``."""
    common = {"columns": target.columns, "separator": target.separator, "encoding": target.encoding, "multi_line": target.multi_line}
    tokens = list(target.na_tokens) or None
    if not target.zipped:
        return read_layout_csv(spark, spec.csv_root, target.pattern, na_tokens=tokens, files=files, **common)
    rows, rejects = read_zip_csv(spark, spec.csv_root, files=files, **common)
    return (rows.select(*[without_tokens(F.col(c), tokens).alias(c) for c in target.columns]),
            rejects.select(F.coalesce("line", "error").alias("raw"), F.concat_ws("/", "archive", "member").alias("_file")))


def write_observed(spec: PipelineSpec, ledger: Ledger, frame: DataFrame, table: str, ingest: str, now: datetime) -> dict[str, int]:
    """Write an ingest and count the failures of the rules that need no second look at it."""
    watched, seen = observed(frame, [r for r in spec.rules if r.table == table], now)
    ledger.write(watched, table, ingest)
    return seen()


def audit(spec: PipelineSpec, ledger: Ledger, ids: dict[str, str], now: datetime, known: dict[str, int] | None = None) -> dict:
    """Run the rules over the staged ingests only: passed / warned / failed counts and ``publish``.

    Failures that ``write_observed`` has counted are taken as they are, so only uniqueness and relationships read the ingest.
    """
    rules = [r for r in spec.rules if r.table in ids]
    if not rules:
        return {"passed": 0, "warned": 0, "failed": 0, "publish": True}
    columns, known = spec.targets(), known or {}
    open_rules = [r for r in rules if r.name not in known]
    needed = {r.table for r in open_rules} | {r.parent[0] for r in open_rules if r.parent}
    tables = {
        t: ledger.spark.read.schema(bronze(columns[t])).parquet(ledger.location(t, i)) for t, i in ids.items() if t in needed
    }
    for rule in open_rules:
        if rule.parent and rule.parent[0] not in tables:
            tables[rule.parent[0]] = ledger.read_ref(rule.parent[0], bronze([rule.parent[1]]))
    return gate(run_rules(tables, rules, now, known)).first().asDict()


def published_as(ledger: Ledger, table: str, run: str) -> str | None:
    """The ingest under which a run has been published, if it has."""
    return next((i for i in ledger.published_ids(table) if i == run or i.startswith(f"{run}_")), None)


def run_pipeline(spark: SparkSession, spec: PipelineSpec, ledger: Ledger, at: datetime | None = None,
                 archive_dir: str | None = None) -> dict:
    """One load: staged on its own branch, audited, then published or rejected.

    ``at`` names the run and stamps its rows.  A run that was given its name and is published already is not
    repeated, and every attempt writes folders of its own, so nothing that a ref shows
    can change.  Only landed files that no published ingest holds are read, whether a batch or a stream has loaded them; those of a
    rejected load stay open.  If another run publishes one of the files meanwhile, this one is rejected as a whole
    (``taken``) and leaves the others to the next.  The branch is closed in any case.  Without branching the
    rows go straight to main.  ``archive_dir`` takes the files of a published load.
    """
    spec.check()
    named, at = at is not None, at or datetime.now(timezone.utc)
    run = run_id(spec, at)
    for table in spec.targets() if named else ():
        if earlier := published_as(ledger, table, run):
            return {"ingest_id": earlier, "published": True, "repeated": True, "taken": False, "verdict": {"publish": True},
                    "dead_letters": {}, "tables": sorted(spec.targets())}
    consumed, since = ledger.consumed()
    new = landed(spark, spec).join(consumed, FILE_ID, "left_anti").collect()  # the files of this load
    ingest = f"{run}_{uuid.uuid4().hex[:8]}"
    result = {"ingest_id": ingest, "published": False, "repeated": False, "taken": False, "verdict": {"publish": False},
              "dead_letters": {}, "tables": []}
    if not new:
        return result
    branch = ingest if spec.branching else f"direct_{ingest}"
    ledger.create_branch(branch, spec.from_ref)
    try:
        claim = ledger.claim(ingest, spark.createDataFrame(new))
        frames, dead = load(spark, spec, at, {t: sorted(r.path for r in new if r.target == t) for t in spec.targets()})
        known = {}
        for table, frame in {**frames, **dead}.items():
            known |= write_observed(spec, ledger, frame, table, ingest, at)
        counts = {t: spark.read.parquet(ledger.location(t, ingest)).count() for t in dead}
        ledger.mark_staged(branch, [(t, ingest) for t in [*frames, *(t for t, n in counts.items() if n)]])
        ids = {t: ingest for t in frames}
        verdict = audit(spec, ledger, ids, at, known) if spec.branching else {"publish": True}
        result |= {"verdict": verdict, "dead_letters": counts, "tables": sorted(frames)}
        if verdict["publish"]:
            try:
                ledger.publish(branch, claim, since)
                result["published"] = True
            except FilesTaken:
                result["taken"] = True
        if not result["published"]:
            ledger.reject(branch)
        elif archive_dir:
            archive_files(spark, [r.path for r in new], archive_dir)
        return result
    finally:
        ledger.delete_branch(branch)

"""What changed between two states of a table, from the ingests that only one of them shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import snapshot_diff
from .wap import Ledger


def ref_diff(ledger: Ledger, table: str, schema, keys: list[str], before: list[str], after: list[str],
             columns: list[str] | None = None) -> DataFrame:
    """``snapshot_diff`` of two states, given as the ingests they show (``ledger.ingest_ids``).

    Rows are read whole only from ingests of one state: what both hold is equal on both sides and cancels out.  Of the shared ingests
    only the keys are read, and of these only touched ones are kept, to tell a changed key from an added or removed one.
    """
    shared = sorted(set(before) & set(after))
    old, new = (ledger.read_ingests(table, schema, sorted(set(ids) - set(shared))) for ids in (before, after))
    columns = columns or [c for c in old.columns if not c.startswith("_ingest")]
    touched = snapshot_diff(old.select(*columns), new.select(*columns), keys)
    if not shared:
        return touched
    held = ledger.read_ingests(table, schema, shared).select(*[F.col(k).alias(f"_h_{k}") for k in keys])

    def same() -> Column:
        return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])

    stay = held.join(touched.select(*keys), same(), "left_semi").distinct()
    out = touched.join(stay.withColumn("_held", F.lit(True)), same(), "left")
    return out.select(*keys, F.when(F.col("_held"), "changed").otherwise(F.col("change")).alias("change"), "rows_added", "rows_removed")

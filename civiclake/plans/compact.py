"""Compaction: many ingest folders of a table become one, while every earlier point in time reads the old ones.

Folders have levels, as in a log-structured merge: ``FANOUT`` folders of a level become one of the next, so a table of ``n`` ingests
is read from some ``FANOUT * log(n)`` folders and a row is copied a logarithmic number of times.  A compaction is one commit like
any other; it is given up if another one has replaced one of its folders meanwhile.  Old folders are never deleted here: refs and
tags from before the commit show them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wap import CLAIMS, CLAIM_SCHEMA, INGEST, ORIGIN, Ledger

FANOUT = 16
_NAME = re.compile(r"compact_(\d+)_")


def level(ingest_id: str) -> int:
    found = _NAME.match(ingest_id)
    return int(found.group(1)) if found else 0


def origins(ledger: Ledger, table: str, ids: list[str]) -> list[str]:
    """The ingests that some folders, compacted ones among them, were made from."""
    made = {e.ingest_id: e.replaces for e in ledger.entries() if e.kind == "compact" and e.table_name == table}
    out, left = [], list(ids)
    while left:
        i = left.pop()
        if i in made:
            left += made[i]
        else:
            out.append(i)
    return sorted(out)


def compact(ledger: Ledger, table: str, schema: T.StructType | str, fanout: int = FANOUT) -> int:
    """Merge the folders that main shows of a table until no level has ``fanout`` of them; the number of commits made.

    The rows keep the id of the ingest they came with.
    """

    def merged(ids: list[str]) -> DataFrame:
        rows = ledger.read_ingests(table, schema, ids)
        return rows.withColumnRenamed(INGEST, ORIGIN).hint("rebalance")

    return _merge(ledger, table, lambda: ledger.ingest_ids(table), merged, fanout)


def compact_claims(ledger: Ledger, fanout: int = FANOUT) -> int:
    """The same for the lists of landed files that published ingests hold."""
    return _merge(ledger, CLAIMS, ledger.claim_ids,
                  lambda ids: ledger.spark.read.schema(CLAIM_SCHEMA).parquet(*[ledger.location(CLAIMS, i) for i in ids]).hint("rebalance"), fanout)


def _merge(ledger: Ledger, table: str, current, merged, fanout: int) -> int:
    done = 0
    while True:
        by_level: dict[int, list[str]] = {}
        for i in current():
            by_level.setdefault(level(i), []).append(i)
        full = [k for k, ids in sorted(by_level.items()) if len(ids) >= fanout]
        if not full:
            return done
        ids, name = by_level[full[0]], f"compact_{full[0] + 1}_{uuid.uuid4().hex}"
        ledger.write(merged(ids), table, name)
        if not ledger.replace(table, ids, name):
            return done  # somebody else is at it
        done += 1

"""Incremental file ingestion with Structured Streaming.

The checkpoint is the offset: each run takes the files that arrived since the last one
and stops.  A micro-batch that is repeated after a failure writes a new folder unless it was
published, so no row is loaded twice.  Files that a batch run has published are left out, and those of a
micro-batch count as consumed for batch runs: both keep one record, checked again by the commit that publishes.  A lot that the audit refuses ends the run with
``LotRejected`` and stays open: the offset moves only behind a publication.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.compact import compact, compact_claims
from ..plans.spec import PipelineSpec, audit, normalise, published_as, write_observed
from ..plans.wap import FilesTaken, Ledger
from ..sources.files import FILE_ID
from ..sources.schemas import bronze, strings


class LotRejected(RuntimeError):
    """The audit refused a micro-batch; its data stay staged, its files stay to be loaded."""


def landed_stream(spark: SparkSession, spec: PipelineSpec, max_files: int | None = None,
                  archive_dir: str | None = None) -> DataFrame:
    """JSON Lines folder as a stream.

    ``max_files`` bounds a micro-batch; ``archive_dir`` moves consumed files away (the
    move of a file happens in a later batch than its load).
    """
    reader = spark.readStream.schema(strings(spec.source_columns))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.json(spec.source).select("*", *[F.col(f"_metadata.{c}").alias(f"_{c}") for c in FILE_ID])


def stream_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    ledger: Ledger,
    checkpoint: str,
    *,
    max_files: int | None = None,
    archive_dir: str | None = None,
    load_ts: datetime | None = None,
    compact_at: int | None = None,
) -> StreamingQuery:
    """Load everything that is waiting: one staged, audited ingest per micro-batch.

    ``compact_at`` merges the folders of a level once there are as many, so that a table of many small lots stays cheap to read.
    """
    spec.check()

    def load_batch(rows: DataFrame, batch_id: int) -> None:
        at = load_ts or datetime.now(timezone.utc)
        # The query id belongs to the checkpoint: the batches of another checkpoint can
        # never be taken for these.
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = f"ingest_{spec.name}_{query_id or hashlib.sha256(checkpoint.encode()).hexdigest()}_{batch_id:08d}"
        if published_as(ledger, spec.table, run):
            return  # repeated after a failure behind the publication
        held = rows.select(*[F.col(f"_{c}").alias(c) for c in FILE_ID]).distinct().collect()  # the files of this lot
        while not publish_lot(rows, held, run, at):
            pass  # another run has published one of the files meanwhile
        if compact_at:
            compact(ledger, spec.table, bronze(spec.columns), compact_at)
            compact_claims(ledger, compact_at)

    def publish_lot(rows: DataFrame, held: list, run: str, at: datetime) -> bool:
        """Load the files of a lot that nobody holds; False if that has changed before the commit."""
        session = rows.sparkSession
        consumed, since = ledger.consumed()
        files = session.createDataFrame(held, consumed.schema)
        taken = files.join(consumed, FILE_ID, "left_semi").collect()
        if len(taken) == len(held):
            return True
        if taken:
            gone = session.createDataFrame(taken, consumed.schema).withColumnsRenamed({c: f"_{c}" for c in FILE_ID})
            rows = rows.join(gone, gone.columns, "left_anti")
            files = session.createDataFrame([f for f in held if f not in set(taken)], consumed.schema)
        ingest = f"{run}_{uuid.uuid4().hex[:8]}"
        ledger.create_branch(ingest, spec.from_ref)
        try:
            claim = ledger.claim(ingest, files)
            known = write_observed(spec, ledger, normalise(spec, rows, at), spec.table, ingest, at)
            ledger.mark_staged(ingest, [(spec.table, ingest)])
            if not audit(spec, ledger, {spec.table: ingest}, at, known)["publish"]:
                ledger.reject(ingest)
                raise LotRejected(f"{spec.name}: the rules refuse {ingest}")
            ledger.publish(ingest, claim, since)
            return True
        except FilesTaken:
            ledger.reject(ingest)
            return False
        finally:
            ledger.delete_branch(ingest)

    return (
        landed_stream(spark, spec, max_files, archive_dir)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

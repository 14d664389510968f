"""Streaming ingest: file-source ``readStream`` of a landing directory -> ``foreachBatch``.

Each micro-batch goes through the same classify/shred/harmonise/merge as a batch run.
The merges are idempotent (REPLACE by key, IGNORE by key), so a micro-batch replayed after
a failure changes nothing; the stream's checkpoint records which files were consumed.
Late data is always accepted (the keyed tables have no cutoff), so no watermark is needed
for correctness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.ingest import SourceResult, ingest_source, report_frame
from tidemark.plans.store import TableStore
from tidemark.sources.landing import read_landing


def start_ingest_stream(spark: SparkSession, store: TableStore, kind: str, landing_dir: str,
                        checkpoint_location: str, assets=None, available_now: bool = True,
                        processing_time: str | None = None, report_path: str | None = None,
                        max_files_per_trigger: int | None = None, **options):
    """Start a streaming ingest of one source (``price``, ``market`` or ``news``).

    Repeated deliveries are absorbed by the keyed merges, and stored rows carry their arrival order, so
    the result does not depend on ``max_files_per_trigger``. Every micro-batch's outcome is kept
    under ``report_path`` (a parquet table by epoch) when given; a replayed one replaces its own.
    A micro-batch whose data is unusable (no usable payload, NOT NULL violation) is recorded and
    skipped, as a batch run would lose it; any other failure stops the query so that a restart
    reprocesses the micro-batch.
    """
    landed = read_landing(spark, landing_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)
    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        res: SourceResult = ingest_source(spark, store, kind, batch, assets, **options)
        if report_path:
            report_frame(spark, [res]).write.mode("overwrite").parquet(f"{report_path}/epoch={int(epoch_id)}")
        if res.failure == "system":
            # not the data's fault: fail the micro-batch so a restart reprocesses it (the merges
            # are idempotent); data failures are recorded and the stream moves on
            raise RuntimeError(f"micro-batch {epoch_id} of {kind} failed: {res.error}")

    writer = landed.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_stream_to_completion(spark: SparkSession, store: TableStore, kind: str, landing_dir: str,
                             checkpoint_location: str, assets=None, report_path: str | None = None,
                             **options):
    """availableNow run: consume everything landed so far, then stop."""
    q = start_ingest_stream(spark, store, kind, landing_dir, checkpoint_location, assets,
                            available_now=True, report_path=report_path, **options)
    q.awaitTermination()
    return q

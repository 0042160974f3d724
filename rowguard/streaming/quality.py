"""EXT-1: quality checks on Structured Streaming DataFrames.

* Row checks are plain expressions, so ``annotate`` works on a stream as
  is; a foreign key against a *static* reference frame is a stream-static
  left join, also supported. Checks that need the whole dataset
  (uniqueness, whole-frame aggregates) have no meaning on an unbounded
  stream and are rejected; run them per micro-batch with ``metrics_stream`` or
  over all of them with ``state.state_stream``.
* ``quarantine_stream`` writes valid and quarantined rows of each
  micro-batch to two sinks through ``foreachBatch``; every batch is written
  to its own ``batch_id=<n>`` folder in overwrite mode, so a replayed
  batch (after a failure) replaces its earlier output instead of
  duplicating it.
* ``metrics_stream`` evaluates metric checks on each micro-batch and
  appends the result rows, tagged with the batch id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowguard.checks import AggregateBound, ForeignKey, Rule, Unique
from rowguard.operators.metrics import MetricCheck, evaluate
from rowguard.plans.annotate import annotate
from rowguard.plans.results import split


def annotate_stream(stream: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The annotated stream (input columns + ``_errors`` + ``_warnings``)."""
    bad = [r.name for r in rules if isinstance(r.check, (Unique, AggregateBound))]
    if bad:
        raise ValueError(f"whole-dataset checks cannot run on a stream: {bad}; use metrics_stream or state_stream")
    # foreign keys: stream-static join per row (no streaming aggregation)
    rules = [replace(r, check=replace(r.check, aggregate_keys=False)) if isinstance(r.check, ForeignKey) else r
             for r in rules]
    return annotate(stream, rules)


def _start(writer, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def quarantine_stream(
    stream: DataFrame,
    rules: Sequence[Rule],
    valid_path: str,
    quarantine_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    annotated = annotate_stream(stream, rules)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, bad = split(batch)
            valid.write.mode("overwrite").format(fmt).save(f"{valid_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").format(fmt).save(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _start(annotated.writeStream.foreachBatch(write_batch), checkpoint, available_now, processing_time)


def metrics_stream(
    stream: DataFrame,
    checks: Sequence[MetricCheck],
    results_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        res = evaluate(batch, checks).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        res.write.mode("overwrite").format(fmt).save(f"{results_path}/batch_id={batch_id}")

    return _start(stream.writeStream.foreachBatch(write_batch), checkpoint, available_now, processing_time)

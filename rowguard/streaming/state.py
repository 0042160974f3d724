"""Whole-dataset checks on streams (DST-1, DST-5, DST-6): counts merged over batches.

A uniqueness or aggregate check needs every row seen so far. Each micro-batch is
reduced to one row a key, number of rows and sums, and written to its own folder
``batch_id=<n>`` in overwrite mode, so a batch that is replayed after a failure
replaces itself. The folders together are the state: merging them (``key_state``)
gives the counts over the whole stream, from which duplicates and aggregates
follow as in batch. ``compact`` merges old folders into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowguard.functions.predicates import all_not_null, col
from rowguard.streaming.quality import _start

BATCH = "batch_id"


def reduce_batch(batch: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row a key of a batch: ``k0..``, ``n`` rows and, for the i-th of ``sums``,
    ``n_i`` known values, ``sum_i``, ``min_i``, ``max_i``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(sums):
        aggs += [F.count(col(c)).alias(f"n_{i}"), F.sum(col(c)).alias(f"sum_{i}"), F.min(col(c)).alias(f"min_{i}"), F.max(col(c)).alias(f"max_{i}")]
    named = [col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    return batch.groupBy(*named).agg(*aggs)


def state_stream(
    stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str, sums: Sequence[str] = (),
    available_now: bool = False, processing_time: str | None = None,
) -> StreamingQuery:
    """Keep the state of a stream under ``path`` (a folder that all executors share).
    Without keys it is one row a batch."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        reduce_batch(batch, keys, sums).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _start(stream.writeStream.foreachBatch(write_batch), checkpoint, available_now, processing_time)


def key_state(spark: SparkSession, path: str) -> DataFrame:
    """The state over all batches: one row a key, counts and sums added up."""
    parts = spark.read.parquet(path)
    keys = [c for c in parts.columns if c[0] == "k" and c[1:].isdigit()]
    pick = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    return parts.groupBy(*keys).agg(*[pick[c.split("_")[0]](c).alias(c) for c in parts.columns if c not in keys and c != BATCH])


def duplicate_rows(spark: SparkSession, path: str, nulls_distinct: bool = True) -> DataFrame:
    """DST-1..3 over the stream so far: ``row_count, considered_rows, duplicate_groups, duplicate_rows, excess_rows``."""
    state = key_state(spark, path)
    keys = [c for c in state.columns if c[0] == "k" and c[1:].isdigit()]
    complete = all_not_null(keys) if nulls_distinct else F.lit(True)
    dup = complete & (F.col("n") > 1)
    total = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0)).cast("bigint")
    return state.agg(
        total(F.lit(True), F.col("n")).alias("row_count"), total(complete, F.col("n")).alias("considered_rows"), F.count_if(dup).alias("duplicate_groups"),
        total(dup, F.col("n")).alias("duplicate_rows"), total(dup, F.col("n") - 1).alias("excess_rows"))


def aggregate_bounds(spark: SparkSession, path: str, bounds: Sequence[tuple[int, str, float, str]]) -> DataFrame:
    """DST-5 / DST-6 over the stream so far: one row a group and bound.

    ``bounds``: (number in ``sums``, ``count | sum | avg | min | max``, limit, ``min | max``);
    ``ok`` is false where the group's value is below a ``min`` or above a ``max`` limit
    (a group without known values breaks no bound).
    """
    state = key_state(spark, path)
    keys = [c for c in state.columns if c[0] == "k" and c[1:].isdigit()]
    rows = []
    for i, kind, limit, side in bounds:
        value = {"count": F.col("n"), "sum": F.col(f"sum_{i}"), "avg": F.try_divide(F.col(f"sum_{i}"), F.col(f"n_{i}")),
                 "min": F.col(f"min_{i}"), "max": F.col(f"max_{i}")}[kind].cast("double")
        bad = value < limit if side == "min" else value > limit
        rows.append(F.struct(F.lit(i).alias("measure"), F.lit(kind).alias("kind"), value.alias("value"), (~F.coalesce(bad, F.lit(False))).alias("ok")))
    return state.select(*keys, F.inline(F.array(*rows)))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the merged state to ``target`` as one batch; later batches may go on there."""
    key_state(spark, path).write.mode("overwrite").parquet(f"{target}/{BATCH}=-1")

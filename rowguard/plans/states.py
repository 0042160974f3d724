"""Mergeable metric states per partition (AGG-4..8, EXT-4 over time).

A metric of a growing table need not be computed from all of it again. ``build``
keeps, for every partition (a day, a file set) and column, what merges exactly
(rows, nulls, sum, extremes) and two sketches that merge with bounded error
(distinct values, quantiles). ``update`` adds the partitions that a stored state
does not hold yet, and reads only these; ``merged`` gives metrics of any set of
partitions from their states alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.predicates import col

#: accuracy of the sketches: HLL registers as a power of two, KLL's k (rank error about 1.65 / k ** 0.98)
HLL_BITS = 12
KLL_K = 800
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def build(df: DataFrame, partition: Column, columns: Sequence[str], name: str = "part") -> DataFrame:
    """One row a partition and column: ``part, column, row_count, null_count, total,
    min, max, distinct_sketch, quantile_sketch`` (numbers as double).

    One scan: columns are unpivoted, and the state of a partition and column is one
    row a task in the shuffle, so a partition with most of the rows is not hot. NaN
    counts as null. Decimals and bigints beyond 2^53 are rounded to double.
    """
    for c in columns:
        if not isinstance(df.select(col(c)).schema[0].dataType, _NUMERIC):
            raise ValueError(f"metric states are of numbers, {c} is not")
    entries = [F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("v")) for c in columns]
    rows = df.select(partition.alias(name), F.inline(F.array(*entries))).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return rows.groupBy(name, "column").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("v").isNull()).alias("null_count"), F.sum("v").alias("total"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.hll_sketch_agg(F.when(F.col("v").isNotNull(), F.xxhash64("v")), HLL_BITS).alias("distinct_sketch"),
        F.kll_sketch_agg_double("v", KLL_K).alias("quantile_sketch"))


def update(df: DataFrame, partition: Column, columns: Sequence[str], path: str, name: str = "part") -> int:
    """Store the states of the partitions that ``path`` does not hold; returns how many were added.

    ``path`` is a folder that all executors share, partitioned by ``name``, so a
    partition that is written again replaces itself. Known partitions are left out
    by a filter on ``partition``, which prunes files if that is what they are
    partitioned by.
    """
    spark = df.sparkSession
    try:
        known = spark.read.parquet(path).select(F.col(name).cast("string").alias("known")).distinct()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None  # no states yet
    fresh = df
    if known is not None:  # a row a partition
        fresh = df.join(F.broadcast(known), partition.cast("string").eqNullSafe(F.col("known")), "left_anti")
    had = known.count() if known is not None else 0
    build(fresh, partition, columns, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)
    return spark.read.parquet(path).select(name).distinct().count() - had


def merged(states: DataFrame, quantiles: Sequence[float] = (), by: Sequence[str] = ()) -> DataFrame:
    """Metrics from states: ``column, row_count, null_count, mean, min, max,
    approx_distinct`` and, for each wanted quantile, ``qI`` (a value whose rank is
    within KLL's bound of the wanted one; null without values)."""
    one = states.groupBy(*by, "column").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("total").alias("total"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("distinct_sketch").alias("d"),
        F.kll_merge_agg_double("quantile_sketch").alias("q"))
    known = F.col("row_count") - F.col("null_count")
    value = lambda q: F.when(known > 0, F.kll_sketch_get_quantile_double("q", F.lit(float(q))))
    return one.select(*by, "column", "row_count", "null_count", F.try_divide("total", known).alias("mean"), "min", "max",
                      F.hll_sketch_estimate("d").alias("approx_distinct"), *[value(q).alias(f"q{i}") for i, q in enumerate(quantiles)])

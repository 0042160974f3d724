"""Sinks (SNK-1..8, APP-5 output, APP-8 samples).

Every write is a distributed Spark job. The annotated frame may carry joins
and subqueries, so when several outputs derive from it, it is materialised
once (a table in the shared checkpoint folder, which survives lost
executors) and the outputs are read from there.
"""

from __future__ import annotations

import warnings

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.operators.samples import FAILED_CHECK, slug
from rowguard.plans.annotate import is_valid
from rowguard.plans.results import split


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str | None = None) -> None:
    """SNK-1 (``mode='ignore'``: only when absent) / SNK-2 (overwrite)."""
    w = df.write.mode(mode)
    if fmt:
        w = w.format(fmt)
    w.saveAsTable(name)


def save_path(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).save(path)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The configured checkpoint folder; a remote session has only the setting."""
    try:
        return spark.sparkContext.getCheckpointDir()
    except PySparkException:
        return spark.conf.get("spark.checkpoint.dir", None)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder the cluster names in
    ``spark.checkpoint.dir`` (cuts lineage; a lost executor does not force
    re-running the joins). Without a configured folder the frame is
    returned as is (each output then re-evaluates it; results are the
    same) - a machine-local folder is never chosen here."""
    if not checkpoint_dir(df.sparkSession):
        warnings.warn("spark.checkpoint.dir is not set: outputs are computed without a checkpoint")
        return df
    return df.checkpoint(eager=True)


def save_split(
    annotated: DataFrame,
    output: str,
    quarantine: str,
    output_mode: str = "overwrite",
    quarantine_mode: str = "overwrite",
    as_tables: bool = True,
    checkpoint: bool = True,
) -> None:
    """SNK-3 / APP-5: write valid and quarantined rows, each with its own
    name and mode, from ONE evaluation of the annotated frame."""
    base = materialize(annotated) if checkpoint else annotated
    valid, bad = split(base)
    if as_tables:
        save_table(valid, output, output_mode)
        save_table(bad, quarantine, quarantine_mode)
    else:
        save_path(valid, output, output_mode)
        save_path(bad, quarantine, quarantine_mode)


STATUS = "_dq_status"


def save_partitioned_split(annotated: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """APP-5 in ONE pass: the annotated frame written once, partitioned by
    ``_dq_status`` = 'valid' | 'quarantine'. No checkpoint and no second
    evaluation; ``read_split`` gives the two sides back with partition
    pruning."""
    status = F.when(is_valid(), F.lit("valid")).otherwise(F.lit("quarantine"))
    annotated.withColumn(STATUS, status).write.mode(mode).format(fmt).partitionBy(STATUS).save(path)


def read_split(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of a ``save_partitioned_split`` output."""
    df = spark.read.format(fmt).load(path)
    return (df.where(F.col(STATUS) == "valid").drop(STATUS),
            df.where(F.col(STATUS) == "quarantine").drop(STATUS))


def serializable(df: DataFrame) -> DataFrame:
    """SNK-7: dates/timestamps to ISO text, decimals to double, nested values
    to JSON, so samples fit a text format."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            fmt = "yyyy-MM-dd" if isinstance(f.dataType, T.DateType) else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
            c = F.date_format(c, fmt)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_samples(samples: DataFrame, folder: str) -> None:
    """SNK-4 / SNK-5: one CSV folder per check (name slug), replacing old
    samples, all checks in one distributed job."""
    out = serializable(samples).withColumn("check_slug", slug(F.col(FAILED_CHECK)))
    out.write.mode("overwrite").partitionBy("check_slug").option("header", True).csv(folder)


def read_samples(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """SNK-6: samples read back as one frame (empty frame if none)."""
    try:
        r = spark.read.option("header", True)
        if schema is not None:
            r = r.schema(schema)
        return r.csv(folder)
    except Exception as err:  # missing folder: no samples
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return spark.createDataFrame([], T.StructType([T.StructField(FAILED_CHECK, T.StringType())]))
        raise


def show(df: DataFrame, n: int = 20) -> None:
    """SNK-8: console table."""
    df.show(n, truncate=False)

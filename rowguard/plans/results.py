"""What follows an annotated frame: split, summary, issue table, verdicts.

All functions take the annotated frame (``apply_checks``/``annotate``
output, or that frame read back from where it was written) and return
DataFrames; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.checks import Rule
from rowguard.plans.annotate import ERRORS, WARNINGS, has_errors, has_warnings, is_valid, summary_columns


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """APP-5 / FLT-1 / FLT-2: (valid, quarantine).

    Valid = no error and no warning; quarantine = any issue. The two are
    disjoint and together hold every input row (the published form used
    OR for the valid side, which put rows with an error but no warning in
    both outputs).
    """
    return (part(annotated.where(is_valid()), "valid"),
            part(annotated.where(has_errors() | has_warnings()), "quarantine"))


#: key of the errors column's metadata that names a part of a split frame
PART = "rowguard_part"


def part(df: DataFrame, name: str) -> DataFrame:
    """Say so in the frame's schema (and in files written from it) that rows were taken out."""
    return df.withMetadata(ERRORS, {PART: name})


def _whole(annotated: DataFrame) -> DataFrame:
    """The frame, unless it is a part of one: percentages of a part are not those of the input."""
    name = annotated.schema[ERRORS].metadata.get(PART)
    if name:
        raise ValueError(f"this is the {name} part of an annotated frame; verdicts and percentages are of the whole input")
    return annotated


def summary(annotated: DataFrame) -> DataFrame:
    """APP-6: one row of counts and percentages of input rows (0 % when
    there are no input rows)."""
    return _with_percent(_whole(annotated).agg(*summary_columns()))


def _with_percent(counts: DataFrame) -> DataFrame:
    total = F.col("input_row_count")

    def pct(c):
        return F.coalesce(F.try_divide(F.col(c) * F.lit(100.0), total), F.lit(0.0))

    return counts.select(
        "*",
        pct("valid_row_count").alias("valid_pct"),
        pct("error_row_count").alias("error_pct"),
        pct("warning_row_count").alias("warning_pct"),
    )


def issues(annotated: DataFrame, *keep: str) -> DataFrame:
    """APP-7 / PRJ-6 / PRJ-7 / SET-2: long table of issues, one row per
    (row, issue), with ``criticality``; optional input columns kept.

    One pass: both arrays are concatenated and exploded once with their
    positions; a position beyond the error array is a warning (rows
    without issues produce nothing).
    """
    n_errors = "__rg_n_errors"
    exploded = annotated.select(
        *keep, F.size(ERRORS).alias(n_errors),
        F.posexplode(F.concat(F.col(ERRORS), F.col(WARNINGS))).alias("__rg_pos", "__rg_issue"),
    )
    crit = F.when(F.col("__rg_pos") < F.col(n_errors), F.lit("error")).otherwise(F.lit("warning"))
    return exploded.select(*keep, F.col("__rg_issue.*"), crit.alias("criticality"))


def issue_counts(annotated: DataFrame) -> DataFrame:
    """AGG-2: rows per (issue name, criticality) - explode then a partial +
    final aggregate (a check failing on every row is one row per task in
    the shuffle)."""
    return issues(annotated).groupBy("name", "criticality").agg(F.count(F.lit(1)).alias("count"))


_RULES_SCHEMA = T.StructType([
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("criticality", T.StringType(), False),
    T.StructField("dimension", T.StringType(), False),
    T.StructField("function", T.StringType(), False),
    T.StructField("max_failed_pct", T.DoubleType(), False),
    T.StructField("strict", T.BooleanType(), False),
])


def rules_frame(spark, rules: Sequence[Rule]) -> DataFrame:
    """The rule list as a small local DataFrame (size bounded by the rules)."""
    rows = [
        (i, r.name, r.criticality, r.dimension, r.check.function, float(r.max_failed_pct), bool(r.strict))
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, _RULES_SCHEMA)


def check_results(
    annotated: DataFrame, rules: Sequence[Rule], thresholds: DataFrame | None = None,
    round_to: int = 4,
) -> DataFrame:
    """VRD-5 / VRD-6: one row per *rule* (also those with no failing row).

    For an annotated frame that is read back: ``failed_rows`` counted in one
    fused aggregate over the issue arrays (one pass, partial aggregation, one
    output row), then turned into one row per rule. The part of a split frame is
    refused. While the frame is being written, :func:`observed_results` gives the
    same without another pass. ``passed`` = failed_pct <= max_failed_pct (``<``
    when the rule is strict). An optional ``thresholds`` frame ``(name,
    max_failed_pct)`` overrides the rule's threshold (left join).
    """
    counts = [F.count(F.lit(1)).alias("row_count")]
    for i, r in enumerate(rules):
        arr = ERRORS if r.criticality == "error" else WARNINGS
        counts.append(F.count_if(F.array_contains(F.col(arr).getField("name"), r.name)).alias(f"c{i}"))
    per_rule = _whole(annotated).agg(*counts).select(
        "row_count",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("pos"), F.col(f"c{i}").alias("failed_rows")) for i in range(len(rules))
        ])).alias("r"),
    ).select("row_count", "r.pos", "r.failed_rows")
    return _verdicts(per_rule, rules, thresholds, round_to)


def observed_results(
    spark, metrics: Mapping[str, int], rules: Sequence[Rule], thresholds: DataFrame | None = None, round_to: int = 4,
) -> DataFrame:
    """VRD-5 / VRD-6 from what ``apply_checks`` observed: ``obs.get`` after the
    action that wrote the annotated frame. No job over the rows; the input's
    size is the observed one, so no later filter can change a percentage."""
    per_rule = spark.createDataFrame(
        [(metrics["input_row_count"], i, metrics[f"failed_{i}"]) for i in range(len(rules))], "row_count long, pos int, failed_rows long")
    return _verdicts(per_rule, rules, thresholds, round_to)


def observed_summary(spark, metrics: Mapping[str, int]) -> DataFrame:
    """APP-6 from what ``apply_checks`` observed."""
    names = ("input_row_count", "valid_row_count", "error_row_count", "warning_row_count")
    return _with_percent(spark.createDataFrame([tuple(metrics[n] for n in names)], ", ".join(f"{n} long" for n in names)))


def _verdicts(per_rule: DataFrame, rules: Sequence[Rule], thresholds: DataFrame | None, round_to: int) -> DataFrame:
    meta = rules_frame(per_rule.sparkSession, rules)
    out = per_rule.join(F.broadcast(meta), "pos")  # meta holds one row per rule
    if thresholds is not None:
        # one row per name (the strictest allowance if a name repeats)
        t = thresholds.groupBy("name").agg(F.min(F.col("max_failed_pct").cast("double")).alias("t_max"))
        out = out.join(t, "name", "left").withColumn(
            "max_failed_pct", F.coalesce(F.col("t_max"), F.col("max_failed_pct"))
        ).drop("t_max")
    pct = F.coalesce(F.try_divide(F.col("failed_rows") * F.lit(100.0), F.col("row_count")), F.lit(0.0))
    passed = F.when(F.col("strict"), pct < F.col("max_failed_pct")).otherwise(pct <= F.col("max_failed_pct"))
    return out.select(
        "pos", "name", "criticality", "dimension", "function",
        F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.round(pct, round_to).alias("failed_pct"),
        F.col("max_failed_pct"),
        passed.alias("passed"),
    )


def overall(results: DataFrame) -> DataFrame:
    """VRD-10: one row: number of failed checks and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        (F.count_if(~F.col("passed")) == 0).alias("passed"),
    )

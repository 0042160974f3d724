"""EXT-2/3/5/6: schema checks, cross-dataset row counts, profiles that
propose rules, and rules stored as rows.

Profiles are ONE fused aggregation over the frame (per column: rows,
nulls, distinct estimate, min, max, mean), unpivoted to one row per
column with ``stack``; only that per-column summary (bounded by the number
of columns) and at most ``max_values`` distinct values of low-cardinality
columns reach the driver when rules are proposed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard import checks as C
from rowguard.functions.predicates import col

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_ORDERED = _NUMERIC + (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """EXT-5: one row per column: ``column, type, row_count, null_count,
    distinct_count, min, max, mean`` (min/max as text, mean for numbers).

    ``distinct_count`` is ``approx_count_distinct`` (HyperLogLog, bounded
    state) unless ``exact_distinct``: then columns are unpivoted to (column,
    value) and counted in two levels, one scan and one shuffle for all of them.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if exact_distinct:
        return _exact_profile(df, fields)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        ordered = isinstance(f.dataType, _ORDERED)
        aggs.append((F.min(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"lo{i}"))
        aggs.append((F.max(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"hi{i}"))
        numeric = isinstance(f.dataType, _NUMERIC)
        aggs.append((F.avg(c).cast("double") if numeric else F.lit(None).cast("double")).alias(f"m{i}"))
    one = df.agg(*aggs)
    rows = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("__rows").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                 F.col(f"d{i}").cast("bigint").alias("distinct_count"), F.col(f"lo{i}").alias("min"),
                 F.col(f"hi{i}").alias("max"), F.col(f"m{i}").alias("mean"))
        for i, f in enumerate(fields)
    ]
    return one.select(F.inline(F.array(*rows)))


def _exact_profile(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The profile from (column, value, rows): values keep their types, one slot a type.

    A value that many rows share is one entry a task, so hot values are cheap.
    """
    slots = {t: f"v{k}" for k, t in enumerate(dict.fromkeys(f.dataType.simpleString() for f in fields))}
    kinds = {f.dataType.simpleString(): f.dataType for f in fields}
    entries = [
        F.struct(F.lit(i).alias("c"), col(f.name).isNotNull().alias("known"), *[
            (col(f.name) if t == f.dataType.simpleString() else F.lit(None).cast(kinds[t])).alias(v) for t, v in slots.items()])
        for i, f in enumerate(fields)]
    values = df.select(F.inline(F.array(*entries))).groupBy("c", "known", *slots.values()).agg(F.count(F.lit(1)).alias("n"))
    aggs, rows = [], []
    for i, f in enumerate(fields):
        t, own = f.dataType.simpleString(), F.col("c") == i
        v, known = F.col(slots[t]), own & F.col("known")
        total = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0)).cast("bigint")
        ordered, numeric = isinstance(f.dataType, _ORDERED), isinstance(f.dataType, _NUMERIC)
        aggs += [total(own, F.col("n")).alias(f"r{i}"), total(own & ~F.col("known"), F.col("n")).alias(f"n{i}"), F.count_if(known).alias(f"d{i}")]
        for name, pick in (("lo", F.min), ("hi", F.max)):
            aggs.append((pick(F.when(own, v)).cast("string") if ordered else F.lit(None).cast("string")).alias(f"{name}{i}"))
        weighed = F.sum(F.when(known, v.cast("double") * F.col("n"))) / F.nullif(total(known, F.col("n")), F.lit(0)) if numeric else F.lit(None).cast("double")
        aggs.append(weighed.alias(f"m{i}"))
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(t).alias("type"), F.col(f"r{i}").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                             F.col(f"d{i}").alias("distinct_count"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"m{i}").alias("mean")))
    return values.agg(*aggs).select(F.inline(F.array(*rows)))


def propose_rules(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = 20,
                  criticality: str = "warn") -> list[C.Rule]:
    """EXT-5: rules a profile suggests: not-null for columns without nulls,
    observed [min, max] for numbers, the value list for strings with at most
    ``max_values`` distinct values."""
    prof = {r.column: r for r in profile(df, columns).collect()}   # one row per column
    types = {f.name: f.dataType for f in df.schema.fields}
    rules: list[C.Rule] = []
    for name, p in prof.items():
        if p.row_count and p.null_count == 0:
            rules.append(C.Rule(f"{name}_not_null", C.NotNull(name), criticality, "completeness"))
        dt = types[name]
        if isinstance(dt, _NUMERIC) and p.min is not None:
            lo, hi = float(p.min), float(p.max)
            rules.append(C.Rule(f"{name}_in_range", C.InRange(name, lo, hi), criticality, "accuracy"))
        if isinstance(dt, T.StringType):
            # exact: distinct_count is an estimate
            values = [r[0] for r in df.select(col(name)).where(col(name).isNotNull()).distinct()
                      .orderBy(name).limit(max_values + 1).collect()]
            if 0 < len(values) <= max_values:
                rules.append(C.Rule(f"{name}_in_list", C.InList(name, values), criticality, "accuracy"))
    return rules


def schema_check(df: DataFrame, expected: Mapping[str, str] | T.StructType, allow_extra: bool = True) -> DataFrame:
    """EXT-2: one row per expected (or unexpected) column: ``column,
    expected_type, actual_type, outcome`` ('pass' | 'fail'). Names match
    case-insensitively, as Spark resolves them."""
    if isinstance(expected, T.StructType):
        expected = {f.name: f.dataType.simpleString() for f in expected.fields}
    actual = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in df.schema.fields}
    rows = []
    for name, typ in expected.items():
        got = actual.get(name.lower())
        want = T._parse_datatype_string(typ).simpleString() if isinstance(typ, str) else typ.simpleString()
        rows.append((name, want, got[1] if got else None, "pass" if got and got[1] == want else "fail"))
    if not allow_extra:
        wanted = {n.lower() for n in expected}
        rows += [(n, None, t, "fail") for k, (n, t) in actual.items() if k not in wanted]
    schema = "column string, expected_type string, actual_type string, outcome string"
    return df.sparkSession.createDataFrame(rows, schema)


def row_count_comparison(a: DataFrame, b: DataFrame, max_diff_pct: float = 0.0, name: str = "row_count_match") -> DataFrame:
    """EXT-3: one row comparing the row counts of two frames: ``check,
    rows_a, rows_b, diff_pct`` (of ``rows_a``) and ``outcome``. Each count is
    its own aggregate; ``b``'s enters as a scalar subquery (no join)."""
    rows_b = b.agg(F.count(F.lit(1))).scalar()
    one = a.agg(F.count(F.lit(1)).alias("rows_a")).select("rows_a", rows_b.alias("rows_b"))
    diff = F.coalesce(F.try_divide(F.abs(F.col("rows_a") - F.col("rows_b")) * F.lit(100.0), F.col("rows_a")),
                      F.when(F.col("rows_b") == 0, F.lit(0.0)).otherwise(F.lit(100.0)))
    return one.select(F.lit(name).alias("check"), "rows_a", "rows_b", diff.alias("diff_pct"),
                      F.when(diff <= F.lit(max_diff_pct), "pass").otherwise("fail").alias("outcome"))


# ------------------------------------------------------------- rules as rows

_ROW_CHECKS = {cls.function: cls for cls in (
    C.RegexMatch, C.InList, C.NotGreaterThan, C.NotLessThan, C.InRange, C.PairGreater, C.PairEqual,
    C.NotNull, C.NotNullNotEmpty, C.Fresh, C.Unique)}

RULES_SCHEMA = "name string, criticality string, dimension string, function string, params string, " \
               "max_failed_pct double, strict boolean"


def _jsonable(v):
    if isinstance(v, tuple):
        return [_jsonable(x) for x in v]
    if hasattr(v, "isoformat"):
        return {"datetime": v.isoformat()}
    return v


def rules_to_frame(spark: SparkSession, rules: Sequence[C.Rule]) -> DataFrame:
    """EXT-6: rules as a table (parameters as JSON), e.g. to store in a
    catalog. Checks holding DataFrames or Columns (foreign keys, column
    limits, aggregates, user conditions) are not storable."""
    import dataclasses
    rows = []
    for r in rules:
        if r.check.function not in _ROW_CHECKS:
            raise ValueError(f"check {r.check.function!r} of rule {r.name!r} cannot be stored as a row")
        params = {}
        for f in dataclasses.fields(r.check):
            v = getattr(r.check, f.name)
            if isinstance(v, (DataFrame,)) or type(v).__name__ == "Column":
                raise ValueError(f"rule {r.name!r}: parameter {f.name} is not storable")
            params[f.name] = _jsonable(v)
        rows.append((r.name, r.criticality, r.dimension, r.check.function, json.dumps(params),
                     float(r.max_failed_pct), bool(r.strict)))
    return spark.createDataFrame(rows, RULES_SCHEMA)


def rules_from_rows(rows) -> list[C.Rule]:
    """EXT-6: rebuild rules from rows of ``rules_to_frame`` (collected: one
    row per rule)."""
    import datetime as dt

    def back(v):
        if isinstance(v, dict) and "datetime" in v:
            return dt.datetime.fromisoformat(v["datetime"])
        if isinstance(v, list):
            return tuple(back(x) for x in v)
        return v

    out = []
    for r in rows:
        cls = _ROW_CHECKS[r["function"]]
        params = {k: back(v) for k, v in json.loads(r["params"]).items()}
        out.append(C.Rule(r["name"], cls(**params), r["criticality"], r["dimension"], r["max_failed_pct"], r["strict"]))
    return out

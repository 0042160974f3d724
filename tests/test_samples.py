"""Failed-row samples and their sinks (APP-8, DST-19, LIM-1/2, SNK-4..7)."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from rowguard.operators import metrics as M
from rowguard.operators.samples import FAILED_CHECK, samples
from rowguard.plans import scan as S
from rowguard.sources import writers as W

SCHEMA = "k bigint, s string, x double"
ROWS = [(i, "bad" if i % 2 else "ok", float(i)) for i in range(1, 21)]


def test_limits_order_and_union(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.createOrReplaceTempView("rg_sample_src")
    checks = [
        S.invalid_count("s invalid", "s", values=["ok"], samples_limit=2),
        S.row_count("big x", where="x > 15"),
        S.row_count("everything"),  # defines no failing rows
        S.duplicate_percent("dup s", ["s"]),
        M.MetricCheck("avg x", M.Aggregate("AVG(x)"), fail=M.when("<", 100),
                      failed_rows_query="SELECT * FROM rg_sample_src WHERE x < 4"),
    ]
    out = samples(df, checks, limit=3, order_by=["k"])
    got = {}
    for r in out.collect():
        got.setdefault(r.failed_check, []).append(r.k)
    assert got == {"s invalid": [1, 3], "big x": [16, 17, 18], "dup s": [1, 2, 3], "avg x": [1, 2, 3]}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_no_sample_definitions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert samples(df, [S.row_count("n")]) is None


def test_write_and_read_back(spark, scratch):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), decimal.Decimal("1.50"))],
        "k bigint, d date, t timestamp, m decimal(10,2)")
    s = df.select(F.lit("Invalid TailNum format").alias("failed_check"), "*")
    W.write_samples(s, f"{scratch}/samples")
    back = W.read_samples(spark, f"{scratch}/samples")
    row = back.first()
    assert row.check_slug == "invalid_tailnum_format"
    assert row.d == "2024-01-02" and row.t.startswith("2024-01-02T03:04:05") and float(row.m) == 1.5
    empty = W.read_samples(spark, f"{scratch}/nothing_here")
    assert empty.count() == 0


def test_unlimited_samples_are_plain_filters(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = samples(df, [S.row_count("big x", where="x > 15", samples_limit=2), S.row_count("all x", where="x > 0")],
                  limit=None, order_by=["k"])
    got = {}
    for r in out.collect():
        got.setdefault(r.failed_check, []).append(r.k)
    assert sorted(got["big x"]) == [16, 17] and len(got["all x"]) == 20
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window") == 2  # WindowGroupLimit + Window, for the limited check only


def test_wide_rows_are_fetched_after_ranking(spark):
    df = spark.range(0, 5000, 1, 8).selectExpr("id % 1000 AS k", "id", "repeat('x', 500) AS wide", "IF(id % 7 = 0, NULL, 1) AS v", "id AS c1", "id AS c2", "id AS c3")
    checks = [S.missing_count("v_missing", "v"), S.row_count("big", where="id >= 4990", samples_limit=2), S.row_count("all", where="id >= 0")]
    got = samples(df, checks, limit=4, order_by=["k"]).collect()
    per = {}
    for r in got:
        per.setdefault(r[FAILED_CHECK], []).append(r)
    assert {n: [r.k for r in rows] for n, rows in per.items()} == {"v_missing": [0, 1, 2, 3], "big": [990, 991], "all": [0, 0, 0, 0]}
    assert all(len(r.wide) == 500 and r.id % 1000 == r.k for r in got) and all(r.v is None for r in per["v_missing"])
    text = samples(df, checks, limit=4, order_by=["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text

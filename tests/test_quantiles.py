"""Bounded-memory exact quantiles equal Spark's exact percentiles."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowguard.operators import quantiles as Q
from rowguard.operators.quantiles import exact_quantiles, exact_quantiles_of

QS = [0.0, 0.1, 0.3, 0.55, 0.99, 1.0]


def spark_exact(df, q):
    r = df.select(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY x)").alias("d"),
                  F.percentile("x", F.lit(q)).alias("c")).first()
    return r.d, r.c


@pytest.mark.parametrize("shape", ["uniform", "skewed", "ties", "tiny"])
def test_equals_spark_exact_percentiles(spark, shape):
    base = spark.range(0, 5011 if shape != "tiny" else 3)
    x = {"uniform": F.rand(7) * 1000, "skewed": F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 1.5),
         "ties": (F.col("id") % 17).cast("double"), "tiny": F.col("id") * 2.0}[shape]
    df = base.select(x.alias("x")).union(spark.createDataFrame([(None,)], "x double"))
    # a coarse estimate forces several rounds
    rows, disc = exact_quantiles(df, "x", QS, "disc", accuracy=20)
    _, cont = exact_quantiles(df, "x", QS, "cont", accuracy=20)
    assert rows == df.count()
    for q, d, c in zip(QS, disc, cont):
        sd, sc = spark_exact(df, q)
        assert d == sd, (shape, q)
        assert c == pytest.approx(sc, rel=1e-12, abs=1e-9), (shape, q)


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == (2, [None])


def test_values_keep_their_type(spark):
    big = spark.createDataFrame([(2**53 + k,) for k in range(1, 6)], "x bigint")
    assert exact_quantiles(big, "x", [0.5, 1.0])[1] == [2**53 + 3, 2**53 + 5]
    dense = spark.range(3000).selectExpr("id + 9007199254740993 AS x")
    assert exact_quantiles(dense, "x", [0.1, 0.5], accuracy=20)[1] == [9007199254740993 + 299, 9007199254740993 + 1499]
    exact = spark.createDataFrame([(Decimal("12345678901234567890.12"),), (Decimal("12345678901234567890.13"),)], "x decimal(30,2)")
    assert exact_quantiles(exact, "x", [0.0, 1.0])[1] == [Decimal("12345678901234567890.12"), Decimal("12345678901234567890.13")]
    for kind in ("timestamp", "timestamp_ntz", "date"):
        times = spark.sql(f"SELECT CAST(TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS {kind}) AS x FROM range(101)")
        want = times.orderBy("x").collect()[50].x
        assert exact_quantiles(times, "x", [0.5])[1] == [want], kind


def test_nan_is_largest_and_jobs_do_not_grow_with_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("nan"),)], "x double")
    low, high = exact_quantiles(df, "x", [0.5, 1.0])[1]
    assert low == 2.0 and high != high
    tracker = spark.sparkContext.statusTracker()
    def jobs(qs):
        spark.sparkContext.setJobGroup(f"q{len(qs)}", "quantiles")
        exact_quantiles(spark.range(20000).selectExpr("id * 1.5D AS x"), "x", qs)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"q{len(qs)}"))
    assert jobs([0.1, 0.3, 0.5, 0.7, 0.9]) <= jobs([0.5]) + 4


def rounds(monkeypatch, work):
    """Aggregations that ``work`` runs."""
    seen = []
    kept = Q._round
    monkeypatch.setattr(Q, "_round", lambda *a: seen.append(1) or kept(*a))
    work()
    monkeypatch.undo()
    return len(seen)


def test_rounds_depend_on_the_types_width_only(spark, monkeypatch):
    near = spark.range(100_000).selectExpr("CAST(id AS DECIMAL(38,0)) + CAST('100000000000000000000' AS DECIMAL(38,0)) AS x")
    near = near.selectExpr("CAST(x AS DECIMAL(38,0)) AS x")
    spread = spark.range(2000).selectExpr("CAST(concat(id * 7919 % 1999, repeat('7', CAST(id % 34 AS INT))) AS DECIMAL(38,0)) * IF(id % 2 = 0, 1, -1) AS x")
    tiny = spark.range(3000).selectExpr("CAST(id AS DOUBLE) * 4.9E-324D AS x")
    wide = spark.range(3000).selectExpr("exp(id - 600D) * IF(id % 3 = 0, -1D, 1D) AS x")
    big = spark.range(3000).selectExpr("id * 3074457345618258L - 4611686018427387904L AS x")
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    for df, most in ((near, 13), (spread, 13), (tiny, 7), (wide, 7), (big, 7)):
        got = {}
        n = rounds(monkeypatch, lambda: got.update(v=exact_quantiles(df, "x", qs)[1]))  # noqa: B023
        ordered = [r.x for r in df.orderBy("x").collect()]
        assert n <= most
        assert got["v"] == [ordered[max(1, -(-len(ordered) * int(q * 10) // 10)) - 1] for q in qs]


def test_close_decimals_with_a_long_fraction(spark):
    base = Decimal("12345678.123456789012345678901234567890")
    rows = [(base + Decimal(k).scaleb(-30),) for k in range(60)]
    df = spark.createDataFrame(rows, "x decimal(38,30)")
    assert exact_quantiles(df, "x", [0.25, 0.5], accuracy=4)[1] == [rows[14][0], rows[29][0]]
    small = spark.createDataFrame([(Decimal(k).scaleb(-2),) for k in range(-50, 51)], "x decimal(9,2)")
    assert exact_quantiles(small, "x", [0.5], accuracy=3)[1] == [Decimal("0.00")]


def test_infinities_signed_zeros_and_other_types(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (-inf, -2.5, -0.0, 0.0, 1e-310, 3.0, inf)], "x double")
    assert exact_quantiles(df, "x", [k / 7 for k in range(1, 8)])[1] == [-inf, -2.5, 0.0, 0.0, 1e-310, 3.0, inf]
    truth = spark.createDataFrame([(True,), (False,), (True,), (None,)], "x boolean")
    assert exact_quantiles(truth, "x", [0.3, 0.5]) == (4, [False, True])
    ends = spark.createDataFrame([(-2**63,), (2**63 - 1,), (0,), (-1,), (1,)], "x bigint")
    assert exact_quantiles(ends, "x", [0.2, 0.4, 0.6, 0.8, 1.0], accuracy=2)[1] == [-2**63, -1, 0, 1, 2**63 - 1]
    with pytest.raises(ValueError):
        exact_quantiles(spark.createDataFrame([("a",)], "x string"), "x", [0.5])


def test_all_columns_and_checks_share_the_rounds(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id * 1.5D AS a", "CAST(id * 0.01 AS DECIMAL(12,2)) AS b", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS c", "id AS d")
    wanted = [("a", [0.5], "disc"), ("b", [0.1, 0.9], "disc"), ("a", [0.25], "cont"), ("c", [0.5], "disc"), ("d", [0.5], "cont")]
    got = {}
    n = rounds(monkeypatch, lambda: got.update(v=exact_quantiles_of(df, wanted)))
    assert got["v"][0] == 5000 and got["v"][1] == [exact_quantiles(df, c, q, m)[1] for c, q, m in wanted]
    assert n <= max(rounds(monkeypatch, lambda c=c, q=q, m=m: exact_quantiles(df, c, q, m)) for c, q, m in wanted) + 1
    assert exact_quantiles_of(df, []) == (5000, [])

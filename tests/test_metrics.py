"""Fused metrics, thresholds and outcomes (DST-2..18, VRD-1/2/4/7/9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowguard.operators import metrics as M
from rowguard.plans import expectations as E
from rowguard.plans import scan as S

SCHEMA = "k bigint, s string, x double, t timestamp_ntz"
ROWS = [(1, "a", 1.0, dt.datetime(2024, 1, 1)), (2, None, 2.0, dt.datetime(2024, 1, 2)),
        (2, "", float("nan"), None), (3, "zz", 10.0, dt.datetime(2024, 1, 3)), (4, "a", None, None)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def res(df, checks):
    return {r.check: r for r in M.evaluate(df, checks).collect()}


def test_missing_counts_and_warn_fail(df):
    r = res(df, [S.missing_count("mc", "s"),
                 S.missing_percent("mp", "s", fail=M.when(">", 50), warn=M.when(">", 10)),
                 S.missing_percent("mp2", "x", fail=M.when(">", 30), warn=M.when(">", 10))])
    assert r["mc"].value == 2 and r["mc"].outcome == "fail"
    assert r["mp"].value == 40.0 and r["mp"].outcome == "warn"
    assert r["mp2"].value == 40.0 and r["mp2"].outcome == "fail"   # NaN and NULL missing


def test_invalid_and_row_count(df):
    r = res(df, [S.invalid_count("re", "s", regex="^[a-z]$"), S.invalid_count("in", "s", values=["a"]),
                 S.row_count("rc", where="x > 1", fail=M.when(">", 5)), S.row_count("all")])
    assert r["re"].value == 2 and r["re"].considered_rows == 4     # '' and 'zz'
    assert r["in"].value == 2
    assert r["rc"].value == 3 and r["rc"].outcome == "pass"         # 2.0, NaN, 10.0
    assert r["all"].value == 5


def test_aggregate_and_null_value_fails(spark, df):
    empty = spark.createDataFrame([], SCHEMA)
    r = res(empty, [E.expect_mean_between("x", 0, 10, name="m")])
    assert r["m"].value is None and r["m"].outcome == "fail"
    r = res(df.where("x < 100"), [E.expect_mean_between("x", 0, 10, name="m")])
    assert r["m"].value == pytest.approx(13 / 3) and r["m"].outcome == "pass"


def test_min_between_text_bound_on_timestamp(df):
    r = res(df, [E.expect_min_between("t", "2023-12-31", name="a"), E.expect_min_between("t", "2024-01-02", name="b")])
    assert r["a"].outcome == "pass" and r["b"].outcome == "fail"
    assert r["a"].observed.startswith("2024-01-01")


def test_freshness_newest_row(df):
    r = res(df, [S.freshness("f", "t", dt.datetime(2024, 1, 4), 24 * 60),
                 S.freshness("g", "t", dt.datetime(2024, 1, 4, 1), 24 * 60)])
    assert r["f"].value == 1440.0 and r["f"].outcome == "fail"     # equal to the limit fails (< required)
    assert r["g"].outcome == "fail"


def test_duplicates_and_mostly(df):
    r = res(df, [S.duplicate_percent("d", ["k"]), E.expect_compound_unique(["k"], mostly=0.6, name="u"),
                 E.expect_compound_unique(["k"], mostly=0.7, name="v")])
    assert r["d"].value == 40.0 and r["d"].failed_rows == 2
    assert r["d"].details == "duplicate_groups=1, excess_rows=1"
    assert r["u"].outcome == "pass" and r["v"].outcome == "fail"   # 3/5 = 0.6


def test_reference_null_keys(spark, df):
    ref = spark.createDataFrame([(1,), (3,)], "k bigint")
    r = res(df, [S.reference("r", ["k"], ref, ["k"])])
    assert r["r"].value == 3 and r["r"].outcome == "fail"


def test_distinct_in_set(df):
    r = res(df, [E.expect_distinct_values_in_set("s", ["a"], name="d"),
                 E.expect_distinct_values_in_set("s", ["a", "", "zz"], name="e")])
    assert r["d"].value == 2 and r["d"].failed_rows == 2
    assert r["e"].value == 0 and r["e"].outcome == "pass"
    unexpected = M.DistinctInSet("s", ("a",)).unexpected(df).collect()
    assert sorted((v.value, v.row_count) for v in unexpected) == [("", 1), ("zz", 1)]


def test_quantiles_exact_and_approx(spark):
    data = spark.range(1, 1001).withColumn("v", F.col("id").cast("double"))
    r = res(data, [E.expect_quantiles_between("v", [0.5, 0.9], [[400, 600], [None, 850]], method="disc", name="q"),
                   S.quantile("a", "v", 0.9), M.MetricCheck("c", M.Quantiles("v", (0.9,), method="cont"))])
    assert r["q"].value == 500.0 and r["q"].outcome == "fail" and "q0.9=900.0" in r["q"].details
    assert abs(r["a"].value - 900.0) <= 1000 / 10000 + 1
    assert r["c"].value == pytest.approx(900.1)


def test_sql_metric_and_error_isolation(spark, df):
    df.createOrReplaceTempView("rg_m")
    r = res(df, [S.sql_metric("ok", "SELECT COUNT(*) * 10 FROM rg_m", fail=M.when("<", 60), warn=M.when("<", 100)),
                 S.sql_metric("bad", "SELECT nope FROM rg_missing_table"),
                 S.expression_metric("worse", "AVG(no_such_column)"),
                 S.row_count("fine")])
    assert r["ok"].value == 50 and r["ok"].outcome == "fail"
    assert r["bad"].outcome == "error" and "TABLE_OR_VIEW_NOT_FOUND" in r["bad"].details
    assert r["worse"].outcome == "error"
    assert r["fine"].value == 5


def test_outcome_counts_and_suite_statistics(df):
    out = M.evaluate(df, [S.row_count("a"), S.missing_count("b", "s"), S.sql_metric("c", "SELECT broken")])
    c = M.outcome_counts(out).first()
    assert (c.checks, c["pass"], c.fail, c.error) == (3, 1, 1, 1)
    v = E.validate(df, [E.expect_not_null("k", name="a"), E.expect_not_null("s", mostly=0.5, name="b"),
                        E.expect_not_null("x", name="c")])
    st = E.suite_statistics(v).first()
    assert (st.evaluated, st.successful, st.success) == (3, 2, False)
    assert E.failed_expectations(v).first().check == "c"


def test_threshold_validation():
    with pytest.raises(ValueError):
        M.Threshold("~", 1)
    with pytest.raises(ValueError):
        M.Threshold("between", 1)
    with pytest.raises(ValueError):
        M.evaluate(None, [S.row_count("a"), S.row_count("a")])


def test_evaluate_many(spark, df):
    res = M.evaluate_many({"a": df, "b": df.where("k < 3")}, [S.row_count("rows")])
    got = {r.dataset: r.value for r in res.collect()}
    assert got == {"a": 5.0, "b": 3.0}


@pytest.mark.parametrize("op,a,b,value,hit", [
    ("<", 5, None, 4, True), ("<", 5, None, 5, False), ("<=", 5, None, 5, True), (">", 5, None, 5, False),
    (">=", 5, None, 5, True), ("=", 5, None, 5, True), ("!=", 5, None, 5, False),
    ("between", 1, 5, 5, True), ("between", 1, 5, 6, False), ("not_between", 1, 5, 0, True),
    ("not_between", 1, 5, 1, False), ("null", None, None, None, True), ("null", None, None, 1, False),
])
def test_threshold_operators(spark, op, a, b, value, hit):
    t = M.Threshold(op, a, b)
    got = spark.createDataFrame([(None if value is None else float(value),)], "v double").select(t.hit(F.col("v")).alias("h")).first().h
    assert bool(got) == hit


def test_null_value_under_threshold_fails_and_warn_precedence(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    r = res(df, [M.MetricCheck("n", M.Aggregate("x", "max"), fail=M.when(">", 5), warn=M.when(">", 0)),
                 M.MetricCheck("m", M.Aggregate("x", "max"), fail=M.when(">", 0), warn=M.when(">", 0))])
    assert r["n"].outcome == "warn" and r["m"].outcome == "fail"
    empty = df.where("false")
    r = res(empty, [M.MetricCheck("e", M.Aggregate("x", "max"), warn=M.when(">", 0))])
    assert r["e"].outcome == "warn"   # NULL under a threshold counts as hit


def test_sql_metric_shape_errors_are_isolated(spark, df):
    df.createOrReplaceTempView("rg_m2")
    r = res(df, [S.sql_metric("text", "SELECT 'abc' FROM rg_m2 LIMIT 1"),
                 S.sql_metric("two", "SELECT 1, 2"), S.row_count("ok")])
    assert r["text"].outcome == "error" and "numeric" in r["text"].details
    assert r["two"].outcome == "error" and r["ok"].value == 5


def test_runtime_errors_isolated(spark, df):
    from pyspark.errors import PySparkException
    checks = [S.expression_metric("boom", "AVG(x / (k - k))"), S.row_count("rows")]
    try:
        M.evaluate(df, checks).collect()
        ansi_raises = False
    except PySparkException:
        ansi_raises = True
    r = {x.check: x for x in M.evaluate_isolated(df, checks).collect()}
    assert r["rows"].value == 5
    if ansi_raises:
        assert r["boom"].outcome == "error"


def test_error_rows_keep_the_whole_text(spark):
    from rowguard.operators import metrics as M
    text = "first line\n" + "x" * 1000 + "\nlast line"
    check = type("Check", (), {"name": "c", "dimension": "d", "measure": type("Measure", (), {"metric": "m"})})
    assert M._error_frame(spark, check, ValueError(text)).first().details == text
    assert M._error_frame(spark, check, ValueError()).first().details == "ValueError"


def evaluations(monkeypatch, work):
    seen = []
    kept = M.evaluate
    monkeypatch.setattr(M, "evaluate", lambda df, checks, *a: seen.append(len(checks)) or kept(df, checks, *a))
    out = work()
    monkeypatch.undo()
    return out, len(seen)


def test_failing_checks_are_found_by_halving(spark, df, monkeypatch):
    good = [S.row_count(f"rows{i}") for i in range(15)]
    for at in (0, 6, 15):
        checks = good[:at] + [S.expression_metric("boom", "SUM(k / (k - k))")] + good[at:]
        got, n = evaluations(monkeypatch, lambda: M.evaluate_isolated(df, checks).collect())  # noqa: B023
        outcomes = {r.check: r.outcome for r in got}
        assert outcomes.pop("boom") == "error" and set(outcomes.values()) == {"pass"} and len(got) == 16
        assert n <= 2 * 4 + 1
    got, n = evaluations(monkeypatch, lambda: M.evaluate_isolated(df, good).collect())
    assert n == 1 and len(got) == 15
    assert M.evaluate_isolated(df, []).count() == 0


def test_scan_isolates_run_time_errors_by_default(spark, df):
    r = {x.check: x for x in S.scan({"rg_iso": df}, "rg_iso", [
        S.expression_metric("boom", "SUM(k / (k - k))"), S.missing_count("nowhere", "no_such"), S.row_count("rows")]).results.collect()}
    assert r["boom"].outcome == "error" and "DIVIDE_BY_ZERO" in r["boom"].details
    assert r["nowhere"].outcome == "error" and r["rows"].value == 5


def test_checks_with_a_plan_stay_fused_beside_one_without(spark, df):
    out = M.evaluate(df, [S.missing_count("nowhere", "no_such"), S.row_count("a"), S.row_count("b"), S.missing_count("c", "k")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and out.count() == 4


def test_a_lost_cluster_is_no_checks_error(spark, df, monkeypatch):
    import pytest
    from pyspark.errors import PySparkException

    class Lost(PySparkException):
        def getSqlState(self):
            return "58030"

    assert not M.is_data_error(Lost("executor lost")) and not M.is_data_error(PySparkException("no state"))
    assert not M.is_data_error(RuntimeError("x")) and M.is_data_error(ValueError("x"))
    monkeypatch.setattr(M, "evaluate", lambda *a: (_ for _ in ()).throw(Lost("executor lost")))
    with pytest.raises(Lost):
        M.evaluate_isolated(df, [S.row_count("rows")])


def test_exact_quantiles_of_a_suite_share_their_rounds(spark, df, monkeypatch):
    calls = []
    kept = M.exact_quantiles_of
    monkeypatch.setattr(M, "exact_quantiles_of", lambda d, wanted: calls.append(len(wanted)) or kept(d, wanted))
    checks = [M.MetricCheck(f"q{i}", M.Quantiles(c, (0.5,), method="disc")) for i, c in enumerate(("k", "x"))]
    assert {r.check: r.outcome for r in M.evaluate(df, checks).collect()} == {"q0": "pass", "q1": "pass"} and calls == [2]
    bad = [*checks, M.MetricCheck("qs", M.Quantiles("no_such", (0.5,), method="disc"))]
    assert {r.check: r.outcome for r in M.evaluate(df, bad).collect()} == {"q0": "pass", "q1": "pass", "qs": "error"}

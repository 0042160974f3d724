"""EXT-2/3/5/6: schema checks, row-count comparison, profiles, rules as rows."""

import datetime as dt

import rowguard as rg
from rowguard.plans import profiling as Pf

SCHEMA = "k bigint, s string, x double, d date"
ROWS = [(1, "a", 1.5, dt.date(2024, 1, 1)), (2, "b", None, dt.date(2024, 1, 2)), (3, "a", 3.5, None)]


def test_profile_and_proposed_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    p = {r.column: r for r in Pf.profile(df, exact_distinct=True).collect()}
    assert (p["k"].row_count, p["k"].null_count, p["k"].distinct_count, p["k"].min, p["k"].max) == (3, 0, 3, "1", "3")
    assert p["x"].null_count == 1 and p["x"].mean == 2.5 and p["d"].max == "2024-01-02"
    rules = {r.name: r for r in Pf.propose_rules(df)}
    assert {"k_not_null", "s_not_null", "k_in_range", "x_in_range", "s_in_list"} <= set(rules)
    assert rules["s_in_list"].check.allowed == ("a", "b")
    ann = rg.annotate(df, list(rules.values()))
    assert ann.where("size(_warnings) > 0").count() == 0   # the data satisfies its own profile


def test_schema_check(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    res = {r.column: r.outcome for r in Pf.schema_check(df, {"K": "bigint", "s": "int", "zz": "string"}).collect()}
    assert res == {"K": "pass", "s": "fail", "zz": "fail"}
    strict = Pf.schema_check(df, {"k": "bigint"}, allow_extra=False)
    assert strict.where("outcome = 'fail'").count() == 3


def test_row_count_comparison(spark):
    a, b = spark.range(100), spark.range(98)
    r = Pf.row_count_comparison(a, b, max_diff_pct=2.0).first()
    assert (r.rows_a, r.rows_b, r.diff_pct, r.outcome) == (100, 98, 2.0, "pass")
    assert Pf.row_count_comparison(a, b, max_diff_pct=1.0).first().outcome == "fail"


def test_rules_round_trip(spark):
    rules = [rg.Rule("re", rg.RegexMatch("s", "^[a-z]$"), "warn", "accuracy", 5.0, True),
             rg.Rule("fresh", rg.Fresh("d", 60, as_of=dt.datetime(2024, 1, 3))),
             rg.Rule("u", rg.Unique(["k", "s"])), rg.Rule("list", rg.InList("s", ["a", "b"]))]
    frame = Pf.rules_to_frame(spark, rules)
    back = Pf.rules_from_rows([r.asDict() for r in frame.collect()])
    assert [(r.name, r.criticality, r.dimension, r.max_failed_pct, r.strict) for r in back] == \
        [(r.name, r.criticality, r.dimension, r.max_failed_pct, r.strict) for r in rules]
    assert back[1].check.as_of == dt.datetime(2024, 1, 3) and back[2].check.columns == ("k", "s")
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = rg.annotate(df, rules).select("_errors", "_warnings").collect()
    b = rg.annotate(df, back).select("_errors", "_warnings").collect()
    assert a == b


def test_value_lists_are_decided_by_exact_distinct_counts(spark):
    """400 values a column: an estimate of some of the columns is above 400."""
    columns = [f"concat('{c}', id % 400) AS s{c}" for c in "abcdefgh"]
    rules = {r.name: r for r in Pf.propose_rules(spark.range(800).selectExpr(*columns, "cast(null as string) AS none"), max_values=400)}
    assert all(len(rules[f"s{c}_in_list"].check.allowed) == 400 for c in "abcdefgh") and "none_in_list" not in rules
    over = Pf.propose_rules(spark.range(800).selectExpr(*columns), max_values=399)
    assert not any(r.name.endswith("_in_list") for r in over)


def test_exact_profile_counts_in_two_levels(spark):
    df = spark.createDataFrame([(1, "a", 1.5, dt.date(2024, 1, 1), [1]), (1, None, None, None, [1]), (4, "", 2.5, None, None)], SCHEMA + ", e array<int>")
    p = {r.column: r for r in Pf.profile(df, exact_distinct=True).collect()}
    assert [(c, p[c].row_count, p[c].null_count, p[c].distinct_count) for c in "ksxde"] == [
        ("k", 3, 0, 2), ("s", 3, 1, 2), ("x", 3, 1, 2), ("d", 3, 2, 1), ("e", 3, 1, 1)]
    assert (p["k"].mean, p["x"].mean, p["s"].min, p["s"].max, p["e"].min, p["d"].mean) == (2.0, 2.0, "", "a", None, None)
    none = Pf.profile(df.limit(0), exact_distinct=True).collect()
    assert len(none) == 5 and all(r.row_count == r.distinct_count == 0 and r.mean is None for r in none)
    plan = Pf.profile(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), exact_distinct=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Expand" not in plan

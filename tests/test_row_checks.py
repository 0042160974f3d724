"""ROW-1..9 on small in-line frames: nulls, NaN, empty strings, boundaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import rowguard as rg
from rowguard.plans.annotate import issue_names

SCHEMA = "k bigint, s string, x double, y double, d date, t timestamp_ntz"
ROWS = [
    (1, "N123", 1.0, 1.0, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0)),
    (2, "BAD", 2.0, 1.0, dt.date(2023, 1, 1), dt.datetime(2023, 6, 1, 0, 0)),
    (3, None, None, 5.0, None, None),
    (4, "", float("nan"), None, dt.date(2024, 1, 31), dt.datetime(2024, 1, 30, 0, 0)),
    (5, "  ", 60.0, 60.0, dt.date(2024, 2, 1), dt.datetime(2024, 1, 31, 0, 0)),
    (6, "N1\n", 61.0, 0.0, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0)),
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def failing(frame, check, crit="error"):
    ann = rg.annotate(frame, [rg.Rule("r", check, criticality=crit)])
    arr = "_errors" if crit == "error" else "_warnings"
    return sorted(r.k for r in ann.where(F.size(arr) > 0).select("k").collect())


def test_regex_nulls_pass_and_find_semantics(frame):
    # null passes; '' and '  ' do not match; 'N1\n' matches '^N\d+$' in Java ('$' before final newline)
    assert failing(frame, rg.RegexMatch("s", r"^N\d+$")) == [2, 4, 5]


def test_regex_strict_end(frame):
    assert failing(frame, rg.RegexMatch("s", r"^N\d+\z")) == [2, 4, 5, 6]


def test_in_list(frame):
    assert failing(frame, rg.InList("s", ["N123", ""])) == [2, 5, 6]
    with pytest.raises(ValueError):
        rg.InList("s", ["a", None])


def test_not_greater_than_constant_equal_passes(frame):
    # 60 passes (equal); NaN orders above every number in Spark, as in DuckDB
    assert failing(frame, rg.NotGreaterThan("x", 60)) == [4, 6]


def test_not_greater_than_column(frame):
    # x > y fails; NaN > anything is true in Spark (NaN is the largest double)
    assert failing(frame, rg.NotGreaterThan("x", F.col("y"))) == [2, 6]


def test_not_less_than_and_range(frame):
    assert failing(frame, rg.NotLessThan("y", 1.0)) == [6]
    assert failing(frame, rg.InRange("y", 1.0, 5.0)) == [5, 6]


def test_pair_greater_strict_and_or_equal(frame):
    assert failing(frame, rg.PairGreater("x", "y")) == [1, 5]
    assert failing(frame, rg.PairGreater("x", "y", or_equal=True)) == []


def test_pair_equal_null_safe(frame):
    # one null side fails (3: x null, 4: y null); NaN = NaN is true in Spark
    assert failing(frame, rg.PairEqual("x", "y")) == [2, 3, 4, 6]


def test_not_null_and_missing(frame):
    assert failing(frame, rg.NotNull("s")) == [3]
    assert failing(frame, rg.NotNullNotEmpty("s")) == [3, 4]
    assert failing(frame, rg.NotNullNotEmpty("s", trim_strings=True)) == [3, 4, 5]
    assert failing(frame, rg.NotNullNotEmpty("x")) == [3, 4]  # NaN is missing
    assert failing(frame, rg.NotNullNotEmpty("d")) == [3]


def test_fresh_boundary(frame):
    # as_of 2024-01-31, 1 day: limit 2024-01-30 00:00 exactly -> equal passes
    rule = rg.Fresh("t", 24 * 60, as_of=dt.datetime(2024, 1, 31))
    assert failing(frame, rule) == [1, 2, 6]


def test_satisfies_sql_column_and_function(frame):
    assert failing(frame, rg.Satisfies("x > 50")) == [4, 5, 6]
    assert failing(frame, rg.Satisfies(F.col("k") == 1)) == [1]
    assert failing(frame, rg.Satisfies(lambda df: df["k"] >= 5)) == [5, 6]


def test_warn_goes_to_warnings(frame):
    assert failing(frame, rg.NotNull("s"), crit="warn") == [3]


def test_arrays_never_null_and_ordered(frame):
    rules = [rg.Rule("a", rg.NotNull("x")), rg.Rule("b", rg.NotNull("y")), rg.Rule("c", rg.NotNull("s"))]
    ann = rg.annotate(frame, rules)
    rows = {r.k: r.n for r in ann.select("k", issue_names().alias("n")).collect()}
    assert rows[1] == [] and rows[3] == ["a", "c"] and rows[4] == ["b"]
    assert ann.where(F.col("_errors").isNull() | F.col("_warnings").isNull()).count() == 0


def test_no_rules_and_empty_frame(spark, frame):
    ann = rg.annotate(frame, [])
    assert ann.where(F.size("_errors") > 0).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert rg.annotate(empty, [rg.Rule("r", rg.NotNull("s"))]).count() == 0


def test_issue_struct_fields(frame):
    ann = rg.annotate(frame, [rg.Rule("tail", rg.RegexMatch("s", r"^N\d+$"))], messages="values")
    e = ann.where("k = 2").select(F.col("_errors")[0].alias("e")).first().e
    assert e.name == "tail" and e.function == "regex_match" and e.columns == ["s"]
    assert "BAD" in e.message
    static = rg.annotate(frame, [rg.Rule("tail", rg.RegexMatch("s", r"^N\d+$"))])
    m = static.where("k = 2").select(F.col("_errors")[0]["message"].alias("m")).first().m
    assert m.startswith("regex_match failed:") and "regex=" in m and "BAD" not in m


def test_case_insensitive_column_names(frame):
    assert failing(frame, rg.NotNull("S")) == [3]


def test_duplicate_rule_names_rejected():
    with pytest.raises(ValueError):
        rg.suite([rg.Rule("a", rg.NotNull("x")), rg.Rule("a", rg.NotNull("y"))])
    with pytest.raises(ValueError):
        rg.Rule("a", rg.NotNull("x"), criticality="fatal")


def test_annotating_twice_appends_issues(frame):
    first = rg.annotate(frame, [rg.Rule("a", rg.NotNull("s"))])
    second = rg.annotate(first, [rg.Rule("b", rg.NotNull("x")), rg.Rule("w", rg.NotNull("y"), criticality="warn")])
    assert second.columns.count("_errors") == 1
    rows = {r.k: (r.e, r.w) for r in second.select("k", issue_names().alias("e"), issue_names("_warnings").alias("w")).collect()}
    assert rows[3] == (["a", "b"], []) and rows[4] == ([], ["w"])  # NaN is not NULL


def test_rules_without_a_name_are_called_after_their_check(spark):
    import pytest
    rules = rg.suite(rg.Rule(None, rg.NotNull("k")), rg.Rule(None, rg.NotGreaterThan("k", 1)), rg.Rule(None, rg.Unique(["k", "s"])))
    assert [r.name for r in rules] == ["k_is_not_null", "k_is_not_greater_than", "k_s_is_unique"]
    df = spark.createDataFrame([(2, "a"), (None, "b")], "k int, s string")
    assert {r.name: r.failed_rows for r in rg.check_results(rg.annotate(df, rules), rules).collect()} == {
        "k_is_not_null": 1, "k_is_not_greater_than": 1, "k_s_is_unique": 0}
    with pytest.raises(ValueError):
        rg.Rule("", rg.NotNull("k"))
    with pytest.raises(ValueError, match="unique"):
        rg.suite(rg.Rule(None, rg.NotNull("k")), rg.Rule(None, rg.NotNull("k")))

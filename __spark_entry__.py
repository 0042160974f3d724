"""

``entry(spark)`` runs the flagship query (per-rule verdicts of the
twelve-rule lineitem suite) on sf0.001; ``queries()`` maps every covered
operator to a ``(spark, sf_dir) -> DataFrame`` callable (all in
``rowguard.requirements``); ``oracle_sql()`` gives the DuckDB equivalent
of each, written by hand against the same parquet tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowguard import requirements as Q  # noqa: E402

try:  # the training-data operators are optional: the library works without them
    import corpus_pipeline
    from rowguard.llm import queries as L
except ImportError:  # absent, or one of its dependencies is
    corpus_pipeline = L = None

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-rule results of the lineitem suite on sf0.001."""
    return Q.check_results(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = {} if L is None else {**L.QUERIES, "pipeline": corpus_pipeline.run}
    return {**Q.QUERIES, **extra}


# --------------------------------------------------------------- oracle SQL

KEYS = "l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber"
SHIP_LIMIT = "TIMESTAMP '2001-12-31 00:00:00' - INTERVAL 3153600 MINUTE"
UNIT_PRICE = "l_extendedprice / NULLIF(l_quantity, 0)"

# (name, criticality, dimension, function, failing condition, max_failed_pct, strict)
LINEITEM_RULES = [
    ("linestatus_format", "error", "accuracy", "regex_match",
     "l.l_linestatus IS NOT NULL AND NOT regexp_matches(l.l_linestatus, '^[OF]$')", 0, False),
    ("returnflag_valid", "error", "accuracy", "is_in_list",
     "l.l_returnflag IS NOT NULL AND l.l_returnflag NOT IN ('A', 'N')", 40, True),
    ("tax_not_above_discount", "warn", "accuracy", "is_not_greater_than", "l.l_tax > l.l_discount", 0, False),
    ("shipdate_missing", "warn", "completeness", "is_not_null_and_not_empty", "l.l_shipdate IS NULL", 0, False),
    ("returnflag_missing", "warn", "completeness", "is_not_null_and_not_empty",
     "l.l_returnflag IS NULL OR l.l_returnflag = ''", 0, False),
    ("orderkey_missing", "warn", "completeness", "is_not_null", "l.l_orderkey IS NULL", 0, False),
    ("supplier_active", "error", "consistency", "foreign_key",
     "l.l_suppkey IS NOT NULL AND sup.s_suppkey IS NULL", 10, False),
    ("shipdate_recent", "error", "currentness", "is_data_fresh", f"l.l_shipdate < {SHIP_LIMIT}", 20, False),
    ("unit_price_avg_min", "error", "reasonableness", "is_aggr_bound", "agg.up < 1000", 0, False),
    ("unit_price_avg_max", "error", "reasonableness", "is_aggr_bound", "agg.up > 5000", 0, False),
    ("quantity_limit", "error", "reasonableness", "is_not_greater_than", "l.l_quantity > 45", 10, False),
    ("line_unique", "error", "uniqueness", "is_unique", "dup.k0 IS NOT NULL", 10, True),
]

LINEITEM_FLAGS = (
    "WITH sup AS (SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal > 0 AND s_suppkey IS NOT NULL), "
    "dup AS (SELECT l_orderkey AS k0, l_linenumber AS k1 FROM lineitem "
    "  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1), "
    f"agg AS (SELECT AVG({UNIT_PRICE}) AS up FROM lineitem), "
    f"f AS (SELECT {KEYS}, "
    + ", ".join(f"COALESCE(({r[4]}), FALSE) AS c{i}" for i, r in enumerate(LINEITEM_RULES))
    + " FROM lineitem l LEFT JOIN sup ON l.l_suppkey = sup.s_suppkey "
    "LEFT JOIN dup ON l.l_orderkey = dup.k0 AND l.l_linenumber = dup.k1 CROSS JOIN agg) "
)


def _names(crit: str) -> str:
    parts = [f"CASE WHEN c{i} THEN '{r[0]}' END" for i, r in enumerate(LINEITEM_RULES) if r[1] == crit]
    return f"concat_ws(';', {', '.join(parts)})"


def _any(crit: str | None = None) -> str:
    return "(" + " OR ".join(f"c{i}" for i, r in enumerate(LINEITEM_RULES) if crit in (None, r[1])) + ")"


def _count(crit: str) -> str:
    return "(" + " + ".join(f"CAST(c{i} AS INTEGER)" for i, r in enumerate(LINEITEM_RULES) if r[1] == crit) + ")"


def _pct(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) * 100.0 / NULLIF({den}, 0)"


CHECK_RESULTS = LINEITEM_FLAGS + " UNION ALL ".join(
    f"SELECT {i} AS pos, '{r[0]}' AS name, '{r[1]}' AS criticality, '{r[2]}' AS dimension, "
    f"'{r[3]}' AS function, COUNT(*) FILTER (WHERE c{i}) AS failed_rows, COUNT(*) AS row_count, "
    f"ROUND(COALESCE({_pct(f'COUNT(*) FILTER (WHERE c{i})', 'COUNT(*)')}, 0.0), 4) AS failed_pct, "
    f"CAST({r[5]} AS DOUBLE) AS max_failed_pct, "
    f"COALESCE({_pct(f'COUNT(*) FILTER (WHERE c{i})', 'COUNT(*)')}, 0.0) {'<' if r[6] else '<='} {r[5]} AS passed "
    "FROM f"
    for i, r in enumerate(LINEITEM_RULES)
)


def _metric(check, metric, value, rows, considered, failed, outcome, src):
    """One metric result row: value/failed_pct rounded to 4 places."""
    return (
        f"SELECT '{check}' AS \"check\", '{metric}' AS metric, ROUND(CAST({value} AS DOUBLE), 4) AS value, "
        f"CAST({rows} AS BIGINT) AS row_count, CAST({considered} AS BIGINT) AS considered_rows, "
        f"CAST({failed} AS BIGINT) AS failed_rows, ROUND({_pct(failed, rows)}, 4) AS failed_pct, "
        f"{outcome} AS outcome FROM {src}"
    )


def _outcome(fail: str | None, warn: str | None = None) -> str:
    out = "CASE "
    if fail:
        out += f"WHEN COALESCE({fail}, TRUE) THEN 'fail' "
    if warn:
        out += f"WHEN COALESCE({warn}, TRUE) THEN 'warn' "
    return out + "ELSE 'pass' END"


DOCS_LABELS = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
ACTIVE = "(SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal > 0 AND s_suppkey IS NOT NULL)"


def _dups(table, cols, alias):
    keyed = ", ".join(cols)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (
        f"(SELECT CAST(SUM(n) AS BIGINT) AS rows_, CAST(SUM(n) FILTER (WHERE {complete}) AS BIGINT) AS considered, "
        f"COUNT(*) FILTER (WHERE {complete} AND n > 1) AS groups_, "
        f"CAST(COALESCE(SUM(n) FILTER (WHERE {complete} AND n > 1), 0) AS BIGINT) AS dup_rows, "
        f"CAST(COALESCE(SUM(n - 1) FILTER (WHERE {complete} AND n > 1), 0) AS BIGINT) AS excess "
        f"FROM (SELECT {keyed}, COUNT(*) AS n FROM {table} GROUP BY {keyed})) {alias}"
    )


def _dup_details(a):
    return f"'duplicate_groups=' || CAST({a}.groups_ AS VARCHAR) || ', excess_rows=' || CAST({a}.excess AS VARCHAR)"


SCAN_SRC = (
    "(SELECT COUNT(*) AS n, "
    "COUNT(l_linestatus) AS nn_ls, COUNT(*) FILTER (WHERE l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^[OF]$')) AS bad_ls, "
    "COUNT(l_returnflag) AS nn_rf, COUNT(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')) AS bad_rf, "
    "COUNT(*) FILTER (WHERE l_tax > l_discount) AS tax_hi, "
    "COUNT(*) FILTER (WHERE l_shipdate IS NULL) AS miss_sd, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS miss_ok, "
    "COUNT(*) FILTER (WHERE l_returnflag IS NULL OR l_returnflag = '') AS miss_rf, "
    "MAX(l_shipdate) AS newest, AVG(l_extendedprice / l_quantity) AS avg_up, "
    "quantile_disc(l_quantity, 0.9) AS q90 FROM lineitem) s"
)
SCAN_REF = (
    f"(SELECT COUNT(*) AS n, COUNT(l.l_suppkey) AS considered, COUNT(a.s_suppkey) AS matched, "
    f"COUNT(*) FILTER (WHERE l.l_suppkey IS NOT NULL AND a.s_suppkey IS NULL) AS unmatched "
    f"FROM lineitem l LEFT JOIN {ACTIVE} a ON l.l_suppkey = a.s_suppkey) r"
)
SCAN_RESULTS = " UNION ALL ".join([
    _metric("linestatus_invalid", "invalid_count", "s.bad_ls", "s.n", "s.nn_ls", "s.bad_ls", _outcome("s.bad_ls != 0"), SCAN_SRC),
    _metric("returnflag_invalid", "invalid_count", "s.bad_rf", "s.n", "s.nn_rf", "s.bad_rf", _outcome("s.bad_rf != 0"), SCAN_SRC),
    _metric("tax_above_discount", "row_count", "s.tax_hi", "s.n", "s.n", "s.tax_hi", _outcome("s.tax_hi > 30000"), SCAN_SRC),
    _metric("shipdate_missing", "missing_count", "s.miss_sd", "s.n", "s.n", "s.miss_sd", _outcome("s.miss_sd != 0"), SCAN_SRC),
    _metric("orderkey_missing", "missing_count", "s.miss_ok", "s.n", "s.n", "s.miss_ok", _outcome("s.miss_ok != 0"), SCAN_SRC),
    _metric("returnflag_missing_pct", "missing_percent", f"COALESCE({_pct('s.miss_rf', 's.n')}, 0.0)", "s.n", "s.n",
            "s.miss_rf", _outcome(f"COALESCE({_pct('s.miss_rf', 's.n')}, 0.0) > 5", f"COALESCE({_pct('s.miss_rf', 's.n')}, 0.0) > 0.5"), SCAN_SRC),
    _metric("supplier_exists", "reference_unmatched", "r.unmatched", "r.n", "r.considered", "r.unmatched",
            _outcome("r.unmatched != 0"), SCAN_REF),
    _metric("supplier_active_pct", "sql_query", "CAST(r.matched AS DOUBLE) / r.n * 100", "NULL", "NULL", "NULL",
            _outcome("CAST(r.matched AS DOUBLE) / r.n * 100 < 80", "CAST(r.matched AS DOUBLE) / r.n * 100 < 95"), SCAN_REF),
    _metric("shipdate_fresh", "freshness_minutes",
            "(epoch_us(TIMESTAMP '2001-12-31 00:00:00') - epoch_us(s.newest)) / 60000000.0", "s.n", "s.n", "NULL",
            _outcome("(epoch_us(TIMESTAMP '2001-12-31 00:00:00') - epoch_us(s.newest)) / 60000000.0 >= 3153600"), SCAN_SRC),
    _metric("unit_price_avg", "avg_unit_price", "s.avg_up", "s.n", "s.n", "NULL",
            _outcome("s.avg_up < 1000 OR s.avg_up > 4000"), SCAN_SRC),
    _metric("quantity_p90", "expression", "s.q90", "s.n", "s.n", "NULL", _outcome("s.q90 >= 44"), SCAN_SRC),
    _metric("line_duplicates", "duplicate_percent", "COALESCE(CAST(d.dup_rows AS DOUBLE) * 100.0 / d.rows_, 0.0)",
            "d.rows_", "d.considered", "d.dup_rows", _outcome("CAST(d.dup_rows AS DOUBLE) * 100.0 / d.rows_ >= 10"),
            _dups("lineitem", ["l_orderkey", "l_linenumber"], "d")),
])

SAMPLE_ORDER = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def _sample(name, where, n=3):
    return (f"SELECT '{name}' AS failed_check, * FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber "
            f"FROM lineitem l WHERE {where} ORDER BY {SAMPLE_ORDER} LIMIT {n})")


FAILED_ROWS = " UNION ALL ".join([
    _sample("linestatus_invalid", "l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^[OF]$')", 2),
    _sample("returnflag_invalid", "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')"),
    _sample("tax_above_discount", "l_tax > l_discount"),
    _sample("shipdate_missing", "l_shipdate IS NULL"),
    _sample("orderkey_missing", "l_orderkey IS NULL"),
    _sample("returnflag_missing_pct", "l_returnflag IS NULL OR l_returnflag = ''"),
    _sample("supplier_exists", f"l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM {ACTIVE})"),
    _sample("supplier_active_pct", f"NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_acctbal > 0 AND s.s_suppkey = l.l_suppkey)"),
    _sample("unit_price_avg", "l_extendedprice / l_quantity > 4000"),
    _sample("line_duplicates", "EXISTS (SELECT 1 FROM (SELECT l_orderkey AS k0, l_linenumber AS k1 FROM lineitem "
            "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1) d "
            "WHERE d.k0 = l.l_orderkey AND d.k1 = l.l_linenumber)"),
])

SUITE_FRAME = (
    "(SELECT l.*, l.l_extendedprice / NULLIF(l.l_quantity, 0) AS unit_price, o.o_orderkey, o.o_orderdate, "
    f"a.s_suppkey AS active_suppkey FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey "
    f"LEFT JOIN {ACTIVE} a ON l.l_suppkey = a.s_suppkey)"
)


def _expect(check, metric, value, failed, considered, success, src="t"):
    return (
        f"SELECT '{check}' AS \"check\", '{metric}' AS metric, ROUND(CAST({value} AS DOUBLE), 4) AS value, "
        f"CAST({failed} AS BIGINT) AS failed_rows, CAST({considered} AS BIGINT) AS considered_rows, "
        f"COALESCE({success}, FALSE) AS success, "
        f"ROUND(COALESCE({_pct(failed, considered)}, 0.0), 4) AS unexpected_pct FROM {src}"
    )


def _ratio_ok(failed, considered, mostly):
    return f"COALESCE(CAST({considered} - {failed} AS DOUBLE) / NULLIF({considered}, 0), 1.0) >= {mostly}"


SUITE_AGG = (
    f"(SELECT COUNT(*) AS n, COUNT(l_linestatus) AS nn_ls, "
    "COUNT(*) FILTER (WHERE l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^[OF]$')) AS bad_ls, "
    "COUNT(l_returnflag) AS nn_rf, COUNT(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS bad_rf, "
    "COUNT(DISTINCT l_returnflag) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS nd_rf, "
    "COUNT(*) FILTER (WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL) AS nn_pair, "
    "COUNT(*) FILTER (WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL AND NOT l_shipdate > o_orderdate) AS bad_pair, "
    "COUNT(*) FILTER (WHERE l_shipdate IS NULL) AS null_sd, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS null_ok, "
    "COUNT(*) FILTER (WHERE active_suppkey IS NULL) AS null_act, MIN(l_shipdate) AS min_sd, "
    "COUNT(*) FILTER (WHERE l_orderkey IS DISTINCT FROM o_orderkey) AS ne_order, "
    "COUNT(*) FILTER (WHERE l_suppkey IS DISTINCT FROM active_suppkey) AS ne_supp, "
    "AVG(unit_price) AS avg_up, quantile_disc(l_extendedprice, 0.9) AS p90 "
    f"FROM {SUITE_FRAME}) t"
)
SUITE_DUPS = _dups("lineitem", ["l_orderkey", "l_linenumber"], "t")
SUITE_RESULTS = " UNION ALL ".join([
    _expect("linestatus_format", "unexpected_count", "bad_ls", "bad_ls", "nn_ls", _ratio_ok("bad_ls", "nn_ls", 1.0), SUITE_AGG),
    _expect("returnflag_set", "distinct_values_not_in_set", "nd_rf", "bad_rf", "nn_rf", "nd_rf = 0", SUITE_AGG),
    _expect("ship_after_order", "unexpected_count", "bad_pair", "bad_pair", "nn_pair", _ratio_ok("bad_pair", "nn_pair", 0.5), SUITE_AGG),
    _expect("shipdate_not_null", "unexpected_count", "null_sd", "null_sd", "n", _ratio_ok("null_sd", "n", 1.0), SUITE_AGG),
    _expect("orderkey_not_null", "unexpected_count", "null_ok", "null_ok", "n", _ratio_ok("null_ok", "n", 1.0), SUITE_AGG),
    _expect("active_suppkey_not_null", "unexpected_count", "null_act", "null_act", "n", _ratio_ok("null_act", "n", 0.9), SUITE_AGG),
    _expect("shipdate_min", "min", "NULL", "NULL", "n", "min_sd >= TIMESTAMP '1995-01-01'", SUITE_AGG),
    _expect("order_found", "unexpected_count", "ne_order", "ne_order", "n", _ratio_ok("ne_order", "n", 1.0), SUITE_AGG),
    _expect("supplier_active", "unexpected_count", "ne_supp", "ne_supp", "n", _ratio_ok("ne_supp", "n", 1.0), SUITE_AGG),
    _expect("unit_price_mean", "avg", "avg_up", "NULL", "n", "avg_up BETWEEN 4000 AND 5000", SUITE_AGG),
    _expect("price_p90", "quantile_disc", "p90", "NULL", "n", "p90 BETWEEN 85000 AND 97500", SUITE_AGG),
    _expect("line_unique", "duplicate_rows", "dup_rows", "dup_rows", "considered",
            _ratio_ok("dup_rows", "considered", 0.9), SUITE_DUPS),
])


PROFILE_COLUMNS = [
    ("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
    ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False),
]


def oracle_sql() -> dict[str, str]:
    q = {}
    q["row_regex"] = (
        "SELECT p_partkey, p_brand, 'brand_format' AS issue, "
        "'Value ''' || p_brand || ''' in column ''p_brand'' does not match pattern ''^Brand#(?:[1-9]|1[0-9])$''' AS message "
        "FROM part WHERE p_brand IS NOT NULL AND NOT regexp_matches(p_brand, '^Brand#(?:[1-9]|1[0-9])$')"
    )
    q["row_in_list"] = (
        "SELECT o_orderkey, o_orderpriority, 'priority_valid' AS errors FROM orders WHERE o_orderpriority IS NOT NULL "
        "AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"
    )
    q["row_limit"] = f"SELECT {KEYS}, l.l_quantity FROM lineitem l WHERE l.l_quantity > 45"
    q["row_pair"] = (
        "WITH f AS (SELECT l.*, o.o_orderdate, "
        "COALESCE(l.l_shipdate IS NOT NULL AND o.o_orderdate IS NOT NULL AND NOT (l.l_shipdate > o.o_orderdate), FALSE) AS e1, "
        "COALESCE(l.l_shipdate IS NOT NULL AND o.o_orderdate IS NOT NULL AND NOT (l.l_shipdate >= o.o_orderdate), FALSE) AS e2, "
        "COALESCE(o.o_orderdate > l.l_shipdate, FALSE) AS w1 "
        "FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey) "
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
        "concat_ws(';', CASE WHEN e1 THEN 'ship_after_order' END, CASE WHEN e2 THEN 'ship_not_before_order' END) AS errors, "
        "concat_ws(';', CASE WHEN w1 THEN 'order_not_after_ship' END) AS warnings FROM f WHERE e1 OR e2 OR w1"
    )
    q["row_pair_equal"] = (
        f"SELECT {KEYS}, a.s_suppkey AS active_suppkey FROM lineitem l LEFT JOIN {ACTIVE} a "
        "ON l.l_suppkey = a.s_suppkey WHERE l.l_suppkey IS DISTINCT FROM a.s_suppkey"
    )
    q["row_not_null"] = (
        "SELECT doc_id, concat_ws(';', CASE WHEN quality IS NULL THEN 'quality_null' END, "
        f"CASE WHEN toxic IS NULL THEN 'toxic_null' END) AS warnings FROM {DOCS_LABELS} "
        "WHERE quality IS NULL OR toxic IS NULL"
    )
    q["row_not_empty"] = (
        "WITH f AS (SELECT doc_id, quality IS NULL AS e1, (text IS NULL OR trim(text) = '') AS e2, "
        f"(lang IS NULL OR lang = '') AS e3 FROM {DOCS_LABELS}) "
        "SELECT doc_id, concat_ws(';', CASE WHEN e1 THEN 'quality_missing' END, CASE WHEN e2 THEN 'text_missing' END, "
        "CASE WHEN e3 THEN 'lang_missing' END) AS errors FROM f WHERE e1 OR e2 OR e3"
    )
    q["row_fresh"] = (
        "SELECT event_id, user_id FROM events "
        "WHERE ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 20160 MINUTE"
    )
    q["fk_rows"] = (
        f"WITH f AS (SELECT {KEYS}, (l.l_suppkey IS NOT NULL AND a.s_suppkey IS NULL) AS e1, "
        "(l.l_orderkey IS NOT NULL AND o.o_orderkey IS NULL) AS e2 "
        f"FROM lineitem l LEFT JOIN {ACTIVE} a ON l.l_suppkey = a.s_suppkey "
        "LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) o ON l.l_orderkey = o.o_orderkey) "
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(';', CASE WHEN e1 THEN 'supplier_active' END, "
        "CASE WHEN e2 THEN 'order_exists' END) AS errors FROM f WHERE e1 OR e2"
    )
    q["fk_metric"] = _metric(
        "documents_labelled", "reference_unmatched", "r.unmatched", "r.n", "r.considered", "r.unmatched",
        _outcome("r.unmatched != 0"),
        "(SELECT COUNT(*) AS n, COUNT(d.doc_id) AS considered, "
        "COUNT(*) FILTER (WHERE d.doc_id IS NOT NULL AND k.doc_id IS NULL) AS unmatched FROM documents d "
        "LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE doc_id IS NOT NULL) k ON d.doc_id = k.doc_id) r")
    q["unique_rows"] = (
        f"SELECT {KEYS} FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem "
        "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1) d "
        "ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber"
    )
    dl = _dups("lineitem", ["l_orderkey", "l_linenumber"], "d")
    dd = _dups("documents", ["text"], "d")
    pct = "COALESCE(CAST(d.dup_rows AS DOUBLE) * 100.0 / NULLIF(d.rows_, 0), 0.0)"
    q["duplicate_metrics"] = (
        f"SELECT 'line_duplicates' AS \"check\", ROUND({pct}, 4) AS value, d.rows_ AS row_count, "
        f"d.considered AS considered_rows, d.dup_rows AS failed_rows, {_outcome(pct + ' >= 10')} AS outcome, "
        f"{_dup_details('d')} AS details FROM {dl} UNION ALL "
        f"SELECT 'line_unique_mostly', ROUND(CAST(d.dup_rows AS DOUBLE), 4), d.rows_, d.considered, d.dup_rows, "
        f"CASE WHEN {_ratio_ok('d.dup_rows', 'd.considered', 0.5)} THEN 'pass' ELSE 'fail' END, {_dup_details('d')} FROM {dl} "
        f"UNION ALL SELECT 'text_duplicates', ROUND({pct}, 4), d.rows_, d.considered, d.dup_rows, "
        f"{_outcome(pct + ' >= 10')}, {_dup_details('d')} FROM {dd}"
    )
    q["aggr_bounds"] = (
        f"WITH a AS (SELECT AVG({UNIT_PRICE}) AS up FROM lineitem), "
        "g AS (SELECT l_returnflag, SUM(l_quantity) AS sq FROM lineitem GROUP BY 1), "
        "f AS (SELECT COALESCE(a.up < 4800, FALSE) AS c0, COALESCE(a.up > 5000, FALSE) AS c1, "
        "COALESCE(g.sq > 1000, FALSE) AS c2 FROM lineitem l CROSS JOIN a "
        "LEFT JOIN g ON l.l_returnflag IS NOT DISTINCT FROM g.l_returnflag) "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS name, COUNT(*) FILTER (WHERE c{i}) AS failed_rows, COUNT(*) AS row_count, "
            f"ROUND(COALESCE({_pct(f'COUNT(*) FILTER (WHERE c{i})', 'COUNT(*)')}, 0.0), 4) AS failed_pct, "
            f"COALESCE({_pct(f'COUNT(*) FILTER (WHERE c{i})', 'COUNT(*)')}, 0.0) <= {m} AS passed FROM f"
            for i, (n, m) in enumerate([("unit_price_avg_min", 0), ("unit_price_avg_max", 0), ("quantity_sum_max", 100)])
        )
    )

    def lang_set(name, values):
        bad = f"lang IS NOT NULL AND lang NOT IN ({values})"
        return (
            f"SELECT '{name}' AS \"check\", CAST((SELECT COUNT(DISTINCT lang) FROM documents WHERE {bad}) AS DOUBLE) AS value, "
            f"COUNT(*) FILTER (WHERE {bad}) AS failed_rows, COUNT(lang) AS considered_rows, "
            f"(SELECT COUNT(DISTINCT lang) FROM documents WHERE {bad}) = 0 AS success FROM documents"
        )

    q["distinct_in_set"] = lang_set("lang_in_set", "'en', 'de', 'fr'") + " UNION ALL " + lang_set(
        "lang_in_wide_set", "'en', 'de', 'fr', 'es'")
    q["mean_min_bounds"] = (
        "WITH s AS (SELECT MIN(o_totalprice) AS mn, AVG(o_totalprice) AS av, MIN(o_orderdate) AS md FROM orders) "
        "SELECT 'price_min' AS \"check\", 'min' AS metric, ROUND(mn, 4) AS value, CAST(NULL AS VARCHAR) AS observed, "
        "COALESCE(mn >= 1000, FALSE) AS success FROM s UNION ALL "
        "SELECT 'price_mean', 'avg', ROUND(av, 4), NULL, COALESCE(av BETWEEN 200000 AND 300000, FALSE) FROM s UNION ALL "
        "SELECT 'price_mean_narrow', 'avg', ROUND(av, 4), NULL, COALESCE(av BETWEEN 260000 AND 300000, FALSE) FROM s UNION ALL "
        "SELECT 'orderdate_min', 'min', NULL, CAST(md AS VARCHAR), COALESCE(md >= TIMESTAMP '1995-01-01', FALSE) FROM s"
    )
    q["quantile_bounds"] = (
        "WITH s AS (SELECT quantile_disc(l_extendedprice, 0.9) AS d90, quantile_cont(l_extendedprice, 0.9) AS c90, "
        "quantile_disc(l_quantity, 0.5) AS q50, quantile_disc(l_quantity, 0.9) AS q90 FROM lineitem) "
        "SELECT 'p90_disc' AS \"check\", 'quantile_disc' AS metric, ROUND(d90, 4) AS value, "
        "COALESCE(d90 BETWEEN 85000 AND 92000, FALSE) AS success FROM s UNION ALL "
        "SELECT 'p90_cont', 'quantile_cont', ROUND(c90, 4), COALESCE(c90 BETWEEN 90000 AND 100000, FALSE) FROM s UNION ALL "
        "SELECT 'qty_quantiles', 'quantile_disc', ROUND(q50, 4), COALESCE(q50 BETWEEN 20 AND 30 AND q90 <= 44, FALSE) FROM s"
    )
    miss = f"(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE quality IS NULL) AS mq, " \
           f"COUNT(*) FILTER (WHERE text IS NULL OR text = '') AS mt FROM {DOCS_LABELS}) s"
    q["missing_metrics"] = " UNION ALL ".join([
        _metric("quality_missing_count", "missing_count", "s.mq", "s.n", "s.n", "s.mq", _outcome("s.mq != 0"), miss),
        _metric("quality_missing_pct", "missing_percent", f"COALESCE({_pct('s.mq', 's.n')}, 0.0)", "s.n", "s.n", "s.mq",
                _outcome(f"COALESCE({_pct('s.mq', 's.n')}, 0.0) > 5", f"COALESCE({_pct('s.mq', 's.n')}, 0.0) > 0.5"), miss),
        _metric("text_missing_pct", "missing_percent", f"COALESCE({_pct('s.mt', 's.n')}, 0.0)", "s.n", "s.n", "s.mt",
                _outcome(f"COALESCE({_pct('s.mt', 's.n')}, 0.0) > 5", f"COALESCE({_pct('s.mt', 's.n')}, 0.0) > 0.5"), miss),
    ])
    pb = ("(SELECT COUNT(*) AS n, COUNT(p_brand) AS nn, COUNT(*) FILTER (WHERE p_brand IS NOT NULL AND "
          "NOT regexp_matches(p_brand, '^Brand#(?:[1-9]|1[0-9])$')) AS bad FROM part) s")
    op = ("(SELECT COUNT(*) AS n, COUNT(o_orderpriority) AS nn, COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL AND "
          "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) AS bad FROM orders) s")
    lq = ("(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE l_quantity > 45) AS q45, "
          "COUNT(*) FILTER (WHERE l_tax > l_discount) AS td FROM lineitem) s")
    q["invalid_metrics"] = " UNION ALL ".join([
        _metric("brand_invalid", "invalid_count", "s.bad", "s.n", "s.nn", "s.bad", _outcome("s.bad != 0"), pb),
        _metric("priority_invalid", "invalid_count", "s.bad", "s.n", "s.nn", "s.bad", _outcome("s.bad != 0"), op),
        _metric("quantity_over_45", "row_count", "s.q45", "s.n", "s.n", "s.q45", _outcome("s.q45 != 0"), lq),
        _metric("tax_over_discount", "row_count", "s.td", "s.n", "s.n", "s.td", _outcome("s.td > 30000"), lq),
    ])
    mins = "CAST(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(newest) AS DOUBLE) / 60000000.0"
    q["freshness"] = (
        f"WITH s AS (SELECT MAX(ts) AS newest FROM events) "
        f"SELECT 'events_fresh' AS \"check\", ROUND({mins}, 4) AS value, {_outcome(mins + ' >= 20160')} AS outcome, "
        f"'newest=' || COALESCE(CAST(newest AS VARCHAR), 'null') AS details FROM s UNION ALL "
        f"SELECT 'events_fresh_tight', ROUND({mins}, 4), {_outcome(mins + ' >= 2')}, "
        f"'newest=' || COALESCE(CAST(newest AS VARCHAR), 'null') FROM s"
    )
    up = "(SELECT AVG(l_extendedprice / NULLIF(l_quantity, 0)) AS v FROM lineitem)"
    tax = "(SELECT SUM(l_tax) / COUNT(*) AS v FROM lineitem)"
    lab = ("(SELECT CAST(COUNT(l.doc_id) AS DOUBLE) / COUNT(*) * 100 AS v FROM documents d "
           "LEFT JOIN labels l ON d.doc_id = l.doc_id)")
    qual = "(SELECT SUM(quality) * 100.0 / COUNT(*) AS v FROM labels)"
    q["user_metrics"] = (
        f"SELECT 'unit_price_avg' AS \"check\", 'expression' AS metric, ROUND(CAST(v AS DOUBLE), 4) AS value, "
        f"{_outcome('v < 3000 OR v > 6000')} AS outcome FROM {up} UNION ALL "
        f"SELECT 'tax_share', 'expression', ROUND(CAST(v AS DOUBLE), 4), {_outcome('v > 0.05')} FROM {tax} UNION ALL "
        f"SELECT 'labelled_pct', 'sql_query', ROUND(CAST(v AS DOUBLE), 4), {_outcome('v < 80', 'v < 95')} FROM {lab} "
        f"UNION ALL SELECT 'labelled_quality_pct', 'sql_query', ROUND(CAST(v AS DOUBLE), 4), "
        f"{_outcome('v < 10', 'v < 95')} FROM {qual}"
    )
    q["scan_results"] = SCAN_RESULTS
    q["scan_outcomes"] = (
        f"SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE outcome = 'pass') AS pass, "
        f"COUNT(*) FILTER (WHERE outcome = 'warn') AS warn, COUNT(*) FILTER (WHERE outcome = 'fail') AS fail, "
        f"COUNT(*) FILTER (WHERE outcome = 'error') AS error FROM ({SCAN_RESULTS})"
    )
    q["failed_rows"] = (
        f"{FAILED_ROWS} UNION ALL SELECT * FROM (SELECT 'dearest_lines' AS failed_check, l_orderkey, l_partkey, l_suppkey, "
        "l_linenumber FROM lineitem WHERE l_quantity = 50 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, "
        "l_partkey, l_suppkey LIMIT 20)"
    )
    q["unexpected_values"] = (
        "SELECT lang AS value, COUNT(*) AS row_count FROM documents "
        "WHERE lang IS NOT NULL AND lang NOT IN ('en', 'de', 'fr') GROUP BY lang"
    )
    q["ref_union_distinct"] = (
        "SELECT DISTINCT ref_key FROM (SELECT 'N' || trim(CAST(s_nationkey AS VARCHAR)) AS ref_key FROM supplier "
        "UNION ALL SELECT 'N' || trim(CAST(c_nationkey AS VARCHAR)) FROM customer) WHERE ref_key IS NOT NULL"
    )
    q["annotated"] = (
        LINEITEM_FLAGS + f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_names('error')} AS errors, "
        f"{_names('warn')} AS warnings FROM f"
    )
    q["valid_split"] = LINEITEM_FLAGS + f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM f WHERE NOT {_any()}"
    q["quarantine_split"] = (
        LINEITEM_FLAGS + f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_count('error')} AS n_errors, "
        f"{_count('warn')} AS n_warnings FROM f WHERE {_any()}"
    )
    q["summary"] = (
        LINEITEM_FLAGS + ", s AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT " + _any() + ") AS v, "
        f"COUNT(*) FILTER (WHERE {_any('error')}) AS e, COUNT(*) FILTER (WHERE {_any('warn')}) AS w FROM f) "
        "SELECT n AS input_row_count, v AS valid_row_count, e AS error_row_count, w AS warning_row_count, "
        f"ROUND(COALESCE({_pct('v', 'n')}, 0.0), 4) AS valid_pct, ROUND(COALESCE({_pct('e', 'n')}, 0.0), 4) AS error_pct, "
        f"ROUND(COALESCE({_pct('w', 'n')}, 0.0), 4) AS warning_pct FROM s"
    )
    q["issues_long"] = LINEITEM_FLAGS + " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '{r[0]}' AS name, "
        f"'{'error' if r[1] == 'error' else 'warning'}' AS criticality FROM f WHERE c{i}"
        for i, r in enumerate(LINEITEM_RULES)
    )
    q["issue_counts"] = (
        f"SELECT name, criticality, COUNT(*) AS count FROM ({q['issues_long']}) GROUP BY name, criticality"
    )
    q["check_results"] = CHECK_RESULTS
    q["overall"] = (
        f"SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE NOT passed) AS failed_checks, "
        f"COUNT(*) FILTER (WHERE NOT passed) = 0 AS passed FROM ({CHECK_RESULTS})"
    )
    q["suite_results"] = SUITE_RESULTS
    q["suite_stats"] = (
        "SELECT COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE success) AS successful, "
        "ROUND(CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) * 100.0 / COUNT(*), 4) AS success_percent, "
        f"COUNT(*) FILTER (WHERE NOT success) = 0 AS success FROM ({SUITE_RESULTS})"
    )
    q["profile_orders"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) "
        f"AS null_count, COUNT(DISTINCT {c}) AS distinct_count, CAST(MIN({c}) AS VARCHAR) AS min, "
        f"CAST(MAX({c}) AS VARCHAR) AS max, "
        f"{'ROUND(CAST(AVG(' + c + ') AS DOUBLE), 4)' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean FROM orders"
        for c, t, numeric in PROFILE_COLUMNS
    )
    q["row_count_compare"] = (
        "WITH s AS (SELECT (SELECT COUNT(*) FROM orders) AS rows_a, "
        "(SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS rows_b) "
        "SELECT 'orders_vs_line_orders' AS \"check\", rows_a, rows_b, "
        "ROUND(COALESCE(CAST(ABS(rows_a - rows_b) AS DOUBLE) * 100.0 / NULLIF(rows_a, 0), "
        "CASE WHEN rows_b = 0 THEN 0.0 ELSE 100.0 END), 4) AS diff_pct, "
        "CASE WHEN COALESCE(CAST(ABS(rows_a - rows_b) AS DOUBLE) * 100.0 / NULLIF(rows_a, 0), "
        "CASE WHEN rows_b = 0 THEN 0.0 ELSE 100.0 END) <= 1.0 THEN 'pass' ELSE 'fail' END AS outcome FROM s"
    )
    q["run_results"] = CHECK_RESULTS
    q["run_parts"] = (
        LINEITEM_FLAGS + ", s AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT " + _any() + ") AS v, "
        f"COUNT(*) FILTER (WHERE {_any('error')}) AS e, COUNT(*) FILTER (WHERE {_any('warn')}) AS w FROM f) "
        "SELECT n AS input_row_count, v AS valid_row_count, e AS error_row_count, w AS warning_row_count, "
        f"o.failed_checks, o.passed, v AS valid_rows, n - v AS quarantine_rows FROM s, ({q['overall']}) o"
    )
    given = "(SELECT ROUND(COUNT(*) FILTER (WHERE p_size > 25) * 100.0 / COUNT(*), 4) FROM part)"
    by_table = "r.name IN ('returnflag_valid', 'supplier_active', 'line_unique')"
    strict = ", ".join(f"'{r[0]}'" for r in LINEITEM_RULES if r[6])
    q["threshold_results"] = (
        f"WITH t AS (SELECT name, failed_rows, row_count, failed_pct, CASE WHEN {by_table} THEN {given} ELSE max_failed_pct END AS allowed "
        f"FROM ({CHECK_RESULTS}) r) SELECT name, failed_pct, ROUND(CAST(allowed AS DOUBLE), 4) AS max_failed_pct, "
        f"CASE WHEN name IN ({strict}) THEN {_pct('failed_rows', 'row_count')} < allowed "
        f"ELSE {_pct('failed_rows', 'row_count')} <= allowed END AS passed FROM t"
    )
    limits = ", ".join(f"('{p}', {450000.0 - 20000.0 * i})" for i, p in enumerate(
        ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))
    q["table_sources"] = (
        f"SELECT o_orderpriority, COUNT(*) AS rows, CAST(MIN(most) AS DOUBLE) AS most FROM orders JOIN (VALUES {limits}) v(priority, most) "
        "ON o_orderpriority = priority WHERE o_totalprice > most GROUP BY o_orderpriority"
    )
    q["failed_results"] = f'SELECT "check", metric, unexpected_pct FROM ({SUITE_RESULTS}) WHERE NOT success'
    cheap = f"COALESCE({UNIT_PRICE} < 1000, FALSE)"
    taxed = "COALESCE(l_discount >= 0.09 AND l_tax > 0.07, FALSE)"
    late = "COALESCE(l_linenumber > 6, FALSE)"
    q["user_rows"] = (
        f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(';', CASE WHEN {cheap} THEN 'cheap_unit' END, "
        f"CASE WHEN {late} THEN 'late_line' END) AS errors, concat_ws(';', CASE WHEN {taxed} THEN 'free_and_taxed' END) AS warnings "
        f"FROM lineitem WHERE {cheap} OR {late} OR {taxed}"
    )
    q["fk_composite"] = (
        f"SELECT {KEYS}, 'pair_known;pair_known_by_key' AS errors FROM lineitem l WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'N' AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)"
    )
    q["fk_bitmap"] = (
        f"WITH f AS (SELECT {KEYS}, (l.l_partkey IS NOT NULL AND p.k IS NULL) AS e1, (l.l_orderkey IS NOT NULL AND o.k IS NULL) AS e2 "
        "FROM lineitem l LEFT JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size <= 25) p ON l.l_partkey = p.k "
        "LEFT JOIN (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'F') o ON l.l_orderkey = o.k) "
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(';', CASE WHEN e1 THEN 'part_small' END, "
        "CASE WHEN e2 THEN 'order_open' END) AS errors FROM f WHERE e1 OR e2"
    )
    q["state_metrics"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, ROUND(CAST(AVG({c}) AS DOUBLE), 4) AS mean, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, TRUE AS quantiles_near, TRUE AS distinct_near FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_orderkey"))
    q["scan_errors"] = (
        f'SELECT "check", metric, value, failed_rows, outcome FROM ({SCAN_RESULTS}) UNION ALL '
        "SELECT 'no_such_column', 'missing_count', NULL, NULL, 'error' UNION ALL "
        "SELECT 'zero_divisor', 'expression', NULL, NULL, CASE WHEN COUNT(*) FILTER (WHERE l_linenumber = 1) > 0 THEN 'error' ELSE 'pass' END FROM lineitem"
    )
    q["percentile_rank"] = (
        "SELECT 'p' || CAST(p AS VARCHAR) AS \"check\", (SELECT COUNT(l_extendedprice) FROM lineitem) AS n, TRUE AS within_bound "
        "FROM (VALUES (10), (50), (90)) v(p)"
    )
    if L is not None:
        q.update(L.ORACLE)
    return q

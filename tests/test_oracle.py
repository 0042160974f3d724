"""Every registered query against its DuckDB oracle (small scale, whole tables)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(rows):
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else round(x, 6)
        return x
    out = [tuple(v(x) for x in r) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    duck = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert norm(sdf.collect()) == norm(duck)


def test_every_query_has_oracle_or_is_approximate():
    missing = set(E.Q.QUERIES) - set(E.oracle_sql())
    assert missing == {"percentile_approx"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 12 and "passed" in df.columns


def test_percentile_approx_within_rank_error(spark, con):
    """The query without an oracle: its value must sit within the
    approximation's rank error (n / accuracy) of the exact p90."""
    value = E.queries()["percentile_approx"](spark, SF).first().value
    n = con.sql("SELECT COUNT(*) FROM lineitem").fetchall()[0][0]
    slack = n / 10000 + 1
    lo_q = max(0.0, 0.9 - slack / n)
    hi_q = min(1.0, 0.9 + slack / n)
    lo, hi = con.sql(f"SELECT quantile_disc(l_extendedprice, {lo_q}), quantile_disc(l_extendedprice, {hi_q}) "
                     "FROM lineitem").fetchall()[0]
    assert lo <= value <= hi

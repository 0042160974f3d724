"""Quick start on the test tables: the README walk-through, runnable.

    python examples/quickstart.py [/root/testdata/sf0.001] [output folder]

Outputs go to the given folder (default: a new temporary folder; on a
cluster pass a shared path).
"""

import datetime as dt
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import rowguard as rg  # noqa: E402
from rowguard.operators import metrics as M  # noqa: E402
from rowguard.plans import scan as S  # noqa: E402
from rowguard.session import local_session  # noqa: E402
from rowguard.sources import writers as W  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="rowguard-quickstart-")
    spark = local_session()
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet").where("s_acctbal > 0")

    rules = rg.suite(
        rg.in_dimension("accuracy", [
            rg.Rule("Invalid line status", rg.RegexMatch("l_linestatus", "^[OF]$")),
            rg.Rule("Invalid return flag", rg.InList("l_returnflag", ["A", "N", "R"])),
            rg.Rule("Tax above discount", rg.NotGreaterThan("l_tax", F.col("l_discount")), "warn"),
        ]),
        rg.in_dimension("completeness", [rg.Rule("Ship date missing", rg.NotNullNotEmpty("l_shipdate"), "warn")]),
        rg.in_dimension("consistency", [
            rg.Rule("Supplier active", rg.ForeignKey(["l_suppkey"], suppliers, ["s_suppkey"]), max_failed_pct=20)]),
        rg.in_dimension("currentness", [
            rg.Rule("Shipped in the last 6 years", rg.Fresh("l_shipdate", 6 * 365 * 24 * 60, as_of=dt.datetime(2001, 12, 31)),
                    max_failed_pct=20)]),
        rg.in_dimension("reasonableness", [
            rg.Rule("Unit price above 1000", rg.AggregateBound(
                F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), "avg", 1000, "min"))]),
        rg.in_dimension("uniqueness", [
            rg.Rule("Line duplicates", rg.Unique(["l_orderkey", "l_linenumber"]), max_failed_pct=50, strict=True)]),
    )
    annotated, observation = rg.apply_checks(lineitem, rules)
    W.save_partitioned_split(annotated, f"{out}/split")
    print("observed:", observation.get)
    valid, quarantine = W.read_split(spark, f"{out}/split")
    rg.check_results(annotated, rules).show(truncate=False)   # percentages of all rows, not of the quarantine

    part.createOrReplaceTempView("part_v")
    result = rg.scan({"part_v": part}, "part_v", [
        S.invalid_count("Invalid brand", "p_brand", regex=r"^Brand#(?:[1-9]|1[0-9])$", samples_limit=2),
        S.missing_percent("Missing type", "p_type", warn=M.when(">", 0.5), fail=M.when(">", 5)),
        S.duplicate_percent("Name duplicates", ["p_name"], fail=M.when(">=", 10)),
        S.expression_metric("Mean price", "AVG(p_retailprice)", fail=M.when("not_between", 900, 2100)),
    ], sample_order=["p_partkey"], sample_sink=lambda s: W.write_samples(s, f"{out}/samples"))
    result.results.show(truncate=False)
    result.outcomes().show()
    W.read_samples(spark, f"{out}/samples").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()

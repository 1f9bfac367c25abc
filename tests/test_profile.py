"""Profile checks on literal frames (reconciliation tolerance, quantiles, IQR)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from helpers import staffing_rows

from rosterline.functions.quantiles import exact_quantiles, long_values
from rosterline.operators import profile as P

D = dt.date(2024, 4, 1)


def test_reconciliation_tolerance(spark):
    rows = [
        {"provnum": "1", "workdate": D, "mdscensus": 1.0, "hrs_rn": 10.0, "hrs_rn_emp": 9.995,
         "hrs_rn_ctr": 0.0},
        {"provnum": "2", "workdate": D, "mdscensus": 1.0, "hrs_rn": 10.0, "hrs_rn_emp": 9.98,
         "hrs_rn_ctr": None},
        {"provnum": "3", "workdate": D, "mdscensus": 1.0},
    ]
    got = {r.role: r.mismatches for r in P.reconciliation(staffing_rows(spark, rows)).collect()}
    assert got["RN"] == 1 and got["LPN"] == 0 and len(got) == 5


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_exact_quantiles_match_pandas(spark, ranges):
    vals = [float(x) for x in [5, 1, 1, 1, 9, 2, 7, 7, 3, 100, 4, 4, 4, 4]]
    df = spark.createDataFrame([(v, v * 2 if v < 50 else None) for v in vals], "a double, b double")
    q = {r.column_name: r for r in exact_quantiles(long_values(df, ["a", "b"]), [0.1, 0.25, 0.5, 0.9], ranges).collect()}
    pdf = pd.DataFrame({"a": vals, "b": [v * 2 if v < 50 else None for v in vals]})
    for c in ["a", "b"]:
        exp = pdf[c].dropna().quantile([0.1, 0.25, 0.5, 0.9]).tolist()
        got = [q[c][f"q_{k}"] for k in range(4)]
        assert got == pytest.approx(exp)
        assert q[c].n == pdf[c].notna().sum()


def test_exact_quantiles_do_not_hang_on_the_planner(spark):
    """400,000 distinct values: the same with exchange reuse and AQE on and off."""
    df = spark.range(400_000, numPartitions=8).select(
        F.sin(F.col("id")).alias("a"), (F.col("id") % 1000 * F.lit(1.5)).alias("b"))
    values = long_values(df, ["a", "b"])
    a = np.sin(np.arange(400_000))
    b = np.arange(400_000) % 1000 * 1.5
    keys = ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for reuse in ("true", "false"):
            for aqe in ("true", "false"):
                spark.conf.set(keys[0], reuse)
                spark.conf.set(keys[1], aqe)
                got = {r.column_name: (r.n, r.q_0, r.q_1, r.q_2)
                       for r in exact_quantiles(values, [0.25, 0.5, 0.75]).collect()}
                for name, x in (("a", a), ("b", b)):
                    assert got[name][0] == len(x)
                    assert got[name][1:] == pytest.approx(tuple(np.quantile(x, [0.25, 0.5, 0.75])), rel=1e-12)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cardinality_counts_county_codes(spark):
    rows = [{"provnum": str(i), "county_name": "Lake", "county_fips": f"0{i}001"} for i in range(3)]
    assert P.cardinality(staffing_rows(spark, rows)).first().counties == 3


def test_iqr_and_describe(spark):
    rows = [{"provnum": str(i), "workdate": D, "mdscensus": float(v), "hrs_rn": float(v)}
            for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 100])]
    s = staffing_rows(spark, rows)
    iqr = {r.column_name: r for r in P.iqr_outliers(s).collect()}
    assert iqr["mdscensus"].outliers == 1 and iqr["hrs_rn"].outliers == 1
    assert "hrs_lpn" not in iqr  # no values at all
    d = {r.column_name: r for r in P.describe(s, ["mdscensus"]).collect()}["mdscensus"]
    ser = pd.Series([1, 2, 3, 4, 5, 6, 7, 8, 9, 100], dtype=float)
    assert d["count"] == 10 and d.mean == pytest.approx(ser.mean()) and d["std"] == pytest.approx(ser.std())
    assert (d.q25, d.q50, d.q75) == pytest.approx(tuple(ser.quantile([0.25, 0.5, 0.75])))


def test_duplicates(spark):
    rows = [{"provnum": "1", "workdate": D, "mdscensus": 1.0}] * 3 + [
        {"provnum": "1", "workdate": D, "mdscensus": 2.0}]
    s = staffing_rows(spark, rows)
    assert P.duplicate_rows(s).first().duplicate_rows == 2
    k = P.duplicate_keys(s, ["provnum", "workdate"]).first()
    assert (k.duplicate_key_rows, k.duplicated_keys) == (3, 1)


def test_null_profile_sorted(spark):
    s = staffing_rows(spark, [{"provnum": "1", "workdate": D, "mdscensus": 1.0}] * 3)
    rows = P.null_profile(s).collect()
    assert rows[0].null_percentage == 100.0 and rows[-1].null_percentage == 0.0

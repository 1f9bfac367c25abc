"""Property tests."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterline.functions.quantiles import exact_quantiles, long_values
from rosterline.operators import clean as C
from rosterline.plans import registry as RG
from rosterline.plans import views as V
from conftest import SF_SMALL

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3), st.text("abc", max_size=2)),
    min_size=1, max_size=40,
)


@SETTINGS
@given(data=rows)
def test_first_per_key_matches_sorted_first(spark, data):
    # key 0 is hot: a third of the rows at least
    data = data + [(0, i % 3, i % 2, "h") for i in range(len(data) // 2 + 1)]
    df = spark.createDataFrame(data, "k int, a int, b int, v string")
    got = sorted(tuple(r) for r in C.first_per_key(df, ["k"], ["a", "b", "v"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "a", "b", "v"]).sort_values(["k", "a", "b", "v"])
    exp = sorted(tuple(x) for x in pdf.drop_duplicates("k").itertuples(index=False, name=None))
    assert got == exp


@SETTINGS
@given(values=st.lists(st.integers(-5, 5).map(float) | st.floats(-1e6, 1e6, allow_nan=False),
                       min_size=1, max_size=60),
       ranges=st.integers(1, 9))
def test_exact_quantiles_match_numpy(spark, values, ranges):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    r = exact_quantiles(long_values(df, ["x"]), probs, ranges).first()
    exp = np.quantile(np.array(values), probs)  # linear interpolation, as pandas
    assert [r[f"q_{k}"] for k in range(len(probs))] == pytest.approx(list(exp), rel=1e-12, abs=1e-9)


@pytest.fixture(scope="module")
def inputs(spark):
    return RG.Inputs(spark, SF_SMALL)


def test_state_totals_add_up_to_national(inputs):
    daily = inputs.daily()
    states = V.state_summary(daily, inputs.provider()).agg(
        F.sum("total_resident_days"), F.sum("total_facilities")).first()
    nat = V.national_kpis(daily).first()
    assert states[0] == pytest.approx(nat.total_resident_days)
    assert states[1] >= nat.total_facilities  # a facility in two states counts in both


def test_band_counts_sum_to_filtered_facilities(inputs):
    a = inputs.analytics()
    bands = V.staffing_bands(a).agg(F.sum("facilities")).first()[0]
    assert bands == a.where(F.col("rehospitalization_rate").isNotNull()).count()


def test_enrichment_preserves_rows(inputs):
    from rosterline.operators.enrich import enrich_daily

    assert enrich_daily(inputs.daily(), inputs.provider()).count() == inputs.daily().count()


def test_figures_probed_in_fixtures(spark):
    """FIXTURES.md section 4.5 lists values probed independently at sf0.01."""
    import __spark_entry__ as E

    from rosterline.operators import profile as P

    q, sf = E.queries(), "/root/testdata/sf0.01"
    curated = RG.Inputs(spark, sf).staffing()  # before defects are planted
    ds = q["dataset_summary"](spark, sf).first()
    assert (ds.rows, ds.facilities, ds.dates) == (53307, 100, 2499)
    assert q["state_options"](spark, sf).count() == 25
    nat = q["national_kpis"](spark, sf).first()
    assert nat.total_resident_days == 376149.75 and round(nat.total_direct_hprd, 4) == 4.0519
    assert round(nat.contract_dependency_pct, 2) == 50.02
    assert P.describe_census(curated).first().zero_census == 6886
    nulls = {r.column_name: r.null_count for r in P.null_profile(curated).collect()}
    assert nulls["hrs_rn"] == 34062
    assert P.negative_hours(curated).first()["negative_hrs_natrn"] == 163
    assert {r.role: r.mismatches for r in q["reconciliation"](spark, sf).collect()}["RN"] == 1427
    assert q["unmatched_ids"](spark, sf).count() == 2
    assert q["duplicate_keys"](spark, sf).first().duplicate_key_rows == 6693


def test_hot_facility_and_hot_value(spark):
    """One facility holds a third of the daily rows; one census value a third of a column."""
    import datetime as dt

    from helpers import provider_rows, staffing_rows

    from rosterline.operators.derive import with_daily_metrics

    rows = []
    for i in range(300):
        hot = i % 3 == 0
        rows.append({"provnum": "hot" if hot else f"f{i % 7}", "state": "TX" if hot else "CA",
                     "workdate": dt.date(2024, 4, 1) + dt.timedelta(days=i % 90),
                     "mdscensus": 5.0 if hot else float(1 + i % 11), "hrs_rn": float(i % 13)})
    daily = with_daily_metrics(staffing_rows(spark, rows))
    prov = provider_rows(spark, [{"provider_id": p, "overall_rating": 3.0} for p in
                                 ["hot"] + [f"f{k}" for k in range(7)]])
    pdf = pd.DataFrame(rows)
    g = pdf.groupby("provnum").agg(rn=("hrs_rn", "sum"), days=("mdscensus", "sum"),
                                   dates=("workdate", "nunique"))
    got = {r.provnum: r for r in V.facility_summary(daily, prov).collect()}
    for p, r in g.iterrows():
        assert got[p].rn_hprd == pytest.approx(r.rn / r.days) and got[p].reporting_days == r.dates
    st = {r.state: r.total_facilities for r in V.state_summary(daily, prov).collect()}
    assert st == {"TX": 1, "CA": 7}
    q = exact_quantiles(long_values(daily, ["mdscensus"]), [0.25, 0.5, 0.75]).first()
    exp = np.quantile(pdf["mdscensus"].to_numpy(), [0.25, 0.5, 0.75])
    assert [q.q_0, q.q_1, q.q_2] == pytest.approx(list(exp))


@pytest.mark.parametrize("most", [100_000, 40])
@pytest.mark.parametrize("accuracy", [10_000, 4])
def test_quantiles_by_rank_brackets(spark, most, accuracy):
    """Continuous, constant, heavy-tailed, NULL and NaN columns; brackets that must be opened or narrowed."""
    from rosterline.functions import quantiles as Q

    rng = np.random.default_rng(7)
    n = 4000
    data = {
        "normal": rng.normal(size=n), "same": np.full(n, 2.5), "steps": rng.integers(0, 3, n).astype(float),
        "tail": np.exp(8 * rng.random(n)), "hot": np.where(rng.random(n) < 0.4, 1.0, rng.normal(size=n)),
    }
    pdf = pd.DataFrame(data)
    df = spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double"))
    df = df.withColumn("nan", F.when(F.col("normal") > 0.2, float("nan")).otherwise(F.col("normal")))
    names, probs = [*data, "none", "nan"], [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    columns = [F.col(c) for c in names]
    first = df.agg(*Q.sketches(columns, probs, accuracy)).first()
    got = dict(zip(names, Q.quantiles(df, columns, probs, first, accuracy, most)))
    for c in data:
        assert got[c] == pytest.approx(list(np.quantile(data[c], probs)), rel=1e-12, abs=1e-12), c
    assert got["none"] == [None] * len(probs)
    ordered = np.sort(np.where(data["normal"] > 0.2, np.nan, data["normal"]))  # NaN last
    for k, p in enumerate(probs):
        place = p * (n - 1)
        lo, hi = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
        want = lo if place == int(place) else lo + (place - np.floor(place)) * (hi - lo)
        assert got["nan"][k] == pytest.approx(want, nan_ok=True)


def test_describe_reads_its_table_twice(spark, monkeypatch):
    from rosterline.functions import quantiles as Q
    from rosterline.operators import profile as P

    passes = []
    real = Q._count_zones
    monkeypatch.setattr(Q, "_count_zones", lambda *a: passes.append(1) or real(*a))
    monkeypatch.setattr(Q, "_narrow", lambda *a: passes.append("narrowed"))
    P.describe_hours(RG.Inputs(spark, SF_SMALL).typed())
    assert passes == [1]  # beside the one aggregate


def test_duplicate_rows_compare_rows_of_equal_fingerprints(spark, monkeypatch):
    """All fingerprints collide: only equal rows count.  NULLs are told apart by place."""
    from rosterline.operators import profile as P

    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (2, "b", "c"), (2, "b", "c"), (2, "b", "c"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "_n int, _f1 string, z string")  # names used inside
    assert P.duplicate_rows(df).first()[0] == 4
    monkeypatch.setattr(P, "_fingerprint", lambda df, salt: F.lit(7).cast("long"))
    assert P.duplicate_rows(df).first()[0] == 4
    assert P.duplicate_rows(df.limit(0)).first()[0] == 0


def test_duplicate_rows_shuffle_fingerprints_only(spark):
    from rosterline.operators import profile as P

    df = RG.Inputs(spark, SF_SMALL).staffing()
    named = df.withColumns({"_f1": P._fingerprint(df, 0), "_f2": P._fingerprint(df, 1)}).groupBy("_f1", "_f2").count()
    plan = named._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchange and all("_f1" in line and "provname" not in line for line in exchange)

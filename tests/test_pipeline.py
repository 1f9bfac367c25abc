"""End to end: raw CSV files -> curated tables -> enriched table -> views."""

import os

import pytest
from oracle_compare import _close, _rows
from pyspark.sql import functions as F

from rosterline.plans import pipeline as PL
from rosterline.plans import sql_views
from rosterline.sources import testmap as M
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    raw = M.write_raw_inputs(spark, SF_SMALL, os.path.join(base, "raw"),
                             M.staffing_daily(spark, SF_SMALL).repartition(3))
    paths = PL.Paths(raw["pbj"], raw["provider"], raw["claims"], f"{base}/curated", "r1")
    from rosterline.session import scale_conf

    saved = {k: spark.conf.get(k) for k in scale_conf(1)}
    try:
        report = PL.run_all(spark, paths, tune=True)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    return paths, report


def test_counts_and_guards(spark, run):
    paths, rep = run
    assert int(rep.counts["conf"]["spark.sql.shuffle.partitions"]) == 200
    st = rep.counts["staffing"]
    assert st["raw_rows"] > st["valid_rows"] > 0
    assert rep.counts["enrichment"]["enriched_rows"] == st["valid_rows"]
    assert rep.coverage["coverage_pct"] >= 95.0
    assert rep.summaries["dataset"][0]["rows"] == st["valid_rows"]
    assert sum(s["rows"] for s in rep.summaries["states"]) == st["valid_rows"]
    assert rep.summaries["files"][0]["files"] == 3 and rep.summaries["files"][0]["rows"] == st["raw_rows"]
    assert st["present_rows"] + st["dropped_empty"] == st["raw_rows"]
    dropped = [st[f"dropped_{n}"] for n in ("blank_id", "bad_date", "missing_census", "negative_census")]
    assert all(dropped) and st["present_rows"] - sum(dropped) == st["valid_rows"]
    assert st["negative_hour_rows"] > 0


def test_sql_views_equal_dataframe_views(spark, run):
    paths, _ = run
    dfv = PL.views_from_tables(
        spark,
        paths.curated("staffing_metrics"),
        paths.curated("provider_info"),
        paths.curated("quality_claims"),
    )
    for view, key in [("vw_facility_summary", "facility_summary"),
                      ("vw_state_summary", "state_summary"),
                      ("vw_facility_analytics", "facility_analytics")]:
        a = spark.table(view).toPandas()
        b = dfv[key].toPandas()
        assert sorted(a.columns) == sorted(b.columns)
        ra, rb = _rows(a.astype(object).where(a.notna(), None)), _rows(b.astype(object).where(b.notna(), None))
        assert len(ra) == len(rb)
        for x, y in zip(ra, rb):
            assert all(_close(u, v) for u, v in zip(x, y)), (view, x, y)
    corr = spark.table("vw_staffing_quality_correlations").first()
    assert len(corr) == 10


def test_trend_query_prunes_state_partition(spark, run):
    r = spark.table("facility_metrics").select("state", "provnum").first()
    q = sql_views.trend_query(spark, r.state, r.provnum)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan and "PushedFilters" in plan
    assert q.count() > 0


def test_materialised_summary_prunes(spark, run):
    r = spark.table("vw_facility_analytics").select("state").first()
    q = sql_views.facility_query(spark, r.state)
    assert "PartitionFilters: [isnotnull(state" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == spark.table("vw_facility_analytics").toPandas().state.eq(r.state).sum() > 0


def test_published_plan_hashes_the_daily_rows(spark, run):
    """What is published: no sort aggregate reads the daily rows."""
    from rosterline.plans import views as V

    paths, _ = run
    daily = spark.read.parquet(paths.curated("staffing_metrics")).drop("etl_processed_at")
    provider = spark.read.parquet(paths.curated("provider_info")).drop("etl_processed_at")
    for df in (V.facility_summary(daily, provider), V.state_summary(daily, provider)):
        df.collect()
        for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
            assert "SortAggregate" not in line or ("state" in line and "mdscensus" not in line)


def test_published_columns_are_fixed(spark, run):
    from rosterline import schemas as S

    assert set(spark.table("facility_metrics").columns) == set(S.FACILITY_METRICS_SCHEMA.names)
    assert "source_file" not in spark.table("facility_metrics").columns
    assert spark.table("facility_metrics").where("etl_processed_at IS NULL").count() == 0
    assert set(spark.table("quality_claims").columns) == set(S.PUBLISHED_CLAIMS_SCHEMA.names)


def test_no_valid_row_and_repeated_days_are_errors(spark, tmp_path):
    from helpers import write_csv

    from rosterline import schemas as S
    from rosterline.operators.enrich import GuardError

    head = S.STAFFING_SOURCE_HEADERS
    for rows in ([], [[None] * len(head)]):
        path = write_csv(str(tmp_path / f"raw{len(rows)}" / "a.csv"), head, rows)
        with pytest.raises(GuardError, match="no valid staffing row"):
            PL.run_staffing(spark, path, str(tmp_path / f"out{len(rows)}"))
    good = dict.fromkeys(head, "1") | {"PROVNUM": "7", "STATE": "TX", "WorkDate": "20240401"}
    path = write_csv(str(tmp_path / "twice" / "a.csv"), head, [[good[h] for h in head]] * 2)
    PL.run_staffing(spark, path, str(tmp_path / "st"))
    spark.createDataFrame([], S.PROVIDER_SCHEMA).write.parquet(str(tmp_path / "pr"))
    with pytest.raises(GuardError, match="repeat a facility and day"):
        PL.run_enrichment(spark, str(tmp_path / "st"), str(tmp_path / "pr"), str(tmp_path / "out"))


def test_external_tables_and_report_sink(spark, run, tmp_path):
    from rosterline.operators import profile as P
    from rosterline.sources import sinks

    paths, _ = run
    from rosterline import schemas as S

    sinks.register_external_table(
        spark, "ext_facility_metrics", paths.curated("facility_metrics"), S.FACILITY_METRICS_SCHEMA, "state")
    sinks.register_external_table(
        spark, "ext_quality_claims", paths.curated("quality_claims"), S.PUBLISHED_CLAIMS_SCHEMA)
    assert spark.table("ext_facility_metrics").count() == spark.table("facility_metrics").count()
    assert spark.table("ext_quality_claims").count() > 0
    st = spark.table("facility_metrics").select("state").first().state
    q = spark.table("ext_facility_metrics").where(F.col("state") == st)
    assert "PartitionFilters: [isnotnull(state" in q._jdf.queryExecution().executedPlan().toString()
    out = str(tmp_path / "profile")
    sinks.write_report_csv(P.null_profile(spark.table("facility_metrics")), out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == len(spark.table("facility_metrics").columns)


def test_parameters_are_bound_not_spliced(spark, run):
    assert sql_views.trend_query(spark, "X' OR '1'='1", "1").count() == 0
    assert sql_views.facility_query(spark, "nowhere' OR state IS NOT NULL --").count() == 0


def test_job_report_counters(run):
    _, rep = run
    st = rep.counts["staffing"]
    assert st["default_partition_rows"] == 0
    assert rep.summaries["state_conflicts"][0]["facilities_in_several_states"] == 0


def test_state_query_matches_dataframe_overview(spark, run):
    from rosterline.plans import reports as R
    from rosterline.plans import views as V

    paths, _ = run
    daily = spark.read.parquet(paths.curated("staffing_metrics")).drop("etl_processed_at")
    provider = spark.read.parquet(paths.curated("provider_info")).drop("etl_processed_at")
    ov = R.state_overview(V.state_summary(daily, provider),
                          V.state_facility_ratings(V.facility_summary(daily, provider)))
    a = sql_views.state_query(spark).toPandas()
    b = ov.toPandas()
    ra = _rows(a.astype(object).where(a.notna(), None))
    rb = _rows(b.astype(object).where(b.notna(), None))
    assert len(ra) == len(rb) and all(all(_close(u, v) for u, v in zip(x, y)) for x, y in zip(ra, rb))


def test_null_and_blank_partition_values(spark, tmp_path):
    from rosterline.sources import sinks

    df = spark.createDataFrame([("1", "TX"), ("2", None), ("3", "")], "provnum string, state string")
    assert sinks.null_partition_rows(df, "state").first()[0] == 2
    out = str(tmp_path / "t")
    sinks.write_partitioned(df, out, "state")
    back = {r.provnum: r.state for r in spark.read.parquet(out).collect()}
    assert back == {"1": "TX", "2": None, "3": None}
    assert any(p.name == "state=__HIVE_DEFAULT_PARTITION__" for p in (tmp_path / "t").iterdir())


def test_timestamps_and_trend_series(spark, run):
    from rosterline.plans import reports as R

    paths, _ = run
    assert "etl_processed_at" in spark.read.parquet(paths.curated("staffing_metrics")).columns
    assert "facility_metrics_processed_at" in spark.table("facility_metrics").columns
    r = spark.table("facility_metrics").select("state", "provnum").first()
    series = R.trend_series(sql_views.trend_query(spark, r.state, r.provnum))
    assert set(series) == {"hprd", "contract", "census"}
    assert series["census"].columns == ["workdate", "mdscensus"]
    assert series["hprd"].count() == series["contract"].count() > 0


def test_ordered_reports_come_in_their_order(spark, run):
    """K4: the order of rows, which the comparison with SQL does not see."""
    from rosterline.operators import profile as P

    paths, _ = run
    staffing = spark.read.parquet(paths.curated("staffing_metrics"))
    states = [r.state for r in P.state_distribution(staffing).collect()]
    assert states == sorted(states)
    quarters = [(r.year, r.quarter) for r in P.quarter_distribution(staffing).collect()]
    assert quarters == sorted(quarters)
    overview = [r.state for r in sql_views.state_query(spark).collect()]
    assert overview == sorted(overview)
    r = spark.table("facility_metrics").select("state", "provnum").first()
    days = [x.workdate for x in sql_views.trend_query(spark, r.state, r.provnum).collect()]
    assert days == sorted(days) and len(days) > 1
    names = [(x.provider_name or "\uffff", x.provnum) for x in sql_views.facility_query(spark, r.state).collect()]
    assert names == sorted(names)
    bands = [x.avg_total_hprd for x in _bands(spark)]
    assert bands == sorted(bands)


def test_profile_reports_are_written(spark, run):
    """The fused profile equals the single reports, and the job writes it."""
    from rosterline.operators import profile as P

    paths, rep = run
    typed = spark.read.parquet(paths.curated("staffing_metrics") + "_typed").where(PL.PRESENT)
    typed = typed.drop(PL.PRESENT, "source_file", "malformed_record")
    out = paths.curated("profile")
    assert set(rep.summaries["profile"]) == {
        "null_profile", "date_validation", "negative_hours", "reconciliation", "describe", "iqr_outliers",
        "cardinality", "duplicate_keys", "duplicate_rows",
    }

    def back(name):
        return spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/{name}")

    nulls = {r.column_name: (r.null_count, r.null_percentage) for r in back("null_profile").collect()}
    assert nulls == {r.column_name: (r.null_count, pytest.approx(r.null_percentage, abs=0.011)) for r in P.null_profile(typed).collect()}
    fused = {r.column_name: r for r in back("describe").collect()}
    for df in (P.describe_census(typed), P.describe_hours(typed), P.describe_hprd(typed), P.contract_pct_profile(typed)):
        for r in df.collect():
            for c in P.DESCRIBE_COLUMNS:
                assert fused[r.column_name][c] == pytest.approx(r[c]), (r.column_name, c)
    for name, single in [("iqr_outliers", P.iqr_outliers(typed)), ("reconciliation", P.reconciliation(typed)),
                         ("duplicate_rows", P.duplicate_rows(typed)), ("cardinality", P.cardinality(typed)),
                         ("duplicate_keys", P.duplicate_keys(typed, ["provnum", "workdate"]))]:
        a, b = sorted(map(tuple, back(name).collect())), sorted(map(tuple, single.collect()))
        assert [pytest.approx(x) if not isinstance(x, str) else x for r in b for x in r] == [x for r in a for x in r], name
    assert back("negative_hours").where("column_name = 'any'").first()["rows"] == P.negative_hours(typed).first()[0]
    lo, hi = PL.PERIOD
    assert back("date_validation").first()["outside_period"] == P.date_validation(typed, lo, hi).first()["outside_period"]


def staffing_file(path, days):
    """A raw staffing file of (facility, state, day, census, nurse hours)."""
    from helpers import write_csv

    from rosterline import schemas as S

    head = S.STAFFING_SOURCE_HEADERS
    rows = []
    for provnum, state, day, census, hours in days:
        row = dict.fromkeys(head) | {"PROVNUM": provnum, "STATE": state, "WorkDate": day, "MDScensus": str(census), "Hrs_RN": str(hours)}
        rows.append([row[h] for h in head])
    return write_csv(path, head, rows)


@pytest.fixture()
def lake(spark, tmp_path):
    """A provider and a claims file for facilities 1 to 9, and jobs over given days."""
    from helpers import write_csv

    from rosterline import schemas as S

    def some(columns, key, rows):
        head = [h for h, _, _ in columns]
        at = [n for _, n, _ in columns].index(key)
        return head, [[str(r) if i == at else None for i in range(len(head))] for r in rows]

    provider = write_csv(str(tmp_path / "provider.csv"), *some(S.PROVIDER_COLUMNS, "provider_id", range(1, 10)))
    claims = write_csv(str(tmp_path / "claims.csv"), *some(S.CLAIMS_COLUMNS, "provider_id", range(1, 10)))

    def job(run_id, days, history=False):
        raw = staffing_file(str(tmp_path / "raw" / f"{run_id}-{len(days)}" / "a.csv"), days)
        paths = PL.Paths(raw, provider, claims, str(tmp_path / "out"), run_id)
        return paths, PL.run_all(spark, paths, history=history)

    return job


def test_rerun_replaces_what_no_longer_occurs(spark, lake, tmp_path):
    """A corrected rerun leaves no state of the first one; a reader that began on it ends on it."""
    from rosterline.sources import sinks

    lake("q1", [("1", "TX", "20240401", 10, 5), ("2", "CA", "20240401", 10, 5)])
    before = spark.table("facility_metrics")
    assert {r.state for r in before.collect()} == {"TX", "CA"}
    lake("q1", [("1", "TX", "20240401", 12, 5)])
    assert [(r.state, r.mdscensus) for r in spark.table("facility_metrics").collect()] == [("TX", 12.0)]
    assert {r.state for r in spark.table("vw_state_summary").collect()} == {"TX"}
    assert {r.state for r in before.collect()} == {"TX", "CA"}
    out = str(tmp_path / "same")
    for rows in ([("1", "TX"), ("2", "CA")], [("1", "TX")]):
        sinks.write_partitioned(spark.createDataFrame(rows, "provnum string, state string"), out, "state")
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("1", "TX")]


def test_a_failed_publish_leaves_the_old_version(spark, lake, tmp_path):
    from rosterline import schemas as S
    from rosterline.sources import sinks

    lake("ok", [("3", "NV", "20240402", 4, 2)])
    with pytest.raises(Exception):
        sinks.publish_version(spark, "facility_metrics", "nofs://nowhere", S.FACILITY_METRICS_SCHEMA, "state")
    assert [r.state for r in spark.table("facility_metrics").collect()] == ["NV"]
    (path,) = {f.rsplit("/state=", 1)[0] for f in spark.table("facility_metrics").inputFiles()}
    for _ in range(3):
        sinks.publish_version(spark, "facility_metrics", path, S.FACILITY_METRICS_SCHEMA, "state")
    assert len(spark.catalog.listTables(pattern="facility_metrics__*")) <= 1 + sinks.KEPT_VERSIONS + 1
    assert [r.state for r in spark.table("facility_metrics").collect()] == ["NV"]


def test_history_scans_the_new_quarter_only(spark, lake):
    """Summaries merged from the parts of each quarter equal those of all days at once."""
    first = [("1", "TX", "20240401", 10, 5), ("1", "TX", "20240402", 20, 8), ("2", "CA", "20240501", 4, 1)]
    wrong = [("1", "TX", "20240701", 99, 9)]
    second = [("1", "TX", "20240701", 10, 4), ("1", "OK", "20240702", 10, 6), ("3", "NV", "20240815", 7, 7)]
    lake("2024q2", first, history=True)
    lake("2024q3", wrong, history=True)
    paths, rep = lake("2024q3", second, history=True)
    assert rep.counts["staffing"]["raw_rows"] == len(second)
    merged = {n: sorted(map(str, spark.table(n).collect())) for n in ("vw_facility_summary", "vw_state_summary", "vw_facility_analytics", "state_overview")}
    lake("all", first + second)
    assert merged == {n: sorted(map(str, spark.table(n).collect())) for n in merged}
    one = {r.provnum: r for r in spark.table("vw_facility_summary").collect()}["1"]
    assert (one.reporting_days, one.state, str(one.first_date), str(one.last_date)) == (4, "TX", "2024-04-01", "2024-07-02")
    from rosterline.plans import views as V

    parts = PL.merged_partials(spark, paths.out_base, {"2024q3": paths.attempt}).where("provnum <> 'x'")
    assert V.summarise_nation(PL.merged_partials(spark, paths.out_base, {})).first().total_facilities == 3 and parts.count() >= 5


def test_malformed_records_are_counted_and_kept(spark, tmp_path):
    path = staffing_file(str(tmp_path / "m" / "a.csv"), [("1", "TX", "20240401", 3, 1)])
    with open(path, "a") as f:
        f.write("2,short\n")
    out = str(tmp_path / "out")
    got = PL.run_staffing(spark, path, out)
    assert (got["raw_rows"], got["malformed_rows"], got["valid_rows"]) == (2, 1, 1)
    assert [r.malformed_record for r in spark.read.parquet(f"{out}_malformed").collect()] == ["2,short"]
    assert spark.read.parquet(f"{out}_files").first()["rows"] == 2


def _bands(spark):
    from rosterline.plans import views as V

    return [r for r in V.staffing_bands(spark.table("vw_facility_analytics")).collect() if r.avg_total_hprd is not None]

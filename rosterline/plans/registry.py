"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracle.

Each query reads the driver's tables in full: ``sources.testmap`` derives the
curated staffing, provider and claims datasets from them, which are written
once per application under the checkpoint folder (as the batch jobs publish
curated tables), and the library operators run on those.  Float aggregates
whose value depends on
summation order (averages, correlations, standard deviations, interpolated
quantiles) are rounded to ``DIGITS`` on both sides; ratios of exact sums are
compared unrounded.
"""

from __future__ import annotations

import os
import re
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline import oracle as O
from rosterline.operators import clean as C
from rosterline.operators import enrich as E
from rosterline.operators import profile as P
from rosterline.operators.derive import with_daily_metrics
from rosterline.plans import reports as R
from rosterline.plans import views as V
from rosterline.session import scratch_path
from rosterline.sources import files
from rosterline.sources import testmap as M
from rosterline.sources.sinks import shuffles_join, write_clustered, write_partitioned, write_table
from rosterline.streaming import manifest as MF

DIGITS = 6


_WRITTEN: dict[tuple[str, str, str], DataFrame | dict] = {}
_KEY_LOCKS: dict[tuple[str, str, str], threading.RLock] = {}
_GUARD = threading.Lock()


def _lock_for(key: tuple[str, str, str]) -> threading.RLock:
    with _GUARD:
        return _KEY_LOCKS.setdefault(key, threading.RLock())


def _written_table(
    spark: SparkSession, sf_dir: str, name: str, build, partition_by=None, cluster=None, laid_out: bool = False
) -> DataFrame:
    """The curated input ``name`` derived from ``sf_dir``, written once per
    application as a Parquet table under the shared checkpoint folder.

    Like the source pipeline's curated tables, the derived staffing, provider
    and claims datasets are materialised once and every report reads them;
    the write also cuts the lineage back to the raw tables.  The scan is
    defined once per application (file listing and footers are read once).
    ``laid_out`` says that ``build`` deals its rows in ranges of ``cluster``; they hold
    unless its plan joins by a shuffle.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    # One lock per table: independent tables materialise concurrently, and a
    # table is never written twice.
    with _lock_for(key):
        df = _WRITTEN.get(key)
        if df is None:
            tag = re.sub(r"[^A-Za-z0-9_.-]", "_", key[1].strip("/"))
            path = scratch_path(spark, f"inputs/{key[0]}/{tag}/{name}")
            built = build()
            if cluster:
                write_clustered(built, path, partition_by, cluster, laid_out=laid_out and not shuffles_join(built))
            elif partition_by:
                write_partitioned(built, path, partition_by)
            else:
                write_table(built, path)
            # Read back with the written schema: partition values (state) stay
            # strings whatever the session's partition type inference says.
            df = spark.read.schema(built.schema).parquet(path)
            _WRITTEN[key] = df
        return df


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Materialise the curated inputs and the published facility analytics
    table (done lazily by the first query that needs them otherwise)."""
    i = Inputs(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=3) as pool:
        for job in [pool.submit(i.typed), pool.submit(i.provider), pool.submit(i.claims)]:
            job.result()
    i.published_overview()


@dataclass
class Inputs:
    """Curated inputs for one (session, data folder)."""

    spark: SparkSession
    sf_dir: str

    def staffing(self) -> DataFrame:
        return _written_table(
            self.spark, self.sf_dir, "staffing",
            lambda: M.staffing_daily(self.spark, self.sf_dir), partition_by="state", cluster=["provnum", "workdate"],
            laid_out=True,
        )

    def daily(self) -> DataFrame:
        return with_daily_metrics(self.staffing())

    def provider(self) -> DataFrame:
        return _written_table(
            self.spark, self.sf_dir, "provider", lambda: M.provider_info(self.spark, self.sf_dir)
        )

    def claims(self) -> DataFrame:
        return _written_table(
            self.spark, self.sf_dir, "claims", lambda: M.quality_claims(self.spark, self.sf_dir)
        )

    def facilities(self) -> DataFrame:
        return V.facility_summary(self.daily(), self.provider())

    def analytics(self) -> DataFrame:
        return V.facility_analytics(self.facilities(), V.quality_pivot(self.claims()))

    def published_analytics(self) -> DataFrame:
        """The facility analytics table as the pipeline publishes it: written
        once, partitioned by state, so a state slice reads one directory."""
        return _written_table(
            self.spark, self.sf_dir, "facility_analytics", self.analytics, partition_by="state"
        )


    def published_overview(self) -> DataFrame:
        """The state overview as published: one row a state, written once."""
        return _written_table(
            self.spark, self.sf_dir, "state_overview",
            lambda: R.state_overview(
                V.state_summary(self.daily(), self.provider()),
                V.state_facility_ratings(self.published_analytics()),
            ),
        )

    def typed(self) -> DataFrame:
        """Raw staffing rows with planted defects, typed but not yet filtered; written
        once, as the staffing job does, so that a check reads its columns alone."""
        return _written_table(
            self.spark, self.sf_dir, "typed",
            # From the dealt rows: a scan of the curated files packs millions of rows into a task.
            lambda: C.type_staffing(C.present_staffing(M.staffing_raw_text(M.staffing_daily(self.spark, self.sf_dir)))),
        )

    def raw_csv(self) -> dict:
        """The raw CSV inputs with planted defects, written once per application."""
        key = (self.spark.sparkContext.applicationId, os.path.abspath(self.sf_dir), "raw_csv")
        with _lock_for(key):
            if key not in _WRITTEN:
                tag = re.sub(r"[^A-Za-z0-9_.-]", "_", key[1].strip("/"))
                path = scratch_path(self.spark, f"inputs/{key[0]}/{tag}/raw_csv")
                _WRITTEN[key] = M.write_defective_csv(
                    self.spark, M.staffing_daily(self.spark, self.sf_dir), self.provider(), self.claims(), path)
            return _WRITTEN[key]


QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ---------------------------------------------------------------------------
# Views (A1-A11, J5, J6)
# ---------------------------------------------------------------------------


@register("facility_summary", O.with_ctes("SELECT * FROM facility_summary", ["facility_summary"]))
def _facility_summary(i: Inputs) -> DataFrame:
    return i.facilities()


@register("state_summary", O.with_ctes("SELECT * FROM state_summary", ["state_summary"]))
def _state_summary(i: Inputs) -> DataFrame:
    return V.state_summary(i.daily(), i.provider())


@register(
    "state_facility_ratings",
    O.with_ctes("SELECT * FROM state_facility_ratings", ["state_facility_ratings"]),
)
def _state_facility_ratings(i: Inputs) -> DataFrame:
    return V.state_facility_ratings(i.facilities())


@register("national_kpis", O.with_ctes("SELECT * FROM national_kpis", ["national_kpis"]))
def _national_kpis(i: Inputs) -> DataFrame:
    return V.national_kpis(i.daily())


@register("quality_pivot", O.with_ctes("SELECT * FROM quality_pivot", ["quality_pivot"]))
def _quality_pivot(i: Inputs) -> DataFrame:
    return V.quality_pivot(i.claims())


@register(
    "facility_analytics", O.with_ctes("SELECT * FROM facility_analytics", ["facility_analytics"])
)
def _facility_analytics(i: Inputs) -> DataFrame:
    return i.analytics()


_NATIONAL_MEANS = dict(zip(
    ("avg_rehospitalization_rate", "avg_short_stay_ed_rate", "avg_hospitalizations_per_1000", "avg_long_stay_ed_per_1000"),
    (name for _, name in V.S.MEASURES),
))


@register("national_quality", O.with_ctes(
    "SELECT " + ", ".join(f"{O.r6(f'AVG({c})')} AS {a}" for a, c in _NATIONAL_MEANS.items()) + " FROM facility_analytics",
    ["facility_analytics"]))
def _national_quality(i: Inputs) -> DataFrame:
    return V.national_quality(i.published_analytics(), DIGITS)


def _rounded(columns: list[str], digits: str) -> str:
    return ", ".join(f"{digits.format(c)} AS {c}" for c in columns)


_BAND_VALUES = _rounded(V.S.BAND_AVERAGES, "round({}, 6)")


@register("staffing_bands", O.with_ctes(
    f"SELECT staffing_group, facilities, {_BAND_VALUES} FROM band_averages", ["band_averages"]))
def _staffing_bands(i: Inputs) -> DataFrame:
    return V.staffing_bands(i.published_analytics(), DIGITS)


def _corr_sql(x: str, y: str) -> str:
    c = f"corr({x}, {y})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE round({c}, 6) END"


@register("correlations", O.with_ctes(
    "SELECT "
    + ",\n".join(f"{_corr_sql(x, y)} AS {name}" for name, x, y, _ in V.S.CORRELATIONS)
    + "\nFROM facility_analytics",
    ["facility_analytics"],
))
def _correlations(i: Inputs) -> DataFrame:
    return V.correlations(i.published_analytics(), DIGITS)


# ---------------------------------------------------------------------------
# Daily metrics and enrichment
# ---------------------------------------------------------------------------


@register("direct_hours", O.with_ctes(
    "SELECT provnum, workdate, total_direct_hours, contract_direct_hours FROM daily", ["daily"]))
def _direct_hours(i: Inputs) -> DataFrame:
    return i.daily().select("provnum", "workdate", "total_direct_hours", "contract_direct_hours")


@register("daily_hprd", O.with_ctes(
    "SELECT provnum, workdate, rn_hprd, lpn_hprd, cna_hprd, total_direct_hprd, "
    "contract_dependency_pct FROM daily", ["daily"]))
def _daily_hprd(i: Inputs) -> DataFrame:
    return i.daily().select(
        "provnum", "workdate", "rn_hprd", "lpn_hprd", "cna_hprd", "total_direct_hprd",
        "contract_dependency_pct",
    )


@register("enrich_left", O.with_ctes("SELECT * FROM facility_metrics", ["facility_metrics"]))
def _enrich_left(i: Inputs) -> DataFrame:
    return E.enrich_daily(i.daily(), i.provider())


_IDS = """
    s_ids AS (SELECT DISTINCT trim(provnum) AS sid FROM staffing WHERE trim(provnum) IS NOT NULL),
    p_ids AS (SELECT DISTINCT trim(provider_id) AS pid FROM provider
              WHERE trim(provider_id) IS NOT NULL)"""


def _with_ids(body: str) -> str:
    base = O.with_ctes("SELECT 1", ["staffing", "provider"])
    return base[: -len("\nSELECT 1")] + "," + _IDS + "\n" + body


@register("join_coverage", _with_ids("""
    SELECT COUNT(*) AS total_facilities,
           COUNT(pid) AS matched_facilities,
           COUNT(*) - COUNT(pid) AS unmatched_facilities,
           CASE WHEN COUNT(*) > 0
                THEN CAST(COUNT(pid) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0E0
                ELSE 0.0E0 END AS coverage_pct
    FROM s_ids LEFT JOIN p_ids ON sid = pid"""))
def _join_coverage(i: Inputs) -> DataFrame:
    return E.join_coverage(i.staffing(), i.provider())


@register("unmatched_ids", _with_ids(
    "SELECT sid AS provnum FROM s_ids WHERE sid NOT IN (SELECT pid FROM p_ids)"))
def _unmatched_ids(i: Inputs) -> DataFrame:
    return E.unmatched_ids(i.staffing(), i.provider())


# ---------------------------------------------------------------------------
# Reports (J6, F8-F14, K1-K11, P19-P21)
# ---------------------------------------------------------------------------

# Report parameters (what a dashboard user would pick).
REPORT_STATE = "NATION_9"
TREND_PROVNUM = "10"
OWNERSHIP_CHOICE = ["For profit", "Non profit"]
MIN_RATING = 3
TOP_N_STATES = 10


def _overview(i: Inputs) -> DataFrame:
    return i.published_overview()


def _state_slice(i: Inputs) -> DataFrame:
    return R.state_facilities(i.published_analytics(), REPORT_STATE)


@register("state_overview", O.with_ctes("SELECT * FROM state_overview", ["state_overview"]))
def _state_overview(i: Inputs) -> DataFrame:
    return _overview(i)


@register("state_row", O.with_ctes(
    f"SELECT * FROM state_overview WHERE state = '{REPORT_STATE}'", ["state_overview"]))
def _state_row(i: Inputs) -> DataFrame:
    return R.state_row(_overview(i), REPORT_STATE)


def _ranking_sql(metric: str) -> str:
    return O.with_ctes(f"""
    SELECT state, {metric} FROM state_overview WHERE {metric} IS NOT NULL
    ORDER BY {metric} DESC, state LIMIT {TOP_N_STATES}""", ["state_overview"])


for _, _metric in V.S.RANKING_METRICS:
    register("state_ranking" if _metric == "total_direct_hprd" else f"state_ranking_{_metric}", _ranking_sql(_metric))(
        lambda i, metric=_metric: R.state_ranking(_overview(i), metric, TOP_N_STATES)
    )


_EVEN = "round_even({}, 2)"


def _display_sql(source: str, columns: list[str], rounded: list[str]) -> str:
    parts = [f"{_EVEN.format(c)} AS {c}" if c in rounded else c for c in columns]
    return f"SELECT {', '.join(parts)} FROM {source}"


@register("state_table", O.with_ctes(
    f"SELECT * REPLACE ({_rounded(V.S.STATE_TABLE_ROUNDED, _EVEN)}) FROM state_overview", ["state_overview"]))
def _state_table(i: Inputs) -> DataFrame:
    return R.state_table(_overview(i))


@register("band_table", O.with_ctes(
    f"SELECT staffing_group, facilities, {_rounded(V.S.BAND_AVERAGES, _EVEN)} FROM band_averages", ["band_averages"]))
def _band_table(i: Inputs) -> DataFrame:
    return R.band_table(V.staffing_bands(i.published_analytics()))


@register("state_options", O.with_ctes(
    "SELECT DISTINCT state FROM state_overview WHERE state IS NOT NULL", ["state_overview"]))
def _state_options(i: Inputs) -> DataFrame:
    return R.distinct_options(_overview(i), "state")


_MIX_SQL = " UNION ALL ".join(
    f"SELECT state, '{lab}' AS staff_type, COALESCE({c}, 0.0E0) AS hprd FROM state_overview"
    for lab, c in V.S.STAFFING_MIX
)
_RATINGS_SQL = " UNION ALL ".join(
    f"SELECT state, '{lab}' AS rating, COALESCE({c}, 0.0E0) AS score FROM state_overview"
    for lab, c in V.S.RATING_LABELS
)


@register("staffing_mix", O.with_ctes(_MIX_SQL, ["state_overview"]))
def _staffing_mix(i: Inputs) -> DataFrame:
    return R.staffing_mix(_overview(i))


@register("ratings_long", O.with_ctes(_RATINGS_SQL, ["state_overview"]))
def _ratings_long(i: Inputs) -> DataFrame:
    return R.ratings_long(_overview(i))


@register("state_facilities", O.with_ctes(
    f"SELECT * FROM facility_analytics WHERE state = '{REPORT_STATE}'", ["facility_analytics"]))
def _state_facilities(i: Inputs) -> DataFrame:
    return _state_slice(i)


@register("ownership_options", O.with_ctes(f"""
    SELECT DISTINCT ownership_type FROM facility_analytics
    WHERE state = '{REPORT_STATE}' AND ownership_type IS NOT NULL""", ["facility_analytics"]))
def _ownership_options(i: Inputs) -> DataFrame:
    return R.distinct_options(_state_slice(i), "ownership_type")


def _ranked_sql(direction: str) -> str:
    return O.with_ctes(f"""
    SELECT provnum, provider_name, total_direct_hprd, rehospitalization_rate
    FROM facility_analytics
    WHERE state = '{REPORT_STATE}' AND total_direct_hprd IS NOT NULL
    ORDER BY total_direct_hprd {direction}, provnum LIMIT 10""", ["facility_analytics"])


@register("top_facilities", _ranked_sql("DESC"))
def _top_facilities(i: Inputs) -> DataFrame:
    return R.top_facilities(_state_slice(i))


@register("bottom_facilities", _ranked_sql("ASC"))
def _bottom_facilities(i: Inputs) -> DataFrame:
    return R.bottom_facilities(_state_slice(i))


_OWN_SQL = ", ".join(f"'{o}'" for o in OWNERSHIP_CHOICE)
_FILTER_SQL = f"""
    FROM facility_analytics
    WHERE state = '{REPORT_STATE}' AND ownership_type IN ({_OWN_SQL})
      AND (overall_rating IS NULL OR overall_rating >= {MIN_RATING})"""


def _explorer(i: Inputs) -> DataFrame:
    return R.explorer_filter(_state_slice(i), OWNERSHIP_CHOICE, MIN_RATING)


@register("explorer_filter", O.with_ctes(
    "SELECT "
    + ", ".join(
        f"round_even({c}, 2) AS {c}" if c in V.S.EXPLORER_ROUNDED else c
        for c in V.S.EXPLORER_TABLE_COLUMNS
    )
    + _FILTER_SQL,
    ["facility_analytics"],
))
def _explorer_filter(i: Inputs) -> DataFrame:
    return R.explorer_table(_explorer(i))


@register("explorer_count", O.with_ctes(
    "SELECT COUNT(*) AS matching_facilities" + _FILTER_SQL, ["facility_analytics"]))
def _explorer_count(i: Inputs) -> DataFrame:
    return R.match_count(_explorer(i))


@register("facility_labels", O.with_ctes("""
    SELECT provnum,
           COALESCE(provider_name, 'Unknown Facility') || ' — ' || provnum AS display_name,
           COALESCE(provider_name, provnum) AS facility_title
    FROM facility_analytics""", ["facility_analytics"]))
def _facility_labels(i: Inputs) -> DataFrame:
    return R.facility_labels(i.published_analytics())


@register("daily_trend", O.with_ctes(f"""
    SELECT workdate, mdscensus, rn_hprd, lpn_hprd, cna_hprd, total_direct_hprd,
           contract_dependency_pct
    FROM facility_metrics
    WHERE state = '{REPORT_STATE}' AND provnum = '{TREND_PROVNUM}'""", ["facility_metrics"]))
def _daily_trend(i: Inputs) -> DataFrame:
    return R.daily_trend(i.daily(), REPORT_STATE, TREND_PROVNUM)


@register("trend_table", O.with_ctes(
    _display_sql("facility_metrics", V.S.TREND_COLUMNS, V.S.TREND_COLUMNS[1:])
    + f" WHERE state = '{REPORT_STATE}' AND provnum = '{TREND_PROVNUM}'", ["facility_metrics"]))
def _trend_table(i: Inputs) -> DataFrame:
    return R.trend_table(R.daily_trend(i.daily(), REPORT_STATE, TREND_PROVNUM))


@register("correlations_long", O.with_ctes(
    " UNION ALL ".join(
        f"SELECT '{label}' AS relationship, {_corr_sql(x, y)} AS correlation "
        "FROM facility_analytics"
        for _, x, y, label in V.S.CORRELATIONS
    ),
    ["facility_analytics"],
))
def _correlations_long(i: Inputs) -> DataFrame:
    return R.correlations_long(V.correlations(i.published_analytics(), DIGITS))


# ---------------------------------------------------------------------------
# Cleaning (P1-P6, F1-F3) and deterministic dedup
# ---------------------------------------------------------------------------

@register("staffing_clean", O.with_ctes("SELECT * FROM cleaned", ["cleaned"]))
def _staffing_clean(i: Inputs) -> DataFrame:
    return C.clean_staffing(M.staffing_raw_text(i.staffing()))


@register("staffing_from_csv", O.with_ctes("SELECT * FROM cleaned", ["cleaned"]))
def _staffing_from_csv(i: Inputs) -> DataFrame:
    raw = files.read_csv(i.spark, i.raw_csv()["pbj"])
    return C.clean_staffing(raw).drop(files.SOURCE_FILE)


@register("provider_clean", O.with_ctes("SELECT * FROM provider", ["provider"]))
def _provider_clean(i: Inputs) -> DataFrame:
    return C.clean_provider(files.read_csv(i.spark, i.raw_csv()["provider"], with_source=False))


@register("claims_clean", O.with_ctes("SELECT * FROM claims", ["claims"]))
def _claims_clean(i: Inputs) -> DataFrame:
    return C.clean_claims(files.read_csv(i.spark, i.raw_csv()["claims"], with_source=False))


_DROPS = {
    "blank_id": "provnum = ''", "bad_date": "workdate IS NULL", "missing_census": "mdscensus IS NULL",
    "negative_census": "mdscensus < 0",
}


@register("staffing_drops", O.with_ctes(
    "SELECT (SELECT COUNT(*) FROM staffing) - COUNT(*) AS dropped_empty, "
    + ", ".join(f"{O.count_if(c)} AS dropped_{n}" for n, c in _DROPS.items()) + " FROM typed", ["typed"]))
def _staffing_drops(i: Inputs) -> DataFrame:
    raw = files.read_csv(i.spark, i.raw_csv()["pbj"])
    return P.drop_reasons(raw)


_DEDUP_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@register("provider_dedup", f"""
    SELECT provider_id, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity,
           l_extendedprice, l_returnflag
    FROM (SELECT CAST(l_suppkey AS VARCHAR) AS provider_id, CAST(l_shipdate AS DATE) AS l_shipdate,
                 l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag,
                 ROW_NUMBER() OVER (PARTITION BY l_suppkey
                                    ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber,
                                             l_partkey, l_quantity) AS rn
          FROM lineitem)
    WHERE rn = 1""")
def _provider_dedup(i: Inputs) -> DataFrame:
    li = M.table(i.spark, i.sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("provider_id"),
        F.to_date("l_shipdate").alias("l_shipdate"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag",
    )
    return C.first_per_key(li, ["provider_id"], _DEDUP_ORDER)


# ---------------------------------------------------------------------------
# Validation summaries and profile
# ---------------------------------------------------------------------------

PERIOD_START, PERIOD_END = "1996-04-01", "1996-06-30"


@register("dataset_summary", O.with_ctes("""
    SELECT COUNT(*) AS rows, COUNT(DISTINCT provnum) AS facilities,
           COUNT(DISTINCT workdate) AS dates, MIN(workdate) AS min_date, MAX(workdate) AS max_date
    FROM staffing""", ["staffing"]))
def _dataset_summary(i: Inputs) -> DataFrame:
    return P.dataset_summary(i.staffing())


@register("state_distribution", O.with_ctes("""
    SELECT state, COUNT(*) AS rows, COUNT(DISTINCT provnum) AS facilities
    FROM staffing GROUP BY state""", ["staffing"]))
def _state_distribution(i: Inputs) -> DataFrame:
    return P.state_distribution(i.staffing())


@register("quarter_distribution", O.with_ctes("""
    SELECT CAST(year(workdate) AS INTEGER) AS year, CAST(quarter(workdate) AS INTEGER) AS quarter,
           COUNT(*) AS rows, COUNT(DISTINCT provnum) AS facilities
    FROM staffing GROUP BY 1, 2""", ["staffing"]))
def _quarter_distribution(i: Inputs) -> DataFrame:
    return P.quarter_distribution(i.staffing())


@register("negative_hours", O.with_ctes(
    "SELECT "
    + O.count_if(" OR ".join(f"{c} < 0" for c in V.S.HOUR_COLUMNS)) + " AS rows_with_negative_hours, "
    + ", ".join(f"{O.count_if(f'{c} < 0')} AS negative_{c}" for c in V.S.HOUR_COLUMNS)
    + " FROM typed",
    ["typed"],
))
def _negative_hours(i: Inputs) -> DataFrame:
    return P.negative_hours(i.typed())


@register("measure_distribution", O.with_ctes("""
    SELECT measure_code, measure_description, resident_type, COUNT(*) AS rows,
           COUNT(adjusted_score) AS available_adjusted_scores
    FROM claims GROUP BY 1, 2, 3""", ["claims"]))
def _measure_distribution(i: Inputs) -> DataFrame:
    return P.measure_distribution(i.claims())


@register("claims_cardinality", O.with_ctes("""
    SELECT COUNT(*) AS rows, COUNT(DISTINCT provider_id) AS facilities,
           COUNT(DISTINCT measure_code) AS measures
    FROM claims""", ["claims"]))
def _claims_cardinality(i: Inputs) -> DataFrame:
    return P.claims_cardinality(i.claims())


@register("duplicate_claim_keys", O.with_ctes("""
    SELECT provider_id, measure_code, COUNT(*) AS count
    FROM claims GROUP BY 1, 2 HAVING COUNT(*) > 1""", ["claims"]))
def _duplicate_claim_keys(i: Inputs) -> DataFrame:
    return P.duplicate_claim_keys(i.claims())


@register("duplicate_keys", O.with_ctes("""
    SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_key_rows,
           COUNT(CASE WHEN n > 1 THEN 1 END) AS duplicated_keys
    FROM (SELECT provnum, workdate, COUNT(*) AS n FROM feed GROUP BY 1, 2)""", ["feed"]))
def _duplicate_keys(i: Inputs) -> DataFrame:
    return P.duplicate_keys(M.staffing_feed(i.spark, i.sf_dir), ["provnum", "workdate"])


@register("duplicate_rows", O.with_ctes("""
    SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT provnum, workdate, mdscensus, hrs_rn, hrs_lpn, hrs_cna, COUNT(*) AS n
          FROM feed GROUP BY ALL)""", ["feed"]))
def _duplicate_rows(i: Inputs) -> DataFrame:
    return P.duplicate_rows(M.staffing_feed(i.spark, i.sf_dir))


def _null_sql() -> str:
    cols = [n for _, n in V.S.STAFFING_DIMENSIONS] + ["workdate", "mdscensus"] + V.S.HOUR_COLUMNS
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
        f"round_even(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0E0, 2)"
        " AS null_percentage FROM typed"
        for c in cols
    )


@register("null_profile", O.with_ctes(_null_sql(), ["typed"]))
def _null_profile(i: Inputs) -> DataFrame:
    return P.null_profile(i.typed())


@register("cardinality", O.with_ctes("""
    SELECT COUNT(DISTINCT provnum) AS facilities, COUNT(DISTINCT state) AS states,
           COUNT(DISTINCT county_fips) AS counties, COUNT(DISTINCT workdate) AS dates
    FROM staffing""", ["staffing"]))
def _cardinality(i: Inputs) -> DataFrame:
    return P.cardinality(i.staffing())


@register("date_validation", O.with_ctes(f"""
    SELECT {O.count_if("workdate IS NULL")} AS invalid_dates,
           MIN(workdate) AS min_date, MAX(workdate) AS max_date,
           {O.count_if(f"workdate < DATE '{PERIOD_START}' OR workdate > DATE '{PERIOD_END}'")}
             AS outside_period
    FROM typed""", ["typed"]))
def _date_validation(i: Inputs) -> DataFrame:
    return P.date_validation(i.typed(), PERIOD_START, PERIOD_END)


@register("describe_census", O.with_ctes(
    f"SELECT d.*, c.* FROM ({O.describe_sql('typed', ['mdscensus'])}) d, "
    f"(SELECT {O.count_if('mdscensus < 0')} AS negative_census, "
    f"{O.count_if('mdscensus = 0')} AS zero_census FROM typed) c",
    ["typed"],
))
def _describe_census(i: Inputs) -> DataFrame:
    return P.describe_census(i.typed(), DIGITS)


_HOURS3 = ["hrs_rn", "hrs_lpn", "hrs_cna"]


@register("describe_hours", O.with_ctes(
    f"SELECT d.*, n.negative FROM ({O.describe_sql('typed', _HOURS3)}) d JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {O.count_if(f'{c} < 0')} AS negative FROM typed"
        for c in _HOURS3
    )
    + ") n USING (column_name)",
    ["typed"],
))
def _describe_hours(i: Inputs) -> DataFrame:
    return P.describe_hours(i.typed(), DIGITS)


def _recon_sql() -> str:
    parts = []
    for label, role in V.S.RECONCILED_ROLES:
        t, e, c = (V.S.hrs(role, s) for s in ("", "_emp", "_ctr"))
        cond = (
            f"abs(COALESCE({t}, 0.0E0) - (COALESCE({e}, 0.0E0) + COALESCE({c}, 0.0E0)))"
            f" > {V.S.RECONCILE_TOLERANCE}E0"
        )
        parts.append(f"SELECT '{label}' AS role, {O.count_if(cond)} AS mismatches FROM staffing")
    return "\nUNION ALL\n".join(parts)


@register("reconciliation", O.with_ctes(_recon_sql(), ["staffing"]))
def _reconciliation(i: Inputs) -> DataFrame:
    return P.reconciliation(i.staffing())


def _iqr_sql() -> str:
    vals = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM staffing "
        f"WHERE {c} IS NOT NULL"
        for c in P.IQR_COLUMNS
    )
    return O.with_ctes(
        f"""
        SELECT column_name, {O.r6("q1")} AS q1, {O.r6("q3")} AS q3,
               {O.r6("q1 - 1.5E0 * (q3 - q1)")} AS lower_bound,
               {O.r6("q3 + 1.5E0 * (q3 - q1)")} AS upper_bound,
               {O.count_if("value < q1 - 1.5E0 * (q3 - q1) OR value > q3 + 1.5E0 * (q3 - q1)")}
                 AS outliers
        FROM v JOIN f USING (column_name)
        GROUP BY column_name, q1, q3""",
        ["staffing"],
        [("v", vals), ("f", "SELECT column_name, quantile_cont(value, 0.25) AS q1, "
                           "quantile_cont(value, 0.75) AS q3 FROM v GROUP BY 1")],
    )


@register("iqr_outliers", _iqr_sql())
def _iqr_outliers(i: Inputs) -> DataFrame:
    return P.iqr_outliers(i.staffing(), digits=DIGITS)


_PROFILE_TOTAL = "(hrs_rn + hrs_lpn + hrs_cna)"
_PROFILE_HPRD = f"""
    SELECT CASE WHEN mdscensus > 0 THEN hrs_rn / mdscensus END AS rn_hprd,
           CASE WHEN mdscensus > 0 THEN hrs_lpn / mdscensus END AS lpn_hprd,
           CASE WHEN mdscensus > 0 THEN hrs_cna / mdscensus END AS cna_hprd,
           CASE WHEN mdscensus > 0 THEN {_PROFILE_TOTAL} / mdscensus END AS total_direct_hprd
    FROM staffing"""


@register("describe_hprd", O.with_ctes(
    O.describe_sql("h", ["rn_hprd", "lpn_hprd", "cna_hprd", "total_direct_hprd"]),
    ["staffing"], [("h", _PROFILE_HPRD)],
))
def _describe_hprd(i: Inputs) -> DataFrame:
    return P.describe_hprd(i.staffing(), DIGITS)


_PROFILE_PCT = f"""
    SELECT CASE WHEN {_PROFILE_TOTAL} > 0
                THEN (hrs_rn_ctr + hrs_lpn_ctr + hrs_cna_ctr) / {_PROFILE_TOTAL} * 100.0E0
           END AS contract_dependency_pct
    FROM typed"""


@register("contract_pct_profile", O.with_ctes(
    f"SELECT d.*, b.* FROM ({O.describe_sql('p', ['contract_dependency_pct'])}) d, "
    f"(SELECT {O.count_if('contract_dependency_pct < 0 OR contract_dependency_pct > 100')}"
    " AS invalid_pct FROM p) b",
    ["typed"], [("p", _PROFILE_PCT)],
))
def _contract_pct_profile(i: Inputs) -> DataFrame:
    return P.contract_pct_profile(i.typed(), DIGITS)


@register("rows_per_source_file", O.with_ctes(
    "SELECT 'q' || quarter(workdate) AS source_file, COUNT(*) AS rows FROM staffing GROUP BY ALL", ["staffing"]))
def _rows_per_source_file(i: Inputs) -> DataFrame:
    raw = files.read_csv(i.spark, i.raw_csv()["pbj"])
    # Spark names the files at random, so they are told apart by their folder.
    folder = F.regexp_extract(files.SOURCE_FILE, "/quarter=([^/]+)/[^/]+$", 1)
    return P.rows_per_source_file(raw.withColumn(files.SOURCE_FILE, folder))


# Rows-only check (no SQL oracle): which rows a sample holds is open.


@register("sample_rows")
def _sample_rows(i: Inputs) -> DataFrame:
    return P.sample_rows(i.staffing())


# ---------------------------------------------------------------------------
# Incremental file manifest
# ---------------------------------------------------------------------------

_LISTING = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
           'orders_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS name,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '{V.S.FOLDER_MIME}'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
                  THEN '{V.S.NATIVE_DOC_PREFIX}spreadsheet'
                ELSE 'text/csv' END AS mime_type,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS modified_time,
           o_orderpriority AS source,
           (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS trashed
    FROM orders"""
_MANIFEST = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
           CASE WHEN o_orderkey % 5 = 0 THEN '{M.OLD_TIME}'
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS modified_time
    FROM orders WHERE o_orderkey % 3 <> 0"""
_CLASSIFIED = f"""
    SELECT l.file_id, l.name, l.source, l.modified_time,
           CASE WHEN m.file_id IS NULL THEN 'NEW'
                WHEN m.modified_time IS DISTINCT FROM l.modified_time THEN 'MODIFIED'
                ELSE 'SKIPPED' END AS status,
           l.mime_type LIKE '{V.S.NATIVE_DOC_PREFIX}%' AS native
    FROM listing l LEFT JOIN manifest m ON l.file_id = m.file_id
    WHERE NOT l.trashed AND l.mime_type <> '{V.S.FOLDER_MIME}'"""
_FINISHED = """
    SELECT c.*,
           CASE WHEN c.status = 'SKIPPED' OR c.native THEN 'SKIPPED'
                WHEN o.o_orderkey % 97 <> 0 THEN c.status
                ELSE 'FAILED' END AS final_status
    FROM classified c LEFT JOIN orders o ON c.file_id = CAST(o.o_orderkey AS VARCHAR)"""
_MANIFEST_CTES = [("listing", _LISTING), ("manifest", _MANIFEST), ("classified", _CLASSIFIED),
                  ("finished", _FINISHED)]


def _classified(i: Inputs) -> DataFrame:
    listing = MF.in_folder(M.file_listing(i.spark, i.sf_dir), M.LANDING_FOLDER)
    return MF.classify(listing, M.file_manifest(i.spark, i.sf_dir))


def _finished(i: Inputs) -> DataFrame:
    return MF.results(_classified(i), M.copy_outcomes(i.spark, i.sf_dir))


@register("manifest_diff", O.with_ctes(
    "SELECT file_id, name, source, status, status <> 'SKIPPED' AND NOT native AS copy "
    "FROM classified", [], _MANIFEST_CTES[:3]))
def _manifest_diff(i: Inputs) -> DataFrame:
    return _classified(i).select("file_id", "name", "source", "status", "copy")


@register("manifest_summary", O.with_ctes(f"""
    SELECT COALESCE(source, 'TOTAL') AS source,
           {O.count_if("final_status = 'NEW'")} AS new,
           {O.count_if("final_status = 'MODIFIED'")} AS modified,
           {O.count_if("final_status = 'SKIPPED'")} AS skipped,
           {O.count_if("final_status = 'FAILED'")} AS failed
    FROM finished GROUP BY ROLLUP (source)""", [], _MANIFEST_CTES))
def _manifest_summary(i: Inputs) -> DataFrame:
    return MF.summary(_finished(i))


@register("manifest_next", O.with_ctes("""
    SELECT m.file_id, m.name, m.modified_time, m.source, m.target_key
    FROM full_manifest m
    WHERE m.file_id NOT IN (SELECT file_id FROM finished
                            WHERE final_status IN ('NEW', 'MODIFIED'))
    UNION ALL
    SELECT file_id, name, modified_time, source, source || '/' || name AS target_key
    FROM finished WHERE final_status IN ('NEW', 'MODIFIED')""", [], _MANIFEST_CTES + [(
    "full_manifest", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
           'orders_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS name,
           CASE WHEN o_orderkey % 5 = 0 THEN '{M.OLD_TIME}'
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS modified_time,
           o_orderpriority AS source,
           o_orderpriority || '/orders_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS target_key
    FROM orders WHERE o_orderkey % 3 <> 0""")]))
def _manifest_next(i: Inputs) -> DataFrame:
    return MF.next_manifest(M.file_manifest(i.spark, i.sf_dir), _finished(i))


@register("state_conflicts", O.with_ctes("""
    SELECT COUNT(CASE WHEN n > 1 THEN 1 END) AS facilities_in_several_states
    FROM (SELECT provnum, COUNT(DISTINCT state) AS n FROM staffing
          WHERE state IS NOT NULL GROUP BY provnum)""", ["staffing"]))
def _state_conflicts(i: Inputs) -> DataFrame:
    return P.state_conflicts(i.staffing())


@register("band_outcomes", O.with_ctes(
    f"SELECT staffing_group, {_rounded(V.S.BAND_AVERAGES[1:3], 'round({}, 6)')} FROM band_averages",
    ["band_averages"]))
def _band_outcomes(i: Inputs) -> DataFrame:
    return R.band_outcomes(V.staffing_bands(i.published_analytics(), DIGITS))


@register("band_ratings", O.with_ctes(
    f"SELECT staffing_group, {_rounded(V.S.BAND_AVERAGES[3:], 'round({}, 6)')} FROM band_averages",
    ["band_averages"]))
def _band_ratings(i: Inputs) -> DataFrame:
    return R.band_ratings(V.staffing_bands(i.published_analytics(), DIGITS))

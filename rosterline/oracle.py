"""Independent SQL formulation of every registered query, for DuckDB.

The driver's tables are pre-registered as views in DuckDB.  The CTEs below
rebuild the three source datasets from them (the same mapping as
``rosterline.sources.testmap``) and then follow the metric definitions: one step
sums hours and days, the next divides the sums, and attributes are looked up in
the provider table at the end.  Names, bands and measures come from ``schemas``.
The Spark side uses other plans (conditional aggregates, weighted ratings,
struct-min dedup), so agreement is a real check.
"""

from __future__ import annotations

from rosterline import schemas as S
from rosterline.sources import testmap as M


def _hour_sql() -> list[str]:
    flag = {"RN": "R", "LPN": "N", "CNA": "A"}
    out = []
    for role in S.STAFF_ROLES:
        if role in flag:
            cond = f"l_returnflag = '{flag[role]}'"
        else:
            cond = f"l_linenumber = {M.LINE_BY_ROLE[role]}"
        value = "l_quantity - 2.0E0" if role == "NAtrn" else "l_quantity"
        for suffix in S.HOUR_SUFFIXES:
            c = cond
            if suffix == "_emp":
                c += " AND l_linestatus = 'O' AND l_linenumber < 7"
            elif suffix == "_ctr":
                c += " AND l_linestatus = 'F'"
            out.append(f"SUM(CASE WHEN {c} THEN {value} END) AS {S.hrs(role, suffix)}")
    return out


def _coalesced(cols: list[str]) -> str:
    return " + ".join(f"COALESCE({c}, 0.0E0)" for c in cols)


_TOTAL = _coalesced(["hrs_rn", "hrs_lpn", "hrs_cna"])
_CONTRACT = _coalesced(["hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"])

_MEASURE_TEXT = " ".join(f"WHEN {c} THEN '{t}'" for c, t in M.MEASURE_TEXT.items())

# What is summed over days, and which sums each published ratio divides.
_SUMMED = {
    "total_resident_days": "mdscensus", "s_rn": "hrs_rn", "s_lpn": "hrs_lpn", "s_cna": "hrs_cna",
    "s_direct": "total_direct_hours", "s_contract": "contract_direct_hours",
}
_PER_DAY = {"rn_hprd": "s_rn", "lpn_hprd": "s_lpn", "cna_hprd": "s_cna", "total_direct_hprd": "s_direct"}


def sums() -> str:
    return ", ".join(f"SUM({c}) AS {name}" for name, c in _SUMMED.items())


def ratios() -> str:
    """The published ratios of already summed columns, NULL over a zero sum."""
    per_day = [f"CASE WHEN total_resident_days <> 0 THEN {s} / total_resident_days END AS {n}" for n, s in _PER_DAY.items()]
    share = "CASE WHEN s_direct <> 0 THEN 100.0E0 * s_contract / s_direct END AS contract_dependency_pct"
    return ", ".join(["total_resident_days", *per_day, share])


def mean_ratings(table: str) -> str:
    return ", ".join(f"AVG({table}.{r}) AS avg_{r}" for r in S.RATINGS)


def band_of(column: str) -> str:
    """The label of the first band whose bound is above the value."""
    arms = " ".join(f"WHEN {column} < {bound}E0 THEN '{label}'" for bound, label in S.STAFFING_BANDS)
    return f"CASE {arms} ELSE '{S.TOP_BAND}' END"


_ATTRIBUTES = ["provider_name", "city", "county", "ownership_type", "certified_beds", *S.RATINGS]

CTES: dict[str, tuple[list[str], str]] = {
    "staff_day": ([], f"""
        SELECT l_suppkey, CAST(l_shipdate AS DATE) AS workdate,
               SUM(l_linenumber) * (4 + MAX(l_suppkey % 6)) / 4.0E0
                 * CASE WHEN MAX(l_linenumber) = 1 THEN 0 ELSE 1 END AS mdscensus,
               {", ".join(_hour_sql())}
        FROM lineitem
        GROUP BY l_suppkey, CAST(l_shipdate AS DATE)"""),
    "staffing": (["staff_day"], f"""
        SELECT CAST(s.s_suppkey AS VARCHAR) AS provnum,
               s.s_name AS provname,
               'City ' || CAST(s.s_suppkey % 17 AS VARCHAR) AS city,
               n.n_name AS state,
               'County ' || CAST(s.s_suppkey % 23 AS VARCHAR) AS county_name,
               lpad(CAST(s.s_nationkey * 1000 + s.s_suppkey % 23 AS VARCHAR), 5, '0') AS county_fips,
               CAST(year(d.workdate) AS VARCHAR) || 'Q' || CAST(quarter(d.workdate) AS VARCHAR) AS cy_qtr,
               d.workdate, d.mdscensus, {", ".join("d." + c for c in S.HOUR_COLUMNS)}
        FROM staff_day d
        JOIN supplier s ON d.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "daily": (["staffing"], f"""
        SELECT *,
               {_TOTAL} AS total_direct_hours,
               {_CONTRACT} AS contract_direct_hours,
               CASE WHEN mdscensus > 0 THEN hrs_rn / mdscensus END AS rn_hprd,
               CASE WHEN mdscensus > 0 THEN hrs_lpn / mdscensus END AS lpn_hprd,
               CASE WHEN mdscensus > 0 THEN hrs_cna / mdscensus END AS cna_hprd,
               CASE WHEN mdscensus > 0 THEN ({_TOTAL}) / mdscensus END AS total_direct_hprd,
               CASE WHEN ({_TOTAL}) > 0 THEN ({_CONTRACT}) / ({_TOTAL}) * 100 END
                 AS contract_dependency_pct
        FROM staffing"""),
    "provider": ([], f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS provider_id,
               s_name AS provider_name,
               CAST(s_suppkey AS VARCHAR) || ' Main Street' AS provider_address,
               'City ' || CAST(s_suppkey % 17 AS VARCHAR) AS city,
               n_name AS state,
               lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
               r_name AS county,
               CASE s_suppkey % 3 WHEN 0 THEN 'For profit' WHEN 1 THEN 'Non profit'
                    ELSE 'Government' END AS ownership_type,
               s_acctbal AS certified_beds,
               abs(s_acctbal) / 100.0E0 AS avg_residents_per_day,
               CASE WHEN s_suppkey % 4 = 0 THEN 'Medicaid' ELSE 'Medicare and Medicaid' END
                 AS provider_type,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 1.0E0 + s_suppkey % 5 END
                 AS overall_rating,
               1.0E0 + (s_suppkey * 7) % 5 AS health_inspection_rating,
               CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE 1.0E0 + (s_suppkey * 3) % 5 END
                 AS qm_rating,
               1.0E0 + s_suppkey % 4 AS staffing_rating
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE s_suppkey % {M.UNMATCHED_MODULUS} <> {M.UNMATCHED_REMAINDER}"""),
    "facility_metrics": (["daily", "provider"], """
        SELECT d.*,
               p.provider_name, p.provider_address, p.city AS provider_city,
               p.state AS provider_state, p.zip_code AS provider_zip_code,
               p.county AS provider_county, p.ownership_type AS provider_ownership_type,
               p.certified_beds AS provider_certified_beds,
               p.avg_residents_per_day AS provider_avg_residents_per_day,
               p.provider_type, p.overall_rating AS provider_overall_rating,
               p.health_inspection_rating AS provider_health_inspection_rating,
               p.qm_rating AS provider_qm_rating, p.staffing_rating AS provider_staffing_rating
        FROM daily d
        LEFT JOIN provider p ON trim(d.provnum) = trim(p.provider_id)"""),
    "claims": ([], f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS provider_id,
               CAST(CASE l_linenumber % 4 WHEN 0 THEN 521 WHEN 1 THEN 522 WHEN 2 THEN 551
                    ELSE 552 END AS INTEGER) AS measure_code,
               CASE CASE l_linenumber % 4 WHEN 0 THEN 521 WHEN 1 THEN 522 WHEN 2 THEN 551
                    ELSE 552 END {_MEASURE_TEXT} END AS measure_description,
               CASE WHEN l_linenumber % 4 IN (0, 1) THEN 'Short Stay' ELSE 'Long Stay' END
                 AS resident_type,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE SUM(l_quantity) / COUNT(*) END
                 AS adjusted_score,
               MAX(l_quantity) AS observed_score,
               MIN(l_quantity) AS expected_score,
               CASE WHEN l_linenumber % 4 IN (0, 2) THEN 'Y' ELSE 'N' END AS used_in_five_star,
               '{M.MEASURE_PERIOD}' AS measure_period,
               DATE '{M.PROCESSING_DATE}' AS processing_date
        FROM lineitem
        GROUP BY l_suppkey, l_linenumber"""),
    "feed": ([], f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS provnum, CAST(l_shipdate AS DATE) AS workdate,
               CAST(l_linenumber AS DOUBLE) AS mdscensus,
               CASE WHEN l_returnflag = 'R' THEN l_quantity END AS hrs_rn,
               CASE WHEN l_returnflag = 'N' THEN l_quantity END AS hrs_lpn,
               CASE WHEN l_returnflag = 'A' THEN l_quantity END AS hrs_cna
        FROM lineitem"""),
    "facility_sums": (["daily"], f"""
        SELECT provnum, MAX(state) AS state, {sums()},
               MIN(workdate) AS first_date, MAX(workdate) AS last_date,
               COUNT(DISTINCT workdate) AS reporting_days
        FROM daily GROUP BY provnum"""),
    "facility_summary": (["facility_sums", "provider"], f"""
        SELECT x.provnum, x.state, {", ".join(f"p.{a}" for a in _ATTRIBUTES)}, {ratios()},
               first_date, last_date, reporting_days
        FROM facility_sums x LEFT JOIN provider p ON p.provider_id = trim(x.provnum)"""),
    "state_sums": (["daily"], f"""
        SELECT state, COUNT(DISTINCT provnum) AS total_facilities, {sums()}
        FROM daily GROUP BY state"""),
    "state_day_ratings": (["daily", "provider"], f"""
        SELECT d.state AS rated_state, {mean_ratings("p")}
        FROM daily d LEFT JOIN provider p ON p.provider_id = trim(d.provnum) GROUP BY d.state"""),
    "state_summary": (["state_sums", "state_day_ratings"], f"""
        SELECT state, total_facilities, {ratios()}, {", ".join(f"avg_{r}" for r in S.RATINGS)}
        FROM state_sums JOIN state_day_ratings ON state IS NOT DISTINCT FROM rated_state"""),
    "state_facility_ratings": (["facility_summary"], f"""
        SELECT f.state, COUNT(*) AS total_facilities, {mean_ratings("f")}
        FROM facility_summary f GROUP BY f.state"""),
    "national_kpis": (["daily"], f"""
        SELECT facilities AS total_facilities, {ratios()}
        FROM (SELECT COUNT(DISTINCT provnum) AS facilities, {sums()} FROM daily)"""),
    "quality_pivot": (["claims"], "SELECT provider_id, " + ", ".join(
        f"MAX(adjusted_score) FILTER (WHERE measure_code = {code}) AS {name}" for code, name in S.MEASURES
    ) + " FROM claims GROUP BY provider_id"),
    "facility_analytics": (["facility_summary", "quality_pivot"], """
        SELECT f.* EXCLUDE (first_date, last_date), q.* EXCLUDE (provider_id)
        FROM facility_summary f LEFT JOIN quality_pivot q ON q.provider_id = f.provnum"""),
    "state_overview": (["state_summary", "state_facility_ratings"], f"""
        SELECT s.* EXCLUDE ({", ".join(f"avg_{r}" for r in S.RATINGS)}), r.* EXCLUDE (state, total_facilities)
        FROM state_summary s LEFT JOIN state_facility_ratings r ON s.state = r.state"""),
    "band_averages": (["facility_analytics"], f"""
        SELECT {band_of("total_direct_hprd")} AS staffing_group, COUNT(*) AS facilities, {", ".join(
            f"AVG({c}) AS {a}" for a, c in zip(S.BAND_AVERAGES, (
                "total_direct_hprd", "rehospitalization_rate", "short_stay_ed_rate", "overall_rating", "staffing_rating"))
        )}
        FROM facility_analytics WHERE rehospitalization_rate IS NOT NULL GROUP BY ALL"""),
    "typed": (["staffing"], f"""
        SELECT * REPLACE (
            CASE WHEN dom = {M.BLANK_ID_DAY} THEN '' ELSE provnum END AS provnum,
            CASE WHEN dom <> {M.BAD_DATE_DAY} THEN workdate END AS workdate,
            CASE dom WHEN {M.NULL_CENSUS_DAY} THEN NULL WHEN {M.NEGATIVE_CENSUS_DAY} THEN -1.0E0 ELSE mdscensus END AS mdscensus,
            CASE dom WHEN {M.BAD_HOURS_DAY} THEN NULL WHEN {M.NEGATIVE_HOURS_DAY} THEN -hrs_rn ELSE hrs_rn END AS hrs_rn,
            CASE WHEN dom = {M.OVER_CONTRACT_DAY} THEN {M.OVER_CONTRACT_HOURS}E0 ELSE hrs_rn_ctr END AS hrs_rn_ctr)
        FROM (SELECT *, day(workdate) AS dom FROM staffing) WHERE dom <> {M.EMPTY_ROW_DAY}"""),
    "cleaned": (["typed"], """
        SELECT * EXCLUDE (dom) FROM typed WHERE provnum <> '' AND workdate IS NOT NULL AND mdscensus >= 0"""),
}


def with_ctes(body: str, needs: list[str], extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first), then ``extra``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    parts = [(n, CTES[n][1]) for n in order] + list(extra or [])
    defs = ",\n".join(f"{n} AS ({sql}\n)" for n, sql in parts)
    return f"WITH {defs}\n{body}"


def r6(expr: str) -> str:
    """Round to 6 digits (order-sensitive float aggregates)."""
    return f"round({expr}, 6)"


def count_if(cond: str) -> str:
    return f"COUNT(CASE WHEN {cond} THEN 1 END)"


def describe_sql(source: str, columns: list[str]) -> str:
    """count, mean, std, min, quartiles, max per column (rounded), UNION ALL."""
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {r6(f'AVG({c})')} AS mean, "
            f"{r6(f'stddev_samp({c})')} AS std, {r6(f'MIN({c})')} AS min, "
            f"{r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS q50, "
            f"{r6(f'quantile_cont({c}, 0.75)')} AS q75, {r6(f'MAX({c})')} AS max FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)

"""Report queries: state panel, rankings, facility explorer, trends, reshapes.

Each report is a ``DataFrame``; parameters (state, metric, filters) are plain
Python values turned into column predicates, never spliced into SQL text.
Top-k reports end in ``orderBy(...).limit(k)``, which Spark plans as a
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline import schemas as S

DISPLAY_DIGITS = 2


def display_round(c: Column | str, digits: int = DISPLAY_DIGITS) -> Column:
    """Display rounding, half-to-even (0.125 -> 0.12, as in the dashboard tables)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c, digits)


# ---------------------------------------------------------------------------
# State panel
# ---------------------------------------------------------------------------


def state_overview(state_summary: DataFrame, state_ratings: DataFrame) -> DataFrame:
    """State summary with facility-weighted ratings (left join on state)."""
    s = state_summary.select(
        "state", "total_facilities", "total_resident_days", "rn_hprd", "lpn_hprd",
        "cna_hprd", "total_direct_hprd", "contract_dependency_pct",
    )
    r = state_ratings.select(
        F.col("state").alias("_rstate"), *[f"avg_{x}" for x in S.RATINGS]
    )
    return s.join(r, s["state"] == r["_rstate"], "left").drop("_rstate")


def state_row(overview: DataFrame, state: str) -> DataFrame:
    """The selected state's row of the overview."""
    return overview.where(F.col("state") == F.lit(state))


def state_ranking(overview: DataFrame, metric: str = "total_direct_hprd", top_n: int = 10) -> DataFrame:
    """Top-N states by one of the ranking metrics; states with NULL metric are dropped."""
    allowed = {c for _, c in S.RANKING_METRICS}
    if metric not in allowed:
        raise ValueError(f"unknown ranking metric {metric!r}; choose one of {sorted(allowed)}")
    return (
        overview.select("state", metric)
        .where(F.col(metric).isNotNull())
        .orderBy(F.col(metric).desc(), F.col("state").asc_nulls_last())
        .limit(top_n)
    )


def _long(df: DataFrame, keys: list[str], pairs: list[tuple[str, str]], label: str, value: str) -> DataFrame:
    """Wide -> long with a NULL value shown as 0."""
    stacked = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(lab).alias(label), F.coalesce(F.col(c), F.lit(0.0)).alias(value))
                    for lab, c in pairs
                ]
            )
        ).alias("_kv"),
    )
    return stacked.select(*keys, f"_kv.{label}", f"_kv.{value}")


def staffing_mix(overview: DataFrame) -> DataFrame:
    """Per state: RN / LPN / CNA HPRD as rows (NULL -> 0)."""
    return _long(overview, ["state"], S.STAFFING_MIX, "staff_type", "hprd")


def ratings_long(overview: DataFrame) -> DataFrame:
    """Per state: the four average ratings as rows (NULL -> 0)."""
    return _long(overview, ["state"], S.RATING_LABELS, "rating", "score")


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of ``column`` (select-box options)."""
    return (
        df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    )


# ---------------------------------------------------------------------------
# Facility explorer
# ---------------------------------------------------------------------------


def state_facilities(analytics: DataFrame, state: str) -> DataFrame:
    """The state's slice of the facility analytics view, ordered by name."""
    return analytics.where(F.col("state") == F.lit(state)).orderBy(
        F.col("provider_name").asc_nulls_last(), F.col("provnum").asc_nulls_last()
    )


def _ranked(facilities: DataFrame, ascending: bool, k: int) -> DataFrame:
    hprd = F.col("total_direct_hprd")
    return (
        facilities.select("provnum", "provider_name", "total_direct_hprd", "rehospitalization_rate")
        .where(hprd.isNotNull())
        .orderBy(hprd.asc() if ascending else hprd.desc(), F.col("provnum").asc_nulls_last())
        .limit(k)
    )


def top_facilities(facilities: DataFrame, k: int = 10) -> DataFrame:
    """Highest total direct HPRD; ties broken by the lower facility id."""
    return _ranked(facilities, ascending=False, k=k)


def bottom_facilities(facilities: DataFrame, k: int = 10) -> DataFrame:
    """Lowest total direct HPRD; ties broken by the lower facility id."""
    return _ranked(facilities, ascending=True, k=k)


def explorer_filter(
    facilities: DataFrame,
    ownership: list[str] | None = None,
    min_overall_rating: float | None = None,
) -> DataFrame:
    """Ownership multi-select (empty = no filter) and minimum overall rating
    (a facility without a rating passes)."""
    out = facilities
    if ownership:
        out = out.where(F.col("ownership_type").isin(list(ownership)))
    if min_overall_rating is not None:
        r = F.col("overall_rating")
        out = out.where(r.isNull() | (r >= F.lit(float(min_overall_rating))))
    return out


def match_count(filtered: DataFrame) -> DataFrame:
    """Number of facilities matching the explorer filters (one row)."""
    return filtered.agg(F.count(F.lit(1)).alias("matching_facilities"))


def _displayed(df: DataFrame, rounded: list[str]) -> DataFrame:
    """``df`` with the named columns rounded for display."""
    return df.select(*[display_round(c).alias(c) if c in rounded else F.col(c) for c in df.columns])


def state_table(overview: DataFrame) -> DataFrame:
    """The state comparison with its metrics rounded for display."""
    return _displayed(overview, S.STATE_TABLE_ROUNDED)


def trend_table(trend: DataFrame) -> DataFrame:
    """The daily series with its metrics rounded for display."""
    return _displayed(trend, S.TREND_COLUMNS[1:])


def band_table(bands: DataFrame) -> DataFrame:
    """The staffing bands with their averages rounded for display."""
    return _displayed(bands, S.BAND_AVERAGES)


def explorer_table(filtered: DataFrame) -> DataFrame:
    """The 16-column facility table with metric columns rounded for display."""
    return _displayed(filtered.select(*S.EXPLORER_TABLE_COLUMNS), S.EXPLORER_ROUNDED)


def facility_labels(facilities: DataFrame) -> DataFrame:
    """Select-box label ``name — id`` and page title (name, else id)."""
    name = F.col("provider_name")
    return facilities.select(
        "provnum",
        F.concat(F.coalesce(name, F.lit(S.UNKNOWN_FACILITY)), F.lit(S.LABEL_SEPARATOR), F.col("provnum"))
        .alias("display_name"),
        F.coalesce(name, F.col("provnum")).alias("facility_title"),
    )


def daily_trend(facility_metrics: DataFrame, state: str, provnum: str) -> DataFrame:
    """One facility's daily series, ordered by day.

    The state predicate is on the partition column of the published table, so
    a scan of that table reads one state directory only.
    """
    return (
        facility_metrics.where((F.col("state") == F.lit(state)) & (F.col("provnum") == F.lit(provnum)))
        .select(*S.TREND_COLUMNS)
        .orderBy("workdate")
    )


def trend_series(trend: DataFrame) -> dict[str, DataFrame]:
    """The three chart series drawn from the daily trend, keyed by day."""
    return {
        "hprd": trend.select("workdate", "rn_hprd", "lpn_hprd", "cna_hprd", "total_direct_hprd"),
        "contract": trend.select("workdate", "contract_dependency_pct"),
        "census": trend.select("workdate", "mdscensus"),
    }


def correlations_long(correlations: DataFrame) -> DataFrame:
    """The one-row correlation view as ten labelled rows."""
    return correlations.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(label).alias("relationship"), F.col(name).alias("correlation"))
                    for name, _, _, label in S.CORRELATIONS
                ]
            )
        ).alias("_kv")
    ).select("_kv.relationship", "_kv.correlation")


def band_outcomes(bands: DataFrame) -> DataFrame:
    """Outcome columns of the staffing bands."""
    return bands.select("staffing_group", "avg_rehospitalization_rate", "avg_short_stay_ed_rate")


def band_ratings(bands: DataFrame) -> DataFrame:
    """Rating columns of the staffing bands."""
    return bands.select("staffing_group", "avg_overall_rating", "avg_staffing_rating")

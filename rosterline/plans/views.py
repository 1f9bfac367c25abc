"""The semantic layer: facility, state, national, quality and correlation views.

Every function takes and returns a ``DataFrame``; Catalyst inlines views built
on views.  Inputs:

* ``daily``    -- staffing rows with ``with_daily_metrics`` columns
* ``provider`` -- curated provider rows, unique per ``provider_id``
* ``claims``   -- curated claims rows

Plan shape.  The published views are written over the enriched daily table
(staffing left-joined to provider).  Because provider attributes are constant
per facility, every view here aggregates the daily rows *first* (partial
aggregation before the shuffle) and joins provider attributes to the
per-facility result, which is orders of magnitude smaller than the daily
table.  One difference to aggregating enriched rows remains open by design: a
NULL facility id forms a group of ``facility_summary`` but is not counted as a
facility anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.functions.metrics import (
    band,
    maybe_round,
    pct_of_totals,
    ratio_of_totals,
    safe_corr,
)
from rosterline.operators.enrich import provider_attributes

_SUMS = [
    ("mdscensus", "total_resident_days"),
    (S.hrs("RN"), "_sum_rn"),
    (S.hrs("LPN"), "_sum_lpn"),
    (S.hrs("CNA"), "_sum_cna"),
    ("total_direct_hours", "_sum_total"),
    ("contract_direct_hours", "_sum_contract"),
]

def _sum_aggs() -> list:
    return [F.sum(c).alias(a) for c, a in _SUMS]


def _resum_aggs() -> list:
    """Second-level roll-up of the partial sums produced by ``_sum_aggs``."""
    return [F.sum(a).alias(a) for _, a in _SUMS]


def _ratios_from_sums() -> list:
    days = "total_resident_days"
    return [
        ratio_of_totals("_sum_rn", days).alias("rn_hprd"),
        ratio_of_totals("_sum_lpn", days).alias("lpn_hprd"),
        ratio_of_totals("_sum_cna", days).alias("cna_hprd"),
        ratio_of_totals("_sum_total", days).alias("total_direct_hprd"),
        pct_of_totals("_sum_contract", "_sum_total").alias("contract_dependency_pct"),
    ]


#: Days that one long holds as bits.
_BIT_DAYS = 64


def facility_partials(daily: DataFrame) -> DataFrame:
    """Mergeable sums of the daily rows: one row per facility, state and 64 days.

    The days are bits of a long, so a day is counted once however often and under
    whichever state it is reported: OR merges the rows of one facility, and the ones
    are the distinct days.  Everything is a fixed-width number, hence one hash
    aggregate with a map-side step and one scan; sums of several periods merge by
    the same aggregates (``summarise_facilities`` takes their union).
    """
    day = F.unix_date("workdate")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(_BIT_DAYS)))
    return daily.groupBy("provnum", "state", F.floor(day / _BIT_DAYS).cast("int").alias("_chunk")).agg(
        F.count(F.lit(1)).alias("_days"), *_sum_aggs(), F.bit_or(bit).alias("_bits"),
        F.min("workdate").alias("first_date"), F.max("workdate").alias("last_date"),
    )


def summarise_facilities(partials: DataFrame, provider: DataFrame) -> DataFrame:
    """The facility summary from ``facility_partials`` rows of one or more periods."""
    # The maximum of a string makes these two aggregates sort; they read the
    # partial rows, not the daily ones.
    by_chunk = partials.groupBy("provnum", "_chunk").agg(
        *_resum_aggs(), F.bit_or("_bits").alias("_bits"), F.max("state").alias("state"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    )
    per_facility = by_chunk.groupBy("provnum").agg(
        *_resum_aggs(), F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias("reporting_days"),
        F.max("state").alias("state"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    )
    attrs = provider_attributes(provider)
    j = per_facility.join(attrs, F.trim(per_facility["provnum"]) == attrs["_pid"], "left")
    return j.select(
        "provnum",
        "provider_name",
        "state",
        F.col("provider_city").alias("city"),
        F.col("provider_county").alias("county"),
        F.col("provider_ownership_type").alias("ownership_type"),
        F.col("provider_certified_beds").alias("certified_beds"),
        *[F.col(f"provider_{r}").alias(r) for r in S.RATINGS],
        "total_resident_days",
        *_ratios_from_sums(),
        "first_date",
        "last_date",
        "reporting_days",
    )


def facility_summary(daily: DataFrame, provider: DataFrame) -> DataFrame:
    """One row per facility: attributes, resident days, ratio-of-sums HPRD,
    contract %, first / last date and distinct reporting days."""
    return summarise_facilities(facility_partials(daily), provider)


def state_summary(daily: DataFrame, provider: DataFrame) -> DataFrame:
    """One row per state: distinct facilities, resident days, ratio-of-sums
    metrics, and provider ratings averaged over facility-days.

    Step 1 aggregates per (state, facility) -- this also yields the distinct
    facility count without a separate distinct aggregation; step 2 joins the
    facility-level ratings and rolls up per state, weighting each facility's
    rating by its number of days (= the average over enriched daily rows).
    """
    per_fac = daily.groupBy("state", "provnum").agg(
        F.count(F.lit(1)).alias("_days"), *_sum_aggs()
    )
    return _states_of(per_fac, provider)


def summarise_states(partials: DataFrame, provider: DataFrame) -> DataFrame:
    """The state summary from ``facility_partials`` rows of one or more periods."""
    per_fac = partials.groupBy("state", "provnum").agg(F.sum("_days").alias("_days"), *_resum_aggs())
    return _states_of(per_fac, provider)


def _states_of(per_fac: DataFrame, provider: DataFrame) -> DataFrame:
    attrs = provider_attributes(provider).select("_pid", *[f"provider_{r}" for r in S.RATINGS])
    j = per_fac.join(attrs, F.trim(per_fac["provnum"]) == attrs["_pid"], "left")
    weighted = []
    for r in S.RATINGS:
        rating = F.col(f"provider_{r}")
        weighted.append(
            (
                F.sum(rating * F.col("_days"))
                / F.sum(F.when(rating.isNotNull(), F.col("_days")))
            ).alias(f"avg_{r}")
        )
    rolled = j.groupBy("state").agg(
        F.count("provnum").alias("total_facilities"),  # a NULL id is no facility
        *_resum_aggs(),
        *weighted,
    )
    return rolled.select(
        "state",
        "total_facilities",
        "total_resident_days",
        *_ratios_from_sums(),
        *[f"avg_{r}" for r in S.RATINGS],
    )


def state_facility_ratings(facilities: DataFrame) -> DataFrame:
    """Per state: facility count and ratings averaged over facilities."""
    return facilities.groupBy("state").agg(
        F.count(F.lit(1)).alias("total_facilities"),
        *[F.avg(r).alias(f"avg_{r}") for r in S.RATINGS],
    )


def national_kpis(daily: DataFrame) -> DataFrame:
    """One row: distinct facilities, resident days and national ratios of sums."""
    g = daily.agg(F.count_distinct("provnum").alias("total_facilities"), *_sum_aggs())
    return g.select("total_facilities", "total_resident_days", *_ratios_from_sums())


def summarise_nation(partials: DataFrame) -> DataFrame:
    """The national KPIs from ``facility_partials`` rows of one or more periods."""
    g = partials.agg(F.count_distinct("provnum").alias("total_facilities"), *_resum_aggs())
    return g.select("total_facilities", "total_resident_days", *_ratios_from_sums())


def quality_pivot(claims: DataFrame) -> DataFrame:
    """One row per provider, one column per measure: MAX(adjusted score).

    Conditional MAX keeps a single partial aggregation; MAX also hides
    duplicate (provider, measure) keys, which are reported separately.
    """
    return claims.groupBy("provider_id").agg(
        *[
            F.max(F.when(F.col("measure_code") == code, F.col("adjusted_score"))).alias(name)
            for code, name in S.MEASURES
        ]
    )


ANALYTICS_COLUMNS = [
    "provnum", "provider_name", "state", "city", "county", "ownership_type",
    "certified_beds", *S.RATINGS, "total_resident_days", "rn_hprd", "lpn_hprd",
    "cna_hprd", "total_direct_hprd", "contract_dependency_pct", "reporting_days",
    *[name for _, name in S.MEASURES],
]


def facility_analytics(facilities: DataFrame, quality: DataFrame) -> DataFrame:
    """Facility summary left-joined to the pivoted quality measures (22 columns)."""
    j = facilities.join(quality, facilities["provnum"] == quality["provider_id"], "left")
    return j.select(*ANALYTICS_COLUMNS)


def national_quality(analytics: DataFrame, digits: int | None = None) -> DataFrame:
    """Facility-level averages of the four claims outcomes."""
    names = {
        "rehospitalization_rate": "avg_rehospitalization_rate",
        "short_stay_ed_rate": "avg_short_stay_ed_rate",
        "hospitalizations_per_1000": "avg_hospitalizations_per_1000",
        "long_stay_ed_visits_per_1000": "avg_long_stay_ed_per_1000",
    }
    return analytics.agg(
        *[maybe_round(F.avg(c), digits).alias(a) for c, a in names.items()]
    )


def staffing_bands(analytics: DataFrame, digits: int | None = None) -> DataFrame:
    """Facilities with a rehospitalisation score, banded by total direct HPRD.

    A NULL HPRD lands in the top band (ELSE branch), as in the source query.
    """
    banded = analytics.where(F.col("rehospitalization_rate").isNotNull()).withColumn(
        "staffing_group", band("total_direct_hprd", S.STAFFING_BANDS, S.TOP_BAND)
    )
    g = banded.groupBy("staffing_group").agg(
        F.count(F.lit(1)).alias("facilities"),
        F.avg("total_direct_hprd").alias("avg_total_hprd"),
        F.avg("rehospitalization_rate").alias("avg_rehospitalization_rate"),
        F.avg("short_stay_ed_rate").alias("avg_short_stay_ed_rate"),
        F.avg("overall_rating").alias("avg_overall_rating"),
        F.avg("staffing_rating").alias("avg_staffing_rating"),
    )
    out = g.select(
        "staffing_group",
        "facilities",
        *[
            maybe_round(F.col(c), digits).alias(c)
            for c in [
                "avg_total_hprd", "avg_rehospitalization_rate", "avg_short_stay_ed_rate",
                "avg_overall_rating", "avg_staffing_rating",
            ]
        ],
    )
    return out.orderBy(F.col("avg_total_hprd").asc_nulls_last(), "staffing_group")


def correlations(analytics: DataFrame, digits: int | None = None) -> DataFrame:
    """One row of ten Pearson correlations; NULL where a side has no variance."""
    return analytics.agg(
        *[maybe_round(safe_corr(x, y), digits).alias(name) for name, x, y, _ in S.CORRELATIONS]
    )

"""Enrichment of daily staffing rows with provider attributes, plus its guards.

Join strategy: the provider side is one row per facility and grows with their
number, so no hint forces its broadcast.  A written provider table carries its
file size, and Spark broadcasts it below ``autoBroadcastJoinThreshold``;
aggregated sides are left to AQE, which decides from the shuffle's real size.
Beyond the threshold the join is a sort-merge join whose hot facilities AQE
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline import schemas as S


class GuardError(RuntimeError):
    """A data-quality guard failed; the dataset must not be published."""


def join_key(c: str) -> F.Column:
    """Normalised join key: string, trimmed."""
    return F.trim(F.col(c).cast("string"))


def provider_attributes(provider: DataFrame) -> DataFrame:
    """Provider columns renamed with a ``provider_`` prefix, keyed by ``_pid``."""
    return provider.select(
        join_key("provider_id").alias("_pid"),
        *[F.col(src).alias(dst) for src, dst in S.PROVIDER_ENRICHMENT],
    )


def enrich_daily(staffing: DataFrame, provider: DataFrame) -> DataFrame:
    """Left join every staffing day to its provider row; the grain is unchanged.

    ``provider`` must be unique per id (see ``clean.dedup_provider``); unmatched
    days keep NULL ``provider_*`` columns.
    """
    left = staffing.withColumn("_jid", join_key("provnum"))
    right = provider_attributes(provider)
    return left.join(right, left["_jid"] == right["_pid"], "left").drop("_jid", "_pid")


def _distinct_ids(df: DataFrame, c: str, alias: str) -> DataFrame:
    return df.select(join_key(c).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def join_coverage(staffing: DataFrame, provider: DataFrame) -> DataFrame:
    """One row: staffing facilities, matched, unmatched and coverage percent.

    Distinct ids on each side (map-side partial distinct), one left join, one
    aggregate -- instead of separate count / inner-join / anti-join actions.
    """
    s = _distinct_ids(staffing, "provnum", "_sid")
    p = _distinct_ids(provider, "provider_id", "_pid")
    j = s.join(p, s["_sid"] == p["_pid"], "left")
    total = F.count(F.lit(1))
    matched = F.count("_pid")
    return j.agg(
        total.alias("total_facilities"),
        matched.alias("matched_facilities"),
        (total - matched).alias("unmatched_facilities"),
        F.when(total > 0, matched.cast("double") / total.cast("double") * F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias("coverage_pct"),
    )


def unmatched_ids(staffing: DataFrame, provider: DataFrame) -> DataFrame:
    """Distinct staffing facility ids with no provider row (NULL ids removed first)."""
    s = _distinct_ids(staffing, "provnum", "provnum")
    p = _distinct_ids(provider, "provider_id", "_pid")
    return s.join(p, s["provnum"] == p["_pid"], "left_anti")


def check_coverage(coverage: DataFrame, min_pct: float = S.MIN_JOIN_COVERAGE_PCT) -> dict:
    """Raise ``GuardError`` when coverage is below ``min_pct`` (exactly equal passes)."""
    row = coverage.first().asDict()
    if row["coverage_pct"] < min_pct:
        raise GuardError(
            f"join coverage {row['coverage_pct']:.2f}% is below {min_pct:.2f}% "
            f"({row['unmatched_facilities']} unmatched facilities)"
        )
    return row


def check_row_count(expected: int, actual: int, what: str = "enriched rows") -> None:
    """The enrichment must not change the grain: output rows = input rows."""
    if expected != actual:
        raise GuardError(f"{what}: {actual} rows written, {expected} rows read")

"""The published tables and the parameterised queries over them.

``write_views`` writes the frames of ``plans.views`` (aggregate first, then
enrich) as tables; the pipeline then points their published names at them, with
fixed columns.  A report then reads a written table of one row per facility
or state, never the daily table.  The analytics table is partitioned by state, so
a state slice reads one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline import schemas as S
from rosterline.plans import reports as R
from rosterline.plans import views as V
from rosterline.sources import sinks

FACILITIES, STATES, STATE_RATINGS = "vw_facility_summary", "vw_state_summary", "vw_state_facility_ratings"
QUALITY, ANALYTICS, CORRELATIONS = "vw_facility_quality", "vw_facility_analytics", "vw_staffing_quality_correlations"
OVERVIEW = "state_overview"


def write_views(
    spark: SparkSession, partials: DataFrame, provider: DataFrame, claims: DataFrame, base: str
) -> dict[str, tuple[str, T.StructType, str | None]]:
    """Write every view as a table; later ones read the files of earlier ones.

    ``partials`` are ``views.facility_partials`` rows, so no daily row is read.
    Returns path, columns and partition column by name.
    """
    done: dict[str, tuple[str, T.StructType, str | None]] = {}

    def put(name: str, df: DataFrame, partition_col: str | None = None) -> DataFrame:
        path = f"{base}/{name}"
        if partition_col:
            sinks.write_partitioned(df, path, partition_col)
        else:
            sinks.write_table(df, path)
        done[name] = (path, df.schema, partition_col)
        return spark.read.schema(df.schema).parquet(path)

    facilities = put(FACILITIES, V.summarise_facilities(partials, provider))
    states = put(STATES, V.summarise_states(partials, provider))
    ratings = put(STATE_RATINGS, V.state_facility_ratings(facilities))
    quality = put(QUALITY, V.quality_pivot(claims))
    analytics = put(ANALYTICS, V.facility_analytics(facilities, quality), "state")
    put(CORRELATIONS, V.correlations(analytics))
    put(OVERVIEW, R.state_overview(states, ratings))
    return done


def state_query(spark: SparkSession) -> DataFrame:
    """State summary with facility-weighted ratings, ordered by state."""
    return spark.table(OVERVIEW).orderBy(F.col("state").asc_nulls_last())


def facility_query(spark: SparkSession, state: str) -> DataFrame:
    """State slice of the analytics table; the value is bound, never spliced."""
    q = f"SELECT * FROM {ANALYTICS} WHERE state = :state ORDER BY provider_name NULLS LAST, provnum"
    return spark.sql(q, args={"state": state})


def trend_query(spark: SparkSession, state: str, provnum: str) -> DataFrame:
    """One facility's daily series; ``state`` prunes to one partition folder."""
    cols = ", ".join(S.TREND_COLUMNS)
    q = f"SELECT {cols} FROM facility_metrics WHERE state = :state AND provnum = :provnum ORDER BY workdate"
    return spark.sql(q, args={"state": state, "provnum": provnum})
